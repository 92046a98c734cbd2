"""Word count over message text, per batch (no state across batches).

Lines are split on single spaces with Java ``Pattern.split`` rules; each
batch is counted with a partial + final hash aggregate, so a very frequent
word is combined map-side before the shuffle and never concentrates raw rows
in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.functions.text import java_space_split


def words(df: DataFrame, text_col: str = "value") -> DataFrame:
    """One row per token (flatMap of the split)."""
    return df.select(F.explode(java_space_split(text_col)).alias("word"))


def wordcount(df: DataFrame, text_col: str = "value") -> DataFrame:
    """``(word, count)`` for one batch of lines."""
    return words(df, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows a console print shows, with a defined order:
    count descending, then word. Planned as a take-ordered (per-partition
    top-n, then a merge of n rows per partition)."""
    return counts.orderBy(F.col("count").desc(), F.col("word").asc()).limit(n)


def wordcount_by_interval(df: DataFrame, ts_col: str, text_col: str,
                          interval_seconds: int = 2) -> DataFrame:
    """Per-batch word counts where batches are fixed ``interval_seconds``
    slices of the event clock (what a micro-batch interval produces when the
    stream is replayed by time)."""
    w = F.window(F.col(ts_col), f"{interval_seconds} seconds")
    tokens = df.select(w.start.alias("batch_start"),
                       F.explode(java_space_split(text_col)).alias("word"))
    return (tokens.groupBy("batch_start", "word")
            .agg(F.count(F.lit(1)).alias("count")))
