"""Line sources: one record per text line (a line-oriented producer)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.functions.text import lines_of


def read_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Text files as ``value`` rows (``spark.read.text`` / file stream)."""
    return (spark.readStream if streaming else spark.read).format("text").load(path)


def explode_lines(df: DataFrame, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Texts already in a table -> ``(keep..., line_no, value)`` rows, with
    line-reader rules (CR/LF/CRLF, no empty line after a final break)."""
    return (df.select(*keep, F.posexplode(lines_of(text_col)).alias("_p", "value"))
            .withColumn("line_no", (F.col("_p") + 1).cast("int"))
            .select(*keep, "line_no", "value"))
