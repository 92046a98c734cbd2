"""Target-distribution importance resampling with Arrow kernels.

Documents are drawn so that their hashed n-gram features look like a target's
(here the benchmark): a feature's gain is the log ratio of its bucket's share
in the target and in the source, a document's weight is the mean gain, and
Gumbel noise on top of the weight makes the highest scores a draw without
replacement.

Inside a task the work is done on whole columns: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` give each
word an index; shifted index arrays are the n-grams, each distinct pair of a
shorter n-gram and a word has its CRC taken once (continued from the shorter
one's), and ``take`` with a segment reduction sums the gains of a document.

Two passes over the texts: one counts buckets (a task sends one row per
bucket, so a frequent word is combined before the shuffle), one scores. Gains
are one number per bucket, the only thing that comes to the driver. Ranks are
range-sorted prefix sums; no task holds all documents.

Defined cases: a null or wordless text has no features and weight 0; a row
without doc_id draws with an empty id and loses ties; rows that agree in
doc_id and text are scored alike and ranked one after the other; an empty
target or table gives gains and results without error; a doc_id or text column
is found by its exact name first, then by letter case, other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import arrow_map, only, renamed, slices_of, table, written
from mailstream.operators.paging import page_slices

# Fixed values of the draw: longest run of words, hash buckets, seed, least
# words of a document that can be drawn, percent drawn.
MAX_N, BUCKETS, SEED, MIN_WORDS, PERCENT = 1, 10_000, 2024, 20, 10
# Fixed value: what separates words once A-Z is lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_COUNT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
_WEIGHT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("digest", T.LongType()),
                        T.StructField("n_words", T.LongType()), T.StructField("n_features", T.LongType()),
                        T.StructField("weight", T.LongType())])


def gram_buckets(texts, max_n: int, buckets: int):
    """For an Arrow text array, one ``(rows, bucket)`` pair of numpy arrays
    per run length 1..max_n, ``rows`` ascending, and the words per row."""
    import zlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), BETWEEN)
    flat, rows = pc.list_flatten(split), pc.list_parent_indices(split)
    real = pc.not_equal(flat, "")
    words = pc.filter(flat, real).dictionary_encode()
    if isinstance(words, pa.ChunkedArray):
        words = words.combine_chunks()
    rows = pc.filter(rows, real).to_numpy(zero_copy_only=False)
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = [w.encode() for w in words.dictionary.to_pylist()]
    crc = np.array([zlib.crc32(w) for w in distinct], dtype=np.int64)
    gram, found = index, [(rows, crc[index] % buckets)]
    for n in range(2, max_n + 1):
        # gram i runs over words i .. i+n-2; it goes on when word i+n-1 is of the same row
        same = rows[:len(rows) - n + 1] == rows[n - 1:]
        pairs = gram[:len(same)] * len(distinct) + index[n - 1:]
        kinds, back = np.unique(pairs[same], return_inverse=True)
        crc = np.array([zlib.crc32(distinct[k % len(distinct)], zlib.crc32(b" ", int(crc[k // len(distinct)])))
                        for k in kinds.tolist()], dtype=np.int64)
        gram = np.zeros(len(same), dtype=np.int64)
        gram[same] = back
        found.append((rows[:len(same)][same], crc[back] % buckets))
    return found, np.bincount(rows, minlength=len(texts))


def bucket_counts(texts: DataFrame, max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """``texts(text)`` -> ``(bucket, n)`` of the buckets that occur."""
    def count(batches):
        import numpy as np
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices_of(batch, "text"):
                for _, b in gram_buckets(part.column("text"), max_n, buckets)[0]:
                    total += np.bincount(b, minlength=buckets)
        hit = np.flatnonzero(total)
        yield {"bucket": hit.astype(np.int32), "n": total[hit]}

    return arrow_map(texts.select("text"), _COUNT, count).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """One gain per bucket, from the counts of source and target."""
    both = (source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .union(target.select("bucket", F.lit(0).cast("long"), "n")))
    both = written(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "imp-buckets")
    s_all, t_all = (float(x or 0) for x in both.agg(F.sum("s"), F.sum("t")).first())
    ratio = ((F.col("t") + 1.0) * F.lit(s_all + buckets)) / ((F.col("s") + 1.0) * F.lit(t_all + buckets))
    rows = (both.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(both, "bucket", "left")
            .fillna(0, ["s", "t"]).select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).alias("gain")).collect())
    out = [0] * buckets
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def weights(docs: DataFrame, gain: list[int], max_n: int = MAX_N) -> DataFrame:
    """``docs(doc_id, digest, text)`` -> ``_WEIGHT`` rows."""
    def score(batches):
        import numpy as np
        table = np.array(gain, dtype=np.int64)
        for batch in batches:
            for part in slices_of(batch, "text"):
                found, n_words = gram_buckets(part.column("text"), max_n, len(table))
                total = np.zeros(part.num_rows, dtype=np.int64)
                many = np.zeros(part.num_rows, dtype=np.int64)
                for rows, bucket in found:
                    sums = np.concatenate(([0], np.cumsum(table.take(bucket))))
                    ends = np.searchsorted(rows, np.arange(part.num_rows + 1))
                    total += sums[ends[1:]] - sums[ends[:-1]]
                    many += np.diff(ends)
                yield {"doc_id": part.column("doc_id"), "digest": part.column("digest"),
                       "n_words": n_words.astype(np.int64), "n_features": many,
                       "weight": np.where(many > 0, total // np.maximum(many, 1), 0)}

    return arrow_map(docs.select("doc_id", "digest", "text"), _WEIGHT, score)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Noise of a document, in thousandths, from its id alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    u = (h + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, max_n: int = MAX_N, buckets: int = BUCKETS,
         min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """``(doc_id, digest, n_words, n_features, weight, score, rank)`` for every
    row of ``docs``; ``rank`` is null for rows that are not drawn."""
    own = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(bucket_counts(own, max_n, buckets), bucket_counts(only(target, "text"), max_n, buckets), buckets)
    scored = weights(own.select("doc_id", F.xxhash64("text").alias("digest"), "text"), gain, max_n)
    scored = written(scored.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "imp-scored")
    fit = scored.filter(F.col("n_words") >= min_words)
    drawn = fit.count() * percent // 100
    order = (fit.withColumn("_down", -F.col("score")).withColumn("_none", F.col("doc_id").isNull())
             .withColumn("_tie", F.monotonically_increasing_id()))
    ranked = page_slices(order, ["_down", "_none", "doc_id", "_tie"])
    rank = F.when(F.col("row_index") <= drawn, F.col("row_index")).alias("rank")
    rest = scored.filter(F.col("n_words") < min_words)
    return ranked.select(*scored.columns, rank).union(rest.select("*", F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn documents with their own columns. Rows alike in doc_id and
    text stay together when one of them is drawn."""
    picked = (draw(docs, target, **how).filter("rank is not null")
              .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct())
    own, at = renamed(docs)
    hit = own.join(picked, own[at["doc_id"]].cast("long").eqNullSafe(picked["_id"])
                   & (F.xxhash64(own[at["text"]]) == picked["_digest"]), "left_semi")
    return hit.toDF(*docs.columns)


def op11_importance(spark, sf_dir: str) -> DataFrame:
    got = draw(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")
