"""Quality classifier: supervised subword embeddings.

Words and character 3- and 4-grams are hashed to buckets; each bucket has a
learned vector, a document is the mean of its features' vectors, and a softmax
layer gives the classes. Trained by numpy stochastic gradient descent on a
bounded sample of labelled rows (``TRAIN_ROWS``, by hash of doc_id); features of
whole texts are counted in tasks, so the driver only gets bucket counts (at
most ``BUCKETS`` for a row). As the layer is linear, scoring needs one number
per bucket: the mean of the features' class margins.

Labels come only from rows whose crc32(doc_id) mod 4 is not 2; the rest is held
out. ``lang``, ``source`` and ``doc_id`` are never inputs of a score.

Defined cases: a null or empty text has no features and scores the learned
prior; without labelled rows every score is 0.5; null labels are left out; a
null doc_id is not held out; repeated rows score alike; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import map_rows, table

#: Labelled rows used for training, at most.
TRAIN_ROWS = 2000
WORD_BUCKETS = GRAM_BUCKETS = 1 << 15
BUCKETS = WORD_BUCKETS + GRAM_BUCKETS
GRAMS = (3, 4)
DIM, EPOCHS, RATE, SEED = 16, 4, 0.25, 11

# Fixed values of the query.
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7

_TIMES = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F], dtype=np.uint32)


def features(text: str) -> np.ndarray:
    """Bucket of every word and n-gram of a text, with repeats."""
    from mailstream.llm.shingles import word_hashes
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    out = [(word_hashes(text) >> np.uint64(49)).astype(np.uint32)]
    for n in GRAMS:
        if len(raw) >= n:
            h = np.full(len(raw) - n + 1, n, dtype=np.uint32)
            for k in range(n):
                h = (h ^ raw[k:len(raw) - n + 1 + k]) * _TIMES[k]
                h ^= h >> np.uint32(15)
            out.append((h * _TIMES[0] >> np.uint32(17)) + np.uint32(WORD_BUCKETS))
    return np.concatenate(out)


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, float]:
    """Rows of (buckets, counts, label) -> (margin of each bucket, bias).

    Plain SGD; the step on the vectors is divided by the squared feature
    weights, so a document's mean moves as far whatever its length."""
    rng = np.random.default_rng(SEED)
    vec = rng.uniform(-1 / DIM, 1 / DIM, size=(BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.1, size=(2, DIM)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            ids, counts, label = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            g = np.zeros(2, dtype=np.float32)
            w = (counts / max(1, counts.sum())).astype(np.float32)
            x = w @ vec[ids] if len(ids) else np.zeros(DIM, dtype=np.float32)
            z = out @ x + bias
            p = np.exp(z - z.max())
            g = p / p.sum()
            g[label] -= 1
            if len(ids):
                vec[ids] -= (rate / float(w @ w)) * w[:, None] * (g @ out)[None, :]
            out -= rate * np.outer(g, x)
            bias -= rate * g
    return vec @ (out[1] - out[0]), float(bias[1] - bias[0])


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


_COUNTED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()),
                         T.StructField("ids", T.BinaryType()), T.StructField("counts", T.BinaryType())])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    marked = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~_held_out(F.col("id")))
              .groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the sample is at most ``rows`` pairs of numbers, so it may be broadcast
    sample = own.join(F.broadcast(marked), own["doc_id"] == marked["id"]).select("doc_id", "label", "text")

    def count(batch):
        for r in batch:
            ids, counts = np.unique(features(r["text"] or ""), return_counts=True)
            yield {"doc_id": r["doc_id"], "label": r["label"], "ids": ids.astype(np.uint32).tobytes(),
                   "counts": counts.astype(np.uint32).tobytes()}

    got = map_rows(sample, _COUNTED, count).dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    data = [(np.frombuffer(r["ids"], np.uint32), np.frombuffer(r["counts"], np.uint32), r["label"]) for r in got]
    return fit(data) if data else (np.zeros(BUCKETS, dtype=np.float32), 0.0)


_SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``(doc_id, score)``: probability of label 1. A narrow map; the model
    (one number per bucket) travels with the task."""
    margin, bias = model

    def rows(batch):
        for r in batch:
            f = features(r["text"] or "")
            z = bias + (float(margin[f].mean(dtype=np.float64)) if len(f) else 0.0)
            yield {"doc_id": r["doc_id"], "score": 1 / (1 + float(np.exp(-z)))}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _SCORED, rows)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    s = score(docs, model)
    return s.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
