"""Document fingerprints from content-defined chunks.

A gear hash rolls over the UTF-8 bytes; a chunk ends where masked bits of the
hash are zero, with a harder mask before the normal size and an easier one
after it (normalised chunking), so an edit moves only the boundaries near it.
A fingerprint is the set of chunk digests, weighted by chunk length; two
texts are compared by containment: the shared length over the first's length.

The edited text of the query needs each document's successor in doc_id order.
Documents are range-partitioned by (doc_id, text hash) once and streamed in
order; the first document of each partition and the unfinished last one go
through a small second step (two rows for each partition), so no text is moved
twice and no task holds more than two documents and one Arrow batch.

Defined cases: a null text is empty; an empty text has an empty fingerprint,
which only an empty one contains (likeness 1); null doc_ids come first and ties go by
text hash; a table of one document is its own successor; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import written
from mailstream.session import ship_package

#: Chunk sizes in bytes, and the mask bits before and after the normal size.
MIN_SIZE, NORMAL_SIZE, MAX_SIZE = 24, 64, 256
HARD_BITS, EASY_BITS = 7, 4

_GEAR = np.random.default_rng(99).integers(0, 2**32, size=256, dtype=np.uint32)
_HARD = np.uint32((1 << HARD_BITS) - 1 << 32 - HARD_BITS)
_EASY = np.uint32((1 << EASY_BITS) - 1 << 32 - EASY_BITS)


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """Gear hash after each byte: sum of gear[b[i-k]] << k over the last 32
    bytes, by doubling the window."""
    h = _GEAR[raw]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            add = h[:-step] << np.uint32(step)
            h = h.copy()
            h[step:] += add
    return h


def cut_points(raw: np.ndarray) -> list[int]:
    """Ends of the chunks."""
    n, at, out = len(raw), 0, []
    if not n:
        return out
    h = gear_hashes(raw)
    easy = np.flatnonzero((h & _EASY) == 0) + 1
    hard = np.flatnonzero((h & _HARD) == 0) + 1
    easy_list, hard_list = easy.tolist() + [n], hard.tolist() + [n]
    i = j = 0
    while at < n:
        first, normal, last = at + MIN_SIZE, at + NORMAL_SIZE, min(at + MAX_SIZE, n)
        while hard_list[i] < first and hard_list[i] < n:
            i += 1
        end = hard_list[i]
        if end >= normal:
            while easy_list[j] < normal and easy_list[j] < n:
                j += 1
            end = easy_list[j]
        at = min(end, last)
        out.append(at)
    return out


def chunk_set(data: bytes) -> dict[int, int]:
    """Digest -> length of the distinct chunks of a text."""
    from xxhash import xxh3_64_intdigest
    start, out = 0, {}
    for end in cut_points(np.frombuffer(data, dtype=np.uint8)):
        out[xxh3_64_intdigest(data[start:end])] = end - start
        start = end
    return out


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of a's weight that b holds; 1 for two empty sets, else 0 for an
    empty a."""
    total = sum(a.values())
    if not total:
        return 1.0 if not b else 0.0
    return sum(n for d, n in a.items() if d in b) / total


def digest(s: dict[int, int]) -> str:
    """Short form of a fingerprint: equal sets, equal strings."""
    return hashlib.blake2b(",".join(f"{d:016x}:{n}" for d, n in sorted(s.items())).encode(), digest_size=16).hexdigest()


def edit(text: str, following: str) -> str:
    """The last quarter replaced by as much of the next document's start."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


_CHUNKS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
                        T.StructField("fingerprint", T.StringType()),
                        T.StructField("chunks", T.ArrayType(T.StructType([
                            T.StructField("digest", T.LongType()), T.StructField("length", T.IntegerType())])))])


def fingerprints(docs: DataFrame) -> DataFrame:
    """General form: ``(doc_id, n_chars, fingerprint, chunks)`` of every text."""
    from mailstream.llm.common import map_rows

    def rows(batch):
        for r in batch:
            text = r["text"] or ""
            s = chunk_set(text.encode("utf-8", "surrogatepass"))
            yield {"doc_id": r["doc_id"], "n_chars": len(text), "fingerprint": digest(s),
                   "chunks": [{"digest": d - (1 << 64) if d >> 63 else d, "length": n} for d, n in s.items()]}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _CHUNKS, rows)


# What the ordered pass writes: finished rows, and for each partition its
# first text ("head") and the last document that lacks a successor ("tail").
_PASS = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("part", T.IntegerType()),
    T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
    T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
    T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
    T.StructField("near_next", T.DoubleType()), T.StructField("text", T.StringType())])
_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare(doc_id, text: str, own: dict, following: str, next_set: dict) -> dict:
    changed = edit(text, following)
    data = changed.encode("utf-8", "surrogatepass")
    e = chunk_set(data)
    return {"doc_id": doc_id, "n_chars": len(text), "edited_sha256": hashlib.sha256(data).hexdigest(),
            "fingerprint": digest(own), "edited_fingerprint": digest(e),
            "near_edited": containment(own, e), "near_next": containment(own, next_set)}


def _set_of(text: str) -> dict:
    return chunk_set(text.encode("utf-8", "surrogatepass"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against its edited text's and its
    successor's."""
    import pyarrow as pa
    from pyspark import TaskContext
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(docs.sparkSession)
    schema = to_arrow_schema(_PASS)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = (own.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h")
               .sortWithinPartitions("doc_id", "h").select("doc_id", "text"))

    def run(batches):
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                s = _set_of(text)
                if held is None:
                    rows.append({"kind": "head", "part": part, "text": text})
                else:
                    rows.append({"kind": "row", "part": part} | _compare(*held, text, s))
                held = (doc_id, text, s)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist(
                [{"kind": "tail", "part": part, "doc_id": held[0], "text": held[1]}], schema=schema)

    done = written(ordered.mapInArrow(run, _PASS), "print-pass")
    # one head and one tail for each partition that has rows; each tail meets
    # the next such partition's head, the last one the first's
    parts = [r[0] for r in done.filter("kind = 'head'").select("part").sort("part").collect()]
    follow = dict(zip(parts, parts[1:] + parts[:1]))
    to = docs.sparkSession.createDataFrame(list(follow.items()), "part int, next int")
    heads = done.filter("kind = 'head'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    tails = (done.filter("kind = 'tail'").select("part", "doc_id", "text").join(to, "part").join(heads, "next")
             .select("doc_id", "text", "following"))
    out_schema = T.StructType([f for f in _PASS if f.name in _RESULT])
    arrow = to_arrow_schema(out_schema)

    def finish(batches):
        for batch in batches:
            rows = [_compare(r["doc_id"], r["text"], _set_of(r["text"]), r["following"], _set_of(r["following"]))
                    for r in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return done.filter("kind = 'row'").select(*_RESULT).unionByName(tails.mapInArrow(finish, out_schema))


def op3_chunk_fingerprints(docs: DataFrame) -> DataFrame:
    return compare_with_next(docs.select("doc_id", "text"))
