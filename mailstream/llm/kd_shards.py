"""K-d tree partitioning of documents into shards of equal bytes, on DataFrame
functions alone.

Metadata spans the space: source, language, length and doc_id. A node that
stands for k shards is cut along its widest dimension (its spread as a share
of the whole table's) at the weighted quantile that gives floor(k/2) shards'
bytes to one side, until every leaf is one shard. All nodes of a level are cut
together, and medians are found by narrowing: each pass adds up the bytes in
``BINS`` bins of a node's open interval, which is a partial aggregate, and goes
on in the bin where the wanted share is crossed. Node tables stay on Spark;
only counts come to the driver.

Rows of equal text are one point of the space (its smallest values), so they
share a shard. A text whose copies together weigh more than 1/``PIECES`` of a
shard would spoil the balance: its rows are dealt into pieces below that
weight, which lie next to each other and may go apart. There are fewer than
shards * ``PIECES`` such texts, which bounds what is broadcast.

Defined cases: a null text has size 1 and equals the empty one; null source,
language, length or doc_id lie below all others; repeated rows are rows of
their own; a document larger than a shard fills its shard alone; an empty table
gives an empty result; extra columns are ignored by ``shard_documents`` and
kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mailstream.llm.common import only, renamed, written
from mailstream.operators.paging import page_slices

# Fixed value of the query.
SHARDS = 8
#: Bins of a node's interval in one pass.
BINS = 4096
#: A text is cut up when its copies weigh more than this part of a shard.
PIECES = 64
#: A cut may miss its share by this part of the node's bytes.
SLACK = 1 / 2048

_DIMS = ["x_source", "x_lang", "x_chars", "x_id"]
_TEXT = ["digest", "size", "text_crc32"]
_HALF = 1 << 31


def _position(c: Column, shared: int) -> Column:
    """Strings as numbers in their own order: the seven bytes after the
    ``shared`` leading characters that all values have in common."""
    seven = F.substring(F.encode(F.substring(c, shared + 1, 7), "utf-8"), 1, 7)
    return F.coalesce(F.conv(F.rpad(F.hex(seven), 14, "0"), 16, 10).cast("long"), F.lit(-1).cast("long"))


def _shared_length(low: str | None, high: str | None) -> int:
    """Leading characters that the smallest and the largest value share, and
    so all values between."""
    n = 0
    for a, b in zip(low or "", high or ""):
        if a != b:
            break
        n += 1
    return n


def _sized_rows(docs: DataFrame) -> DataFrame:
    d = only(docs, "doc_id", "text", "lang", "source", "n_chars")
    text = F.coalesce("text", F.lit(""))
    return written(d.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"),
                            (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
                            "lang", "source", F.col("n_chars").cast("long").alias("n_chars"),
                            F.monotonically_increasing_id().alias("_row")), "kd-rows")


def _in_pieces(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` with ``piece``: 0, or which piece of an over-heavy text."""
    heavy = (rows.groupBy(*_TEXT).agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > limit)
             .select(*_TEXT, F.ceil(F.col("bytes") / limit).alias("pieces")))
    cut = rows.join(F.broadcast(heavy), _TEXT, "left")
    return cut.withColumn("piece", F.when(F.col("pieces").isNull(), 0)
                          .otherwise(F.pmod(F.xxhash64("doc_id", "_row"), F.col("pieces"))).cast("long")).drop("pieces")


def _points(rows: DataFrame, shards: int) -> DataFrame:
    """One row per (text, piece): bytes ``w``, coordinates, and the root node."""
    low_s, high_s, low_l, high_l = rows.agg(F.min("source"), F.max("source"), F.min("lang"), F.max("lang")).first()
    none = F.lit(-1).cast("long")
    at = rows.select(*_TEXT, "piece", _position(F.col("source"), _shared_length(low_s, high_s)).alias("x_source"),
                     _position(F.col("lang"), _shared_length(low_l, high_l)).alias("x_lang"),
                     F.coalesce("n_chars", none).alias("x_chars"), F.coalesce("doc_id", none).alias("x_id"))
    return written(at.groupBy(*_TEXT, "piece").agg(F.sum("size").alias("w"), *[F.min(x).alias(x) for x in _DIMS])
                   .withColumn("first", F.lit(0)).withColumn("k", F.lit(shards)), "kd-points")


def _cuts_wanted(points: DataFrame, spread: list[float]) -> DataFrame:
    """``(first, k, dim, base, scale, goal, w_all)`` of the nodes to cut: the
    widest dimension, and the bytes that belong on the lower side."""
    per = points.filter("k > 1").groupBy("first", "k").agg(
        F.sum("w").alias("w_all"), *[f(x).alias(f"{p}{x}") for x in _DIMS for p, f in (("l", F.min), ("h", F.max))])
    wide = [(F.col(f"h{x}") - F.col(f"l{x}")).cast("double") / s for x, s in zip(_DIMS, spread)]
    dim = F.array_position(F.array(*wide), F.greatest(*wide)).cast("int") - 1
    of = lambda p: F.element_at(F.array(*[F.col(f"{p}{x}") for x in _DIMS]), F.col("dim") + 1)
    nodes = per.withColumn("dim", dim).withColumn("base", of("l")).withColumn(
        "scale", F.lit(float(_HALF)) / (of("h").cast("double") - of("l") + 1))
    return nodes.select("first", "k", "dim", "base", "scale", "w_all",
                        (F.col("w_all") * F.floor(F.col("k") / 2) / F.col("k")).alias("goal"))


def _key() -> Column:
    """A point's place along its node's dimension; points of one value are
    told apart by their text and piece."""
    x = F.element_at(F.array(*[F.col(d) for d in _DIMS]), F.col("dim") + 1)
    high = F.floor((x - F.col("base")).cast("double") * F.col("scale"))
    return high * F.lit(_HALF) + F.pmod(F.xxhash64(*_TEXT, "piece"), F.lit(_HALF))


def _medians(points: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(first, dim, base, scale, cut)``: keys below ``cut`` go to the lower
    side."""
    state = written(wanted.withColumn("lo", F.lit(0).cast("long")).withColumn("step", F.lit(_HALF * _HALF // BINS))
                    .withColumn("below", F.lit(0).cast("long")).withColumn("mass", F.col("w_all"))
                    .withColumn("open", F.lit(True)), "kd-state")
    done = []
    while True:
        open_ = state.filter("open")
        bin_ = F.floor((_key() - F.col("lo")) / F.col("step"))
        binned = (points.join(F.broadcast(open_), ["first", "k"]).withColumn("bin", bin_)
                  .filter(F.col("bin").between(0, BINS - 1)).groupBy("first", "bin").agg(F.sum("w").alias("s")))
        run = Window.partitionBy("first").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        crossed = (binned.withColumn("c", F.sum("s").over(run)).join(open_, "first")
                   .filter((F.col("below") + F.col("c") >= F.col("goal")) & (F.col("below") + F.col("c") - F.col("s") < F.col("goal"))))
        state = written(crossed.select(
            "first", "k", "dim", "base", "scale", "goal", "w_all", (F.col("lo") + F.col("bin") * F.col("step")).alias("lo"),
            F.col("step").alias("width"), F.greatest(F.lit(1), F.ceil(F.col("step") / BINS)).cast("long").alias("step"),
            (F.col("below") + F.col("c") - F.col("s")).alias("below"), F.col("s").alias("mass"),
            ((F.col("s") > F.col("w_all") * SLACK) & (F.col("step") > 1)).alias("open")), "kd-state")
        done.append(state.filter("not open"))
        if not state.filter("open").limit(1).count():
            break
    found = done[0]
    for d in done[1:]:
        found = found.union(d)
    over = F.col("below") + F.col("mass") - F.col("goal") < F.col("goal") - F.col("below")
    return found.select("first", "k", "dim", "base", "scale",
                        F.when(over, F.col("lo") + F.col("width")).otherwise(F.col("lo")).alias("cut"))


def assign_shards(points: DataFrame) -> DataFrame:
    """Cut level by level; ``first`` ends as the shard of every point."""
    edges = points.agg(*[f(x) for x in _DIMS for f in (F.min, F.max)]).first()
    spread = [max(1.0, float((edges[2 * i + 1] or 0) - (edges[2 * i] or 0))) for i in range(len(_DIMS))]
    while points.filter("k > 1").limit(1).count():
        cuts = written(_medians(points, _cuts_wanted(points, spread)), "kd-cuts")
        upper = _key() >= F.col("cut")
        low = F.floor(F.col("k") / 2).cast("int")
        cut = points.join(F.broadcast(cuts), ["first", "k"], "left").withColumn("_up", F.col("cut").isNotNull() & upper)
        points = written(cut.select(
            *_TEXT, "piece", "w", *_DIMS, (F.col("first") + F.when(F.col("_up"), low).otherwise(0)).alias("first"),
            F.when(F.col("cut").isNull(), 1).when(F.col("_up"), F.col("k") - low).otherwise(low).cast("int").alias("k")), "kd-points")
    return points


def shard_documents(docs: DataFrame, shards: int = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for every row; ``shards`` is
    taken from ``target_bytes`` when that is given."""
    rows = _sized_rows(docs)
    total = rows.agg(F.sum("size")).first()[0] or 0
    if target_bytes:
        shards = max(1, -(-total // target_bytes))
    rows = _in_pieces(rows, max(1, total // (shards * PIECES)))
    placed = assign_shards(_points(rows, shards)).select(*_TEXT, "piece", F.col("first").cast("int").alias("shard"))
    out = rows.select("doc_id", *_TEXT, "piece", "_row").join(placed, [*_TEXT, "piece"])
    numbered = page_slices(out.select("doc_id", "size", "text_crc32", "shard", "_row"), ["shard", "doc_id", "_row"])
    starts = numbered.groupBy("shard").agg(F.min("row_index").alias("_start"))
    # one row per shard
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row_index") - F.col("_start")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, target_bytes: int | None = None) -> None:
    """The documents with their own columns, one ``kd_shard`` folder each, in slot
    order within its files. Rows alike in doc_id and text go to one shard. A
    column whose name differs from an earlier one by letter case only is
    written with a number behind it."""
    own, at = renamed(docs)
    text = F.coalesce(own[at["text"]], F.lit(""))
    placed = shard_documents(docs, shards, target_bytes).groupBy("doc_id", "size", "text_crc32").agg(
        F.min("shard").alias("kd_shard"), F.min("slot").alias("kd_slot"))
    hit = own.join(placed, own[at["doc_id"]].cast("long").eqNullSafe(placed["doc_id"])
                   & (F.octet_length(text) + 1 == placed["size"]) & (F.crc32(F.encode(text, "utf-8")) == placed["text_crc32"]))
    names: list[str] = []
    for c in docs.columns:
        clash = sum(c.lower() == n.lower() for n in docs.columns[:len(names)])
        names.append(f"{c}_{clash + 1}" if clash else c)
    kept = hit.select(*own.columns, "kd_shard", "kd_slot").toDF(*names, "kd_shard", "kd_slot")
    kept.repartitionByRange("kd_shard", "kd_slot").sortWithinPartitions("kd_shard", "kd_slot").drop("kd_slot") \
        .write.partitionBy("kd_shard").parquet(path)


def op12_shards(docs: DataFrame) -> DataFrame:
    got = shard_documents(docs)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast(T.IntegerType()).alias("grown_shard"))
