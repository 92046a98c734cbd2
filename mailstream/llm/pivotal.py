"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target ``T`` and size ``S`` should be taken
``T / S`` times; the whole part is taken for sure, the fraction is a copy
probability that is rounded by the pivotal method: two fractional documents
trade words (the sum of probability x size stays as it is) until one of them
is integral, with odds that keep both expectations. Documents are dealt into
bins of about ``BIN`` units; each bin leaves at most one fractional document,
and the residuals of ``BIN`` bins meet in the next level of a reduction tree,
until one per source is left, which a single draw rounds. So each source's
taken words differ from its target by less than one document.

Draws are hashes of (seed, level, document), so reruns agree whatever the
partitioning.

Defined cases: a null text has size 0 and nothing taken; a null source is a
source of its own, last in order; rows that agree in doc_id, source and size
are one unit, whose copies are dealt evenly to its rows (they differ by at most
one, and only one row's worth is drawn by chance); all sizes 0 give targets 0; an
empty table gives an empty result; extra columns are ignored (kept by
``materialise_mix``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import count_words, written
from mailstream.operators.paging import page_slices
from mailstream.session import ship_package

# Fixed values of the mix.
WEIGHTS = (3, 1, 2)
TOTAL_PERCENT = 150
MAX_COPIES = 2

#: Units in one bin of the reduction tree, and bins under one parent.
BIN = 512
SEED = 7

_UNIT = ["source", "doc_id", "size"]


def source_targets(sizes: DataFrame, total_percent: int = TOTAL_PERCENT, weights=WEIGHTS,
                   max_copies: int = MAX_COPIES) -> DataFrame:
    """``(source, source_size, units, target)``. Targets are
    ``min(max_copies * size, level * weight)``: resharing an excess by weight
    raises all open sources to one common level, which is found by closing the
    sources above their limit until none is left; each step is one aggregate."""
    per = written(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"),
                                              F.count(F.lit(1)).alias("units")), "mix-sources")
    ranked = page_slices(per.withColumn("_last", F.col("source").isNull()), ["_last", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.col("row_index") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = written(ranked.select("source", "source_size", "units", weight.alias("weight")), "mix-sources")
    limit = F.col("source_size") * max_copies
    words = s.agg(F.sum("source_size")).first()[0] or 0
    goal, level = words * total_percent / 100, 0.0
    while words:
        closed = limit <= F.lit(level) * F.col("weight")
        full, rest = s.agg(F.sum(F.when(closed, limit)), F.sum(F.when(~closed, F.col("weight")))).first()
        raised = (goal - (full or 0)) / rest if rest else level
        if raised <= level:
            break
        level = raised
    return s.select("source", "source_size", "units",
                    F.least(limit.cast("double"), F.lit(float(level)) * F.col("weight")).alias("target"))


def pivot(p: list, size: list, draw: list) -> int:
    """Round the fractions ``p`` in place, trading words between the one open
    item and the next; returns the index of the item left open, or -1."""
    open_ = -1
    for j in range(len(p)):
        if p[j] <= 0.0 or p[j] >= 1.0 or size[j] <= 0:
            continue
        if open_ < 0:
            open_ = j
            continue
        i = open_
        up = min((1.0 - p[i]) * size[i], p[j] * size[j])      # words i may gain from j
        down = min(p[i] * size[i], (1.0 - p[j]) * size[j])    # words i may give to j
        gain = up if draw[j] * (up + down) < down else -down
        a, b = p[i] + gain / size[i], p[j] - gain / size[j]
        p[i], p[j] = _snap(a), _snap(b)
        open_ = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return open_


def _snap(x: float) -> float:
    return 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x


_ROUND = T.StructType([T.StructField("source", T.StringType()), T.StructField("doc_id", T.LongType()),
                       T.StructField("size", T.LongType()), T.StructField("rows", T.LongType()),
                       T.StructField("whole", T.IntegerType()), T.StructField("p", T.DoubleType()),
                       T.StructField("bin", T.LongType()), T.StructField("open", T.BooleanType())])


def _draw(seed: int, k: int):
    """A number in [0, 1) that depends on the seed, ``k`` and the unit only."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(k), "doc_id", "size"), 11) / float(1 << 53)


def _round_bins(rows: DataFrame, level: int, seed: int) -> DataFrame:
    """One level: every (source, bin) is rounded down to one open unit."""
    ship_package(rows.sparkSession)

    def one(pdf):
        pdf = pdf.sort_values(["turn", "doc_id", "size"], kind="stable")
        p = pdf["p"].tolist()
        rest = pivot(p, pdf["size"].tolist(), pdf["draw"].tolist())
        return pdf.assign(p=p, open=[k == rest for k in range(len(p))]).drop(columns=["turn", "draw"])

    return (rows.withColumn("turn", _draw(seed, 2 * level)).withColumn("draw", _draw(seed, 2 * level + 1))
            .groupBy("source", "bin").applyInPandas(one, _ROUND))


def rounded_units(units: DataFrame, seed: int = SEED, fan: int = BIN) -> DataFrame:
    """``units(source, doc_id, size, rows, expected, units)`` -> the same units with
    an integral number of ``copies``; ``expected`` and ``copies`` are those of
    all the unit's rows together, so at most one row of a unit is fractional."""
    whole = F.floor("expected")
    start = units.select("source", "doc_id", "size", "rows", whole.cast("int").alias("whole"),
                         (F.col("expected") - whole).alias("p"),
                         F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.ceil(F.col("units") / fan)).alias("bin"))
    most = units.agg(F.max("units")).first()[0] or 0
    done, level, bins = [], 0, -(-most // fan)
    rows = start
    while True:
        rows = written(_round_bins(rows, level, seed), "mix-level")
        done.append(rows.filter("not open"))
        rest = rows.filter("open").drop("open")
        if bins <= 1:
            break
        rows, bins, level = rest.withColumn("bin", F.floor(F.col("bin") / fan)), -(-bins // fan), level + 1
    out = rest.withColumn("p", F.when(_draw(seed, -1) < F.col("p"), 1.0).otherwise(0.0))
    for d in done:
        out = out.unionByName(d.drop("open"))
    return out.select(*_UNIT, "rows", (F.col("whole") + F.round("p").cast("int")).alias("copies"))


def plan_mix(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """``sized(doc_id, source, size)`` -> units with ``rows`` (how many rows
    each stands for), ``copies`` of them together, ``source_size`` and
    ``target``."""
    units = written(sized.groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    targets = written(source_targets(units), "mix-targets")
    t = targets.select(F.col("source").alias("_s"), "source_size", "units", "target")
    rated = units.join(t, units["source"].eqNullSafe(t["_s"]))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    got = rounded_units(rated.withColumn("expected", F.when(F.col("size") > 0, share * F.col("rows")).otherwise(0.0)), seed)
    return got.join(t.drop("units"), got["source"].eqNullSafe(t["_s"])).drop("_s")


def _repeated(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of ``rows`` whose unit stands for several, with ``copies`` of
    the row: a unit's copies are dealt out evenly. The rows of a unit follow
    each other in a distributed numbering, so their numbers modulo ``rows`` are
    all different and no unit is gathered anywhere."""
    p = plan.filter("rows > 1").select(*[F.col(c).alias(f"_{c}") for c in _UNIT], F.col("rows").alias("_rows"),
                                       F.col("copies").alias("_copies"))
    hit = rows.join(p, rows["doc_id"].eqNullSafe(p["_doc_id"]) & rows["source"].eqNullSafe(p["_source"])
                    & (rows["size"] == p["_size"])).drop(*[f"_{c}" for c in _UNIT])
    numbered = page_slices(hit.withColumn("_tie", F.monotonically_increasing_id()), ["source", "doc_id", "size", "_tie"])
    more = F.col("row_index") % F.col("_rows") < F.col("_copies") % F.col("_rows")
    return numbered.select(*rows.columns, (F.floor(F.col("_copies") / F.col("_rows")) + more.cast("int")).cast("int").alias("copies"))


def op2_mixed_sources(docs: DataFrame) -> DataFrame:
    """One row per document: size, its source's size and target, words taken."""
    sized = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                                count_words(F.col("text")).alias("size")), "mix-sized")
    plan = written(plan_mix(sized), "mix-plan")
    of = plan.groupBy(F.col("source").alias("_s")).agg(F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    many = _repeated(sized, plan)
    many = many.join(of, many["source"].eqNullSafe(of["_s"])).drop("_s")
    cols = ["doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "copies"]
    return plan.filter("rows = 1").select(*cols).union(many.select(*cols))


def materialise_mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Pipeline form: every document as many times as the mix takes it."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    own = docs.toDF(*names)
    sized = own.select("*", own[at["doc_id"]].cast("long").alias("doc_id"), own[at["source"]].alias("source"),
                       count_words(own[at["text"]]).alias("size"))
    plan = plan_mix(sized.select(*_UNIT), seed).select(*_UNIT, "rows", "copies")
    # the units of one row and the others are tables of their own, with nothing
    # but what the join needs, so that the join with the texts knows their size
    plan = written(plan.withColumn("_one", F.col("rows") == 1), "mix-plan").filter("copies > 0")
    p = written(plan.filter("_one").select(*[F.col(c).alias(f"_{c}") for c in _UNIT], "copies"), "mix-single")
    several = written(plan.filter("not _one").drop("_one"), "mix-several")
    # p has a row for each document: it grows with the texts and is shuffled with
    # them at every size, so that the join does not change its kind on the way
    p = p.hint("shuffle_hash")
    hit = sized.join(p, sized["doc_id"].eqNullSafe(p["_doc_id"]) & sized["source"].eqNullSafe(p["_source"])
                     & (sized["size"] == p["_size"])).select(*sized.columns, "copies")
    hit = hit.unionByName(_repeated(sized, several))
    # at most MAX_COPIES of a row
    out = hit.filter("copies > 0").withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*names).toDF(*docs.columns)
