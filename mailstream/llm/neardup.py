"""MinHash near-duplicates by tensored banding.

A plain index of L tables needs a fresh MinHash band for each table. Here two
sides of ``m`` small collections are computed and table (i, j) is keyed by the
pair (u_i, v_j): m * m tables from 2 * m collections. With k MinHashes in a
collection a pair of similarity s meets in some table with probability
(1 - (1 - s**k)**m)**2; m = 16, k = 3 give 0.9997 at s = 0.75 and 0.99998 at
0.8, and documents of one group usually have several ways to meet.

Steps:

1. ``signatures``: shingle sets and collections, in one narrow pass; equal
   sets become one class, represented by its smallest doc_id.
2. Collections that no other class shares cannot key a table with two
   members; they are dropped first, so documents without a near copy emit
   nothing.
3. A class's shingles that occur in another candidate bound every overlap it
   can have. Pairs out of reach by such exact bounds are never compared.
4. Candidates. Tables (u, v) are grouped by their u: a class is one row for
   each u, and the key (u, v) is formed when two classes of a u meet, so the
   256 keys of a class are never written out. Each bucket compares its members
   with one hub (the member that shares most collections: a group's original
   rather than one of its copies). Links are confirmed on full sets and joined to components. Buckets
   whose members still lie in several components go on. An overlap is at most
   the smaller count of frequent shingles (those of more than ``RARE``
   candidates) plus the shared rare ones: pairs that share rare shingles are
   found by them, each meeting ``RARE`` classes at most; pairs that frequent
   shingles alone could link are compared in their buckets, at once where
   that is little work, else hub by hub. A hub is done with its bucket. When
   a round does not halve the work, what is left is compared too, but for
   members out of reach of a component: the frequent shingles that a member
   shares with all of a component together bound its overlap with each of
   them. Two edited copies of one original share its
   text but not their edits, and go apart without a comparison, so a group of
   n copies costs about n comparisons. Nothing is capped.
5. Components; labels go back to every row through its class.

Defined cases: a null, empty or blank text has an empty set and links with
nothing; a row without doc_id links with nothing and has component null; rows
that share a doc_id are one node; an empty table gives an empty result; extra columns
are ignored (and kept by ``keep_one``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import map_rows, written
from mailstream.llm.components import components

# Fixed value: links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Collections on each side, and MinHashes in a collection.
SIDE, DEPTH = 16, 3
#: Members compared with one hub in one group of rows; a larger star is split.
STAR = 32
#: All remaining pairs across components are tested at once when they are at
#: most this many for each bucket member on average; else another hub round.
AT_ONCE = 16
#: A shingle that more candidates share than this counts as frequent.
RARE = 48
#: Components of this many open members are bounded as one.
WIDE = 32

_SIG = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
                     T.StructField("digest", T.BinaryType()), T.StructField("cols", T.ArrayType(T.LongType()))])
_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def signatures(docs: DataFrame, side: int = SIDE, depth: int = DEPTH) -> DataFrame:
    """``(doc_id, n_shingles, digest, cols)`` for every row."""
    def rows(batch):
        from mailstream.llm.shingles import HalfSignatures, set_digest, shingle_set
        sign = HalfSignatures(side, depth)
        for r in batch:
            s = shingle_set(r["text"])
            yield {"doc_id": r["doc_id"], "n_shingles": len(s), "digest": set_digest(s),
                   "cols": sign(s).tolist() if len(s) else []}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _SIG, rows)


def _shared_collections(classes: DataFrame) -> DataFrame:
    """``(rep, lo, hi, score, us, vs)``: the collection values that at least
    two classes share; ``score`` adds up how many classes share them. ``lo`` and
    ``hi`` are the set sizes (they differ only when rows of one doc_id have
    different texts). A class is 32 rows on the way, so they hold nothing but
    the value; sizes are joined once for each rep."""
    values = classes.select("rep", F.posexplode("cols").alias("pos", "v")).select(
        "rep", F.xxhash64("pos", "v").alias("c"), (F.col("pos") < SIDE).alias("first"))
    counts = written(values.groupBy("c").agg(F.count(F.lit(1)).alias("shared")).filter("shared > 1"), "nd-shared")
    side = lambda cond: F.collect_list(F.when(cond, F.col("c")))  # noqa: E731  nulls are left out
    hit = (values.join(counts, "c").groupBy("rep")
           .agg(F.sum("shared").alias("score"), side(F.col("first")).alias("us"), side(~F.col("first")).alias("vs"))
           .filter((F.size("us") > 0) & (F.size("vs") > 0)))
    # classes differ in their text, so a rep of several has no one size
    of = classes.groupBy(F.col("rep").alias("id")).agg(
        F.min("n").alias("lo"), F.when(F.count(F.lit(1)) == 1, F.max("n")).otherwise(F.max("n") + 1).alias("hi"))
    return written(hit.join(of, hit["rep"] == of["id"]).select("rep", "lo", "hi", "score", "us", "vs"), "nd-profiles")


def _several(sig: DataFrame) -> DataFrame:
    """``(id, least, most, mixed)`` of the doc_ids that more than one row has;
    ``mixed`` when their sets differ."""
    return written(sig.filter("n_shingles > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("id"))
                   .agg(F.count(F.lit(1)).alias("k"), F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"),
                        (F.min("digest") != F.max("digest")).alias("mixed")).filter("k > 1").drop("k"), "nd-several")


def _candidate_texts(own: DataFrame, profiles: DataFrame, several: DataFrame) -> DataFrame:
    """``(doc_id, text, again)``: each text of every class that shares a table,
    once; ``again`` marks the doc_ids that more than one row has."""
    reps = profiles.select("rep").join(several, profiles["rep"] == several["id"], "left")
    # written, so that the join knows its size: the texts are not shuffled to meet few classes
    reps = written(reps.select("rep", F.col("id").isNotNull().alias("again")), "nd-reps")
    of = lambda again: own.join(reps.filter(F.col("again") == again), own["doc_id"] == F.col("rep")) \
        .select("doc_id", "text", "again")
    return written(of(False).union(of(True).distinct()), "nd-texts")


_SHINGLES = T.StructType([T.StructField("rep", T.LongType()), T.StructField("s", T.ArrayType(T.LongType()))])


def _shingle_rows(texts: DataFrame, *more: str) -> DataFrame:
    """``(s, rep)`` and the number columns ``more`` of ``texts``: every shingle
    of every candidate class, once."""
    def rows(batch):
        from mailstream.llm.shingles import shingle_set
        for r in batch:
            yield {"rep": r["doc_id"], "s": shingle_set(r["text"]).view("int64").tolist(), **{m: r[m] for m in more}}

    schema = T.StructType([*_SHINGLES, *[T.StructField(m, T.LongType()) for m in more]])
    of = lambda t: map_rows(t.select("doc_id", "text", *more), schema, rows).select(
        F.explode("s").alias("s"), "rep", *more)
    return of(texts.filter(~F.col("again"))).union(of(texts.filter("again")).distinct())


def _common_sizes(profiles: DataFrame, texts: DataFrame) -> DataFrame:
    """``(rep, n, bound, score, us, vs)``: ``bound`` is how many of a class's
    shingles occur in another candidate class too, an upper bound of any
    overlap. Each shingle is counted once over all candidates; one that
    occurs once belongs to one class only, which it is charged to. Classes
    whose bound excludes every partner are left out."""
    own = (_shingle_rows(texts).groupBy("s").agg(F.count(F.lit(1)).alias("k"), F.min("rep").alias("rep")).filter("k = 1")
           .groupBy(F.col("rep").alias("id")).agg(F.count(F.lit(1)).alias("own")))
    bound = F.when(F.col("lo") == F.col("hi"), F.col("lo") - F.coalesce("own", F.lit(0))).otherwise(F.col("hi"))
    return written(profiles.join(own, profiles["rep"] == own["id"], "left")
                   .select("rep", F.col("lo").alias("n"), bound.alias("bound"), "score", "us", "vs")
                   .filter(_reach(F.col("bound"), F.col("bound"), F.col("n"), F.ceil(F.col("n") * PERCENT / 100))),
                   "nd-sizes")


def _rare_shingles(texts: DataFrame) -> DataFrame:
    """``(s, rep)`` of the shingles that 2 to ``RARE`` candidates share."""
    seen = _shingle_rows(texts)
    few = written(seen.groupBy("s").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k").between(2, RARE)).select("s"),
                  "nd-few")
    return written(seen.join(few, "s"), "nd-rare")


def _rare_pairs(rare: DataFrame, reps: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of a class of ``reps`` with any that shares rare shingles, when
    those and the smaller bound on the frequent ones could be enough. A
    shingle meets at most ``RARE`` classes, so this grows with the input."""
    x = rare.join(reps, "rep", "left_semi").select("s", F.col("rep").alias("a"))
    y = rare.select("s", F.col("rep").alias("b"))
    met = x.join(y, "s").filter("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("r"))
    one = lambda p: sizes.select(F.col("rep").alias(p), F.col("n").alias(f"{p}n"), F.col("bound").alias(f"{p}f"))
    p = written(met, "nd-met").join(one("a"), "a").join(one("b"), "b")
    return (p.filter(_reach(F.col("af") + F.col("r"), F.col("bf") + F.col("r"), F.col("an"), F.col("bn")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _reach(bound_a: Column, bound_b: Column, a: Column, b: Column) -> Column:
    """Whether an overlap of the smaller bound would do for sizes a, b."""
    return (100 + PERCENT) * F.least(bound_a, bound_b) >= PERCENT * (a + b)


def _members(profiles: DataFrame) -> DataFrame:
    """``(key, rep, n, bound, score, label)``: one row for each collection of
    the first side that a class has; a class is its own label at first. A row
    stands for the tables (u, v) of its u: ``_in_a_table`` forms the v part
    for pairs only, so a class is 16 rows here and not 256."""
    return profiles.select(F.explode("us").alias("key"), "rep", "n", "bound", "score", F.col("rep").alias("label"))


def _in_a_table(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The ``(a, b)`` pairs, which share a u, that share a v as well, so some
    table key (u, v)."""
    vs = lambda p: sizes.select(F.col("rep").alias(p), F.col("vs").alias(f"{p}vs"))
    return pairs.join(vs("a"), "a").join(vs("b"), "b").filter(F.arrays_overlap("avs", "bvs")).select("a", "b")


def _hubs(members: DataFrame) -> DataFrame:
    """``(key, size, hub, hub_n, hub_bound, hub_label)``: the best member of
    each bucket."""
    return (members.groupBy("key")
            .agg(F.count(F.lit(1)).alias("size"),
                 F.max(F.struct("score", (-F.col("rep")).alias("r"), "n", "bound", "label")).alias("h"))
            .select("key", "size", (-F.col("h.r")).alias("hub"), F.col("h.n").alias("hub_n"),
                    F.col("h.bound").alias("hub_bound"), F.col("h.label").alias("hub_label")))


def _hub_pairs(members: DataFrame, hubs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of each bucket's hub with its members of other components that
    share a table with it."""
    met = (members.join(hubs.drop("size"), "key")
           .filter((F.col("label") != F.col("hub_label"))
                   & _reach(F.col("bound"), F.col("hub_bound"), F.col("n"), F.col("hub_n")))
           .select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    return _in_a_table(met, sizes)


def _open_members(members: DataFrame, labels: DataFrame, used: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with ``label``,
    and the bucket's most frequent label (``main``), size and smallest set.
    ``outside`` marks members of other components than the main one that some
    member could still match. Hubs (``used``) were compared with their whole
    bucket and are not among its members any more."""
    m = members.join(used, (members["key"] == used["key"]) & (members["rep"] == used["hub"]), "left_anti").drop("label")
    m = m.join(labels, m["rep"] == labels["node"], "left")
    m = m.select("key", "rep", "n", "bound", "score", F.coalesce("label", "rep").alias("label"))
    per = m.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("least"))
    open_ = written(per.groupBy("key").agg(F.sum("c").alias("size"), F.max(F.struct("c", "label")).alias("top"),
                                           F.min("least").alias("least"), F.count(F.lit(1)).alias("parts"))
                    .filter("parts > 1").select("key", "size", "least", F.col("top.label").alias("main")), "nd-open")
    fits = _reach(F.col("bound"), F.col("bound"), F.col("n"),
                  F.greatest(F.col("least"), F.ceil(F.col("n") * PERCENT / 100)))
    return m.join(open_, "key").withColumn("outside", (F.col("label") != F.col("main")) & fits)


def _near_components(open_: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(bl)``: the components of ``WIDE`` and more open members, and ``(a,
    bl)``: the members outside that could match one of them by frequent
    shingles, because those that they share with any of its members are not too
    few. Shingles are counted by component before anything is joined with
    them."""
    who = open_.groupBy("rep").agg(F.max("n").alias("n"), F.max("label").alias("label"), F.max("outside").alias("out"))
    who = written(who, "nd-who")
    wide = written(who.groupBy(F.col("label").alias("bl")).agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("c"))
                   .filter(F.col("c") >= WIDE).drop("c"), "nd-wide")
    held = open_.join(wide, F.col("label") == F.col("bl"), "left_semi").select("key", F.col("label").alias("bl")).distinct()
    met = open_.filter("outside").select("key", F.col("rep").alias("a"), F.col("n").alias("an"), F.col("label").alias("al"))
    asked = written(met.join(held, "key").filter("al <> bl").select("a", "an", "bl").distinct().join(wide, "bl"), "nd-asked")
    label = who.select("rep", F.col("label").cast("long").alias("label"))
    by_part = written(_shingle_rows(texts.join(label, texts["doc_id"] == label["rep"], "left").drop("rep"), "label")
                      .groupBy("s", "label").agg(F.count(F.lit(1)).alias("k")), "nd-by-component")
    often = by_part.groupBy("s").agg(F.sum("k").alias("k")).filter(F.col("k") > RARE).select("s")
    held = (by_part.select("s", F.col("label").alias("bl")).join(wide.select("bl"), "bl", "left_semi")
            .join(often, "s", "left_semi"))
    asking = asked.select(F.col("a").alias("_a")).distinct()
    own = _shingle_rows(texts.join(asking, texts["doc_id"] == asking["_a"], "left_semi")).withColumnRenamed("rep", "a")
    shared = own.join(written(held, "nd-held"), "s").groupBy("a", "bl").agg(F.count(F.lit(1)).alias("shared"))
    one = F.coalesce("shared", F.lit(0))
    reach = _reach(one, one, F.col("an"), F.greatest("least", F.ceil(F.col("an") * PERCENT / 100)))
    return wide.select("bl"), written(asked.join(shared, ["a", "bl"], "left").filter(reach).select("a", "bl"), "nd-near")


def _cross_pairs(open_: DataFrame, sizes: DataFrame,
                 near: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """All pairs across components that share a table and could match: members
    outside the main component with members of another component (of a wide
    one only where ``near`` says so, if given). A pair is made in the smallest
    collection that it shares, so once, however many tables hold it."""
    who = open_.groupBy("rep").agg(F.max("outside").alias("out"), F.max("label").alias("label"))
    m = written(who.join(sizes.select("rep", "n", "bound", "us", "vs"), "rep"), "nd-across")
    of = lambda p: [F.col("rep").alias(p), *[F.col(c).alias(p + c) for c in ("n", "bound", "label", "out", "us", "vs")],
                    F.explode("us").alias("u")]
    x, y = m.filter("out").select(*of("a")), m.select(*of("b"))
    fits = (F.col("alabel") != F.col("blabel")) & _reach(F.col("abound"), F.col("bbound"), F.col("an"), F.col("bn"))

    def meet(x, y, when):
        once = (F.array_min(F.array_intersect("aus", "bus")) == x["u"]) & F.arrays_overlap("avs", "bvs")
        return x.join(y, (x["u"] == y["u"]) & fits & when & once).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))

    if near is None:
        return meet(x, y, ~F.col("bout") | (F.col("a") < F.col("b")))
    wide, reach = near
    is_wide = F.col("blabel") == F.col("bl")
    small = meet(x, y.join(wide, is_wide, "left_anti"), F.lit(True))
    return small.union(meet(x.join(reach, "a"), y.join(wide, is_wide, "left_semi"), is_wide)).distinct()


def _confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets are similar. Each text is sent once per
    group of ``STAR`` members: a hub's row comes first in its group, its
    members follow, and a task streams through them holding the hub's sets."""
    stars = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / STAR).cast("int").alias("parts"))
    cut = pairs.join(stars, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    cut = written(cut.select("a", "b", "part"), "nd-pairs")
    wanted = (cut.select(F.col("b").alias("id"), F.col("a").alias("hub"), "part", F.lit(1).alias("side"))
              .union(cut.select(F.col("a").alias("id"), F.col("a").alias("hub"), "part", F.lit(0).alias("side")).distinct()))
    rows = (wanted.join(texts, wanted["id"] == texts["doc_id"]).select("hub", "part", "side", "id", "text")
            .repartition("hub", "part").sortWithinPartitions("hub", "part", "side"))
    return _stream_links(rows, percent)


def _stream_links(rows: DataFrame, percent: int) -> DataFrame:
    import pyarrow as pa

    from mailstream.session import ship_package

    ship_package(rows.sparkSession)

    def run(batches):
        from mailstream.llm.shingles import shingle_set, similar
        group, hubs = None, []
        for batch in batches:
            a, b = [], []
            for hub, part, side, id_, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (hub, part) != group:
                    group, hubs = (hub, part), []
                s = shingle_set(text)
                if side == 0:
                    hubs.append(s)
                elif any(similar(h, s, percent) for h in hubs):
                    a.append(hub)
                    b.append(id_)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, _LINK)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    sig = written(signatures(docs), "nd-signatures")
    first = (sig.filter("n_shingles > 0 and doc_id is not null").groupBy("digest")
             .agg(F.min(F.struct("doc_id", "n_shingles", "cols")).alias("m"))
             .select("digest", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles").alias("n"), "m.cols"))
    classes = written(first, "nd-classes")
    labels = components(_links(docs, classes, _several(sig), percent))
    named = written(classes.select("digest", "rep").join(labels, classes["rep"] == labels["node"], "left")
                    .select("digest", F.coalesce("label", "rep").alias("component_id")), "nd-named")
    # rows of one class are many when a text is copied often; classes are
    # unique on their side, so AQE can split the hot digest
    out = sig.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    out = out.join(named, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def _links(docs: DataFrame, classes: DataFrame, several: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between class representatives, complete for the index:
    every pair that shares a table bucket is linked, lies in one component
    already, is out of reach, or was tested."""
    profiles = _shared_collections(classes)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the text of every class that shares a table, written once for all rounds
    texts = _candidate_texts(own, profiles, several)
    # a doc_id with different texts has no one size: its bound stays loose
    profiles = profiles.join(several.filter("mixed"), profiles["rep"] == F.col("id"), "left").select(
        "rep", F.coalesce("least", "lo").alias("lo"), F.coalesce(F.col("most") + 1, "hi").alias("hi"), "score", "us", "vs")
    sizes = _common_sizes(profiles, texts)
    members = _members(sizes)
    hubs = written(_hubs(members).filter("size > 1"), "nd-hubs")
    tested = written(_hub_pairs(members, hubs, sizes), "nd-pairs")
    links = written(_confirm(tested, texts, percent), "nd-links")
    used = hubs.select("key", "hub")
    left = written(_open_members(members, components(links), used), "nd-left")

    # pairs that share rare shingles, for the classes outside
    still = texts.join(left.select("rep").distinct(), texts["doc_id"] == F.col("rep"), "left_semi")
    rare = _rare_shingles(still)
    count = rare.groupBy(F.col("rep").alias("id")).agg(F.count(F.lit(1)).alias("rare"))
    sizes = written(sizes.join(count, sizes["rep"] == count["id"], "left").withColumn(
        "bound", F.when(F.col("bound") > F.col("n"), F.col("bound")).otherwise(F.col("bound") - F.coalesce("rare", F.lit(0))))
        .drop("id", "rare"), "nd-sizes")
    outside = left.filter("outside").select("rep").distinct()
    pairs = written(_without(_rare_pairs(rare, outside, sizes), tested), "nd-pairs")
    links = written(links.union(_confirm(pairs, texts, percent)), "nd-links")
    tested = written(tested.union(pairs), "nd-tested")

    # pairs whose frequent shingles alone could be enough
    members, before = _members(sizes), None
    budget = AT_ONCE * (hubs.agg(F.sum("size")).first()[0] or 0)
    while True:
        left = written(_open_members(members, components(links), used), "nd-left")
        outside = left.filter("outside")
        work = outside.agg(F.sum("size")).first()[0] or 0
        slow = before is not None and 2 * work > before
        last = work <= budget or slow
        if last:
            more = _cross_pairs(left, sizes, _near_components(left, still) if work > budget else None)
        else:  # one more hub for each open bucket
            hubs = written(_hubs(outside), "nd-hubs")
            more = _hub_pairs(left, hubs, sizes)
            used = written(used.union(hubs.select("key", "hub")), "nd-used")
        pairs = written(_without(more, tested), "nd-pairs")
        links = written(links.union(_confirm(pairs, texts, percent)), "nd-links")
        if last:
            return links
        tested, before = written(tested.union(pairs), "nd-tested"), work


def _without(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    both = tested.union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(both, ["a", "b"], "left_anti")


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline form: one document of each group, with its own columns; rows
    without doc_id stay. Repeated rows of one doc_id come down to one. Only the
    ids that go, and those that repeat, meet the texts: they are few against the
    ids that stay, and only rows of ids that repeat are shuffled to be counted
    once."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    own = docs.toDF(*names)
    marks = written(near_duplicates(docs.select("doc_id", "text")).filter("doc_id is not null").groupBy("doc_id")
                    .agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("not kept or n > 1")
                    .select(F.col("doc_id").alias("_id"), "kept"), "nd-marks")
    again = written(marks.filter("kept").select("_id"), "nd-again")
    key = own[at["doc_id"]].cast("long")
    once = own.join(marks, key == marks["_id"], "left_anti")
    many = own.join(again, key == again["_id"], "left_semi").dropDuplicates([at["doc_id"]])
    return once.union(many).toDF(*docs.columns)


def op4_near_duplicates(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text"))
