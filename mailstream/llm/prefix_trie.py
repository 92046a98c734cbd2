"""Conversation prefix trie in balanced parentheses.

Every distinct sequence of first turns is a node. The trie is never held as a
whole: distinct conversations, as keys of turn digests, are range-sorted, which
is the trie's depth-first order; each task cuts its run of keys into pieces of
about ``PIECE`` nodes and writes a piece as balanced parentheses (``parens``).
``findclose`` delimits a node's subtree, the rank of leaf pairs counts its
leaves, and cumulative arrays give members and savings of a subtree.

A node whose subtree lies within one piece is finished there. The others lie
on the path of a piece's first or last key, its spines, which neighbours share:
pieces send for each spine node what hangs off it, equal nodes merge by sums,
and sums up the small spine forest are taken by pointer doubling, so depth
costs a logarithm of rounds.

A key holds ``SEG`` turns at most. A longer conversation continues in the trie
of its next segment, whose root is the last node of the segment before, a spine
node, so no row grows with a conversation and no task holds one. Copies of one
conversation are one key with a count (combined before the shuffle). Ids of
copies are listed in sorted runs; the digest of such a list streams over the
runs of a node and holds one at a time.

Turns are told apart by MD5 and length, nodes by MD5 chains.

Defined cases: rows without conv_id belong to no conversation; null role or
text is empty; turns of equal number are in order of their digest; repeated rows are turns of their own;
conversations without a turn end at the root; an empty table has no nodes;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mailstream.llm.common import arrow_map, only, written
from mailstream.operators.paging import page_slices

# Fixed values of the rebuild: conversations per shared opening, and the
# modulus of its length.
FAMILY, OPENING = 100, 6
# Fixed value: digest of a node where no conversation ends.
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
#: Turns in one key; characters of a turn in a key (MD5 and length, hex).
SEG, TURN = 256, 40
#: Nodes in a piece.
PIECE = 20_000
#: Characters of one run of listed ids.
RUN = 1 << 15

_L = T.LongType()


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(n, _L) for n in names]


# p1, p2: the parent when it is a spine node; g1, g2: conversations that end here
_DONE = T.StructType(_long("conv_id", "depth", "parent_conv_id", "p1", "p2", "n_convs", "n_children", "n_leaves",
                           "saved_tokens", "g1", "g2"))
_SPINE = T.StructType(_long("i1", "i2", "p1", "p2", "depth", "len", "conv_id", "n_convs", "kids", "leaves", "saved", "g1", "g2"))
_PIECES = T.StructType([T.StructField("done", T.BooleanType()), *_long(
    "i1", "i2", "p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", "kids", "leaves", "saved", "len", "g1", "g2")])


def numbered_turns(convs: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn_key)``: turns in order, from 1, by range-sorted
    prefix sums, so a conversation of any length is spread over tasks."""
    c = only(convs, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    key = F.concat(named, F.lpad(F.lower(F.hex(F.char_length(text).cast("long"))), 8, "0"))
    rows = c.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("turn_key"),
                    F.monotonically_increasing_id().alias("_tie"))
    ranked = page_slices(rows, ["conv_id", "turn", "turn_key", "_tie"]).select("conv_id", "turn_key", "row_index")
    first = ranked.groupBy(F.col("conv_id").alias("_c")).agg(F.min("row_index").alias("_first"))
    return ranked.join(first, F.col("conv_id") == F.col("_c")).select(
        "conv_id", (F.col("row_index") - F.col("_first") + 1).alias("pos"), "turn_key")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first turns of their family's first:
    ``(conv_id, n)`` and ``(conv_id, pos, turn_key)``."""
    turns = written(turns, "trie-turns")
    per = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    info = per.select("conv_id", "n", base.alias("base"),
                      (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % OPENING).alias("h"))
    of_base = per.select(F.col("conv_id").alias("base"), F.col("n").alias("_bn"))
    info = written(info.join(of_base, "base", "left").select("conv_id", "base", "h", "n", F.least("h", F.coalesce("_bn", F.lit(0))).alias("k")),
                   "trie-info")
    heads = turns.filter((F.col("pos") < OPENING) & (F.col("conv_id") % FAMILY == 0)).select(F.col("conv_id").alias("base"), "pos", "turn_key")
    opened = info.filter("k > 0").join(heads, "base").filter("pos <= k").select("conv_id", "pos", "turn_key")
    own = turns.join(info.select(F.col("conv_id").alias("_c"), "h", "k"), F.col("conv_id") == F.col("_c")).filter("pos > h")
    rows = opened.union(own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "turn_key"))
    return (info.select("conv_id", (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")),
            rows)


def _segments(sizes: DataFrame, turns: DataFrame, seg: int) -> DataFrame:
    """``(conv_id, s, key, r1, r2)``: a conversation's keys with the node they
    start from. A key of fewer than ``seg`` turns is the last one."""
    at = F.floor((F.col("pos") - 1) / seg)
    filled = (turns.groupBy("conv_id", at.alias("s")).agg(F.array_sort(F.collect_list(F.struct("pos", "turn_key"))).alias("t"))
              .select("conv_id", "s", F.array_join(F.transform("t", lambda x: x["turn_key"]), "").alias("key")))
    last = sizes.filter(F.col("n") % seg == 0).select("conv_id", F.floor(F.col("n") / seg).alias("s"), F.lit("").alias("key"))
    both = written(filled.union(last), "trie-segments")
    zero = F.lit(0).cast("long")
    long_ones = sizes.filter(F.col("n") >= seg).select(F.col("conv_id").alias("_c"))
    short = both.join(long_ones, F.col("conv_id") == F.col("_c"), "left_anti").select("*", zero.alias("r1"), zero.alias("r2"))
    before = Window.partitionBy("conv_id").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    more = both.join(long_ones, F.col("conv_id") == F.col("_c"), "left_semi")
    for r, mark in (("r1", 1), ("r2", 2)):
        more = more.withColumn(r, F.coalesce(F.bit_xor(_step(mark)).over(before), zero))
    return short.union(more)


def _step(mark: int) -> Column:
    return F.xxhash64("key", "s", F.lit(mark))


def _end_of(mark: int) -> Column:
    return F.xxhash64("r1", "r2", "key", F.lit(mark))


def keys_of(segments: DataFrame) -> DataFrame:
    """Distinct keys: ``w`` conversations, the smallest, and the nodes that the
    full key leads to (x1, x2) and that its list of ids is under (g1, g2)."""
    per = segments.groupBy("r1", "r2", "s", "key").agg(F.count(F.lit(1)).alias("w"), F.min("conv_id").alias("conv_id"))
    return per.select("r1", "r2", "s", "key", "w", "conv_id", F.col("r1").bitwiseXOR(_step(1)).alias("x1"),
                      F.col("r2").bitwiseXOR(_step(2)).alias("x2"), _end_of(1).alias("g1"), _end_of(2).alias("g2"))


class Piece:
    """One run of sorted keys as a forest: preorder columns and parentheses."""

    def __init__(self, seg: int):
        self.seg, self.bits = seg, bytearray()
        self.id, self.up, self.len, self.depth = [], [], [], []
        self.w, self.conv, self.ends, self.spine = [], [], [], set()
        self.root, self.path, self.turns = None, [], []

    def _open(self, node_id, up, length, depth):
        self.bits.append(1)
        self.path.append(len(self.id))
        for column, value in ((self.id, node_id), (self.up, up), (self.len, length), (self.depth, depth), (self.w, 0),
                              (self.conv, None), (self.ends, None)):
            column.append(value)

    def _pop(self, to: int):
        while len(self.path) > to:
            self.path.pop()
            self.bits.append(0)

    def add(self, r1, r2, s, key, w, conv, x1, x2, g1, g2):
        import hashlib
        import struct
        if self.root != (r1, r2):
            self._pop(0)
            self.root, self.turns = (r1, r2), []
            self._open(struct.pack(">qq", r1, r2), -1, 0, s * self.seg)
            self.spine.add(self.path[0])
        turns = [key[i:i + TURN] for i in range(0, len(key), TURN)]
        same = 0
        while same < min(len(turns), len(self.turns)) and turns[same] == self.turns[same]:
            same += 1
        self._pop(same + 1)
        for d in range(same, len(turns)):
            up = self.path[-1]
            node = (struct.pack(">qq", x1, x2) if d + 1 == self.seg
                    else hashlib.md5(self.id[up] + turns[d].encode()).digest())
            self._open(node, up, int(turns[d][32:], 16), self.depth[up] + 1)
        self.turns, at = turns, self.path[-1]
        self.w[at], self.conv[at] = w, conv
        if len(turns) == self.seg:      # goes on in another trie
            self.spine.update(self.path)
        else:
            self.ends[at] = (g1, g2)

    def columns(self):
        """``_PIECES`` columns of all nodes."""
        import numpy as np

        from mailstream.llm.parens import Parens

        self.spine.update(self.path)    # the last key's path
        self._pop(0)
        end, leaves, parent = Parens(np.frombuffer(bytes(self.bits), dtype=np.uint8)).subtrees()
        k = len(self.id)
        start = np.arange(k)
        own, length = np.array(self.w, dtype=np.int64), np.array(self.len, dtype=np.int64)
        big = np.iinfo(np.int64).max
        conv = np.array([big if c is None else c for c in self.conv], dtype=np.int64)
        low = np.minimum.reduceat(np.append(conv, big), np.column_stack((start, end)).ravel())[::2]
        added = lambda x: np.concatenate(([0], np.cumsum(x)))  # noqa: E731  sums of subtrees by preorder
        under = lambda c: c[end] - c[start]
        n = under(added(own))
        spine = np.zeros(k, dtype=bool)
        spine[list(self.spine)] = True
        kept = ~spine
        saved = under(added(np.where(kept, (n - 1) * length, 0)))
        leaf = under(added(kept & (end == start + 1)))
        hangs = spine & (parent >= 0)           # a spine node's part is not its spine parent's
        off_saved, off_leaf = saved.copy(), leaf.copy()
        np.subtract.at(off_saved, parent[hangs], saved[hangs])
        np.subtract.at(off_leaf, parent[hangs], leaf[hangs])
        kids = np.bincount(parent[kept & (parent >= 0)], minlength=k)
        ids = np.frombuffer(b"".join(self.id), dtype=">i8").astype(np.int64).reshape(-1, 2)
        rooted, later = parent >= 0, np.array(self.depth) > 0
        continued = ~rooted & later             # its members were counted by the segment before
        far = rooted & spine[parent]
        import pyarrow as pa

        def col(values, null=None):
            return pa.array(values, mask=null)

        ends = np.array([e or (0, 0) for e in self.ends], dtype=np.int64).reshape(-1, 2)
        no_end = np.array([e is None for e in self.ends])
        return {"done": col(kept), "i1": col(ids[:, 0], kept), "i2": col(ids[:, 1], kept),
                "p1": col(ids[parent, 0], ~(far & rooted)), "p2": col(ids[parent, 1], ~(far & rooted)),
                "conv_id": col(low, continued), "depth": col(np.array(self.depth, dtype=np.int64)),
                "parent_conv_id": col(low[parent], far | ~rooted), "n_convs": col(np.where(continued, 0, n)),
                "kids": col(kids), "leaves": col(np.where(spine, off_leaf, leaves)),
                "saved": col(np.where(spine, off_saved, saved)), "len": col(length),
                "g1": col(ends[:, 0], no_end), "g2": col(ends[:, 1], no_end)}


def pieces(keys: DataFrame, seg: int = SEG, piece: int = PIECE) -> DataFrame:
    """``_PIECES`` rows of range-sorted keys."""
    cols = ["r1", "r2", "s", "key", "w", "conv_id", "x1", "x2", "g1", "g2"]
    ordered = keys.select(*cols).repartitionByRange("r1", "r2", "key").sortWithinPartitions("r1", "r2", "key")

    def run(batches):
        now = Piece(seg)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in cols)):
                fresh = not now.id
                now.add(*row)
                if fresh:
                    now.spine.update(now.path)      # the first key's path
                if len(now.id) >= piece:
                    yield now.columns()
                    now = Piece(seg)
        if now.id:
            yield now.columns()

    return arrow_map(ordered, _PIECES, run)


def _spine_totals(spine: DataFrame) -> DataFrame:
    """Merged spine nodes with ``n_children``, ``n_leaves`` and
    ``saved_tokens`` of their subtrees."""
    one = spine.groupBy("i1", "i2").agg(*[F.max(c).alias(c) for c in ("p1", "p2", "depth", "len", "g1", "g2")],
                                        F.min("conv_id").alias("conv_id"),
                                        *[F.sum(c).alias(c) for c in ("n_convs", "kids", "leaves", "saved")])
    one = written(one, "trie-spine")
    below = one.filter("p1 is not null").groupBy(F.col("p1").alias("i1"), F.col("p2").alias("i2")).agg(F.count(F.lit(1)).alias("more"))
    one = written(one.join(below, ["i1", "i2"], "left").withColumn("n_children", F.col("kids") + F.coalesce("more", F.lit(0))),
                  "trie-spine")
    state = one.select("i1", "i2", F.col("p1").alias("j1"), F.col("p2").alias("j2"),
                       (F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("lv"),
                       (F.col("saved") + (F.col("n_convs") - 1) * F.col("len")).alias("sv"))
    while state.filter("j1 is not null").limit(1).count():
        up = state.filter("j1 is not null").groupBy(F.col("j1").alias("i1"), F.col("j2").alias("i2")).agg(
            F.sum("lv").alias("alv"), F.sum("sv").alias("asv"))
        jump = state.select(F.col("i1").alias("j1"), F.col("i2").alias("j2"), F.col("j1").alias("n1"), F.col("j2").alias("n2"))
        state = written(state.join(up, ["i1", "i2"], "left").join(jump, ["j1", "j2"], "left").select(
            "i1", "i2", F.col("n1").alias("j1"), F.col("n2").alias("j2"), (F.col("lv") + F.coalesce("alv", F.lit(0))).alias("lv"),
            (F.col("sv") + F.coalesce("asv", F.lit(0))).alias("sv")), "trie-sums")
    return written(one.join(state.select("i1", "i2", F.col("lv").alias("n_leaves"), F.col("sv").alias("saved_tokens")), ["i1", "i2"]),
                   "trie-spine")


def id_digests(segments: DataFrame, seg: int = SEG) -> DataFrame:
    """``(g1, g2, ends_sha256)`` of the conversations that end at a node."""
    ends = segments.filter(F.length("key") < seg * TURN).select(_end_of(1).alias("g1"), _end_of(2).alias("g2"), "conv_id")
    ordered = ends.repartitionByRange("g1", "g2", "conv_id").sortWithinPartitions("g1", "g2", "conv_id")
    runs = T.StructType([*_long("g1", "g2", "first"), T.StructField("ids", T.StringType())])

    def listed(batches):
        group, first, ids, size, out = None, None, [], 0, []

        def close():
            if ids:
                out.append((*group, first, ",".join(ids)))

        def columns():
            return dict(zip(("g1", "g2", "first", "ids"), map(list, zip(*out))))

        for batch in batches:
            for g1, g2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (g1, g2) != group or size >= RUN:
                    close()
                    group, first, ids, size = (g1, g2), conv, [], 0
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            if out:
                yield columns()
                out.clear()
        close()
        if out:
            yield columns()

    def digest(batches):
        import hashlib
        group, sha, out = None, None, []
        columns = lambda: dict(zip(("g1", "g2", "ends_sha256"), map(list, zip(*out))))
        for batch in batches:
            for g1, g2, ids in zip(*(batch.column(c).to_pylist() for c in ("g1", "g2", "ids"))):
                if (g1, g2) == group:
                    sha.update(b"," + ids.encode())
                    continue
                if group:
                    out.append((*group, sha.hexdigest()))
                group, sha = (g1, g2), hashlib.sha256(ids.encode())
            if out:
                yield columns()
                out.clear()
        if group:
            yield dict(zip(("g1", "g2", "ends_sha256"), map(list, zip((*group, sha.hexdigest())))))

    by_node = arrow_map(ordered, runs, listed).repartition("g1", "g2").sortWithinPartitions("g1", "g2", "first")
    return arrow_map(by_node, T.StructType([*_long("g1", "g2"), T.StructField("ends_sha256", T.StringType())]), digest)


def prefix_trie(sizes: DataFrame, turns: DataFrame, seg: int = SEG, piece: int = PIECE) -> DataFrame:
    """``sizes(conv_id, n)``, ``turns(conv_id, pos, turn_key)`` -> one row per
    node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    segments = written(_segments(written(sizes, "trie-sizes"), turns, seg), "trie-keyed")
    parts = written(pieces(keys_of(segments), seg, piece), "trie-pieces")
    spine = _spine_totals(parts.filter("not done"))
    named = spine.select(F.col("i1").alias("p1"), F.col("i2").alias("p2"), F.col("conv_id").alias("_up"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "g1", "g2"]
    done = parts.filter("done").select("p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", F.col("kids").alias("n_children"),
                                       F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "g1", "g2")
    hung = done.filter("p1 is not null").drop("parent_conv_id").unionByName(
        spine.select("p1", "p2", *[c for c in out if c != "parent_conv_id"]))
    hung = hung.join(named, ["p1", "p2"], "left").withColumnRenamed("_up", "parent_conv_id")
    nodes = done.filter("p1 is null").select(*out).unionByName(hung.select(*out))
    listed = nodes.join(written(id_digests(segments, seg), "trie-ends"), ["g1", "g2"], "left")
    return listed.select(*out[:-2], F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def op13_prefix_trie(convs: DataFrame) -> DataFrame:
    return prefix_trie(*rebuild(numbered_turns(convs)))
