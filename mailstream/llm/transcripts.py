"""Chat formatting: turns and roles of a transcript by a hidden Markov model.

A transcript is a run of lines. A turn may start with a speaker marker ("Human:",
"### Assistant", ...) or with none, and holds any number of lines. Hidden
states are a role's first line and its further lines; a line shows its marker's
class, its length class, whether it asks, and whether it follows an empty line.
Transition and emission tables are counts over labelled conversations.
Viterbi then finds where turns start and whose they are, and each turn is
rendered in one canonical form. Where the transcript's pieces (``blocks``)
begin and end says nothing: only the order of their lines is read.

Viterbi runs on (max, +) products: a conversation is cut into spans of
``SPAN`` lines, each span becomes one matrix, spans of spans likewise, and the
best path is then handed down level by level. So no task holds more than one
span, however long a conversation is and however many rows tie. Only a found
turn is put together in one row.

Defined cases: a null text is one empty line; null conv_ids form one
conversation; a null turn comes first; blocks that tie in (conv_id, turn) go by
text; a repeated row is a block of its own; a marker within a line is text; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from mailstream.llm.common import count_words, only, table, written
from mailstream.session import ship_package

# The roles, and the markers read as each of them.
ROLES = ["system", "user", "assistant"]
MARKERS = {"system": ["System:", "### System", "[SYS]"], "user": ["User:", "Human:", "### Instruction", "[Q]"],
           "assistant": ["Assistant:", "AI:", "### Response", "[A]"]}

#: Lines in one span.
SPAN = 512
LENGTHS = 10
_FEATURES = {"marker": len(ROLES) + 1, "length": LENGTHS, "asks": 2, "gap": 2}
#: States: first and further lines of each role; the log weight of a step that cannot be.
_K, _NEVER = 2 * len(ROLES), -1e6


def raw_transcript(conversations: DataFrame, *keep: str) -> DataFrame:
    """``(conv_id, turn, block)``: a transcript in mixed styles, as found in
    the wild. A conversation keeps one style; a third of its turns have lost their
    marker, and every second style has an empty line after a turn. Roles are not
    kept, unless named in ``keep``."""
    r = only(conversations, "conv_id", "turn", "role", "text").withColumn("text", F.coalesce("text", F.lit("")))
    style = F.pmod(F.xxhash64("conv_id", F.lit(2)), F.lit(4))        # not the hash that picks training conversations
    lost = F.pmod(F.xxhash64("conv_id", "turn", F.lit(1)), F.lit(3)) == 0
    mark = F.lit("")
    for role, marks in MARKERS.items():
        each = F.element_at(F.array(*[F.lit(m) for m in marks]), (F.pmod(style, F.lit(len(marks))) + 1).cast("int"))
        mark = F.when(F.col("role") == role, each).otherwise(mark)
    block = F.when(lost | (mark == ""), F.col("text")).otherwise(F.concat_ws(" ", mark, "text"))
    return r.select("conv_id", "turn", F.when(style % 2 == 1, F.concat(block, F.lit("\n"))).otherwise(block).alias("block"), *keep)


def numbered_lines(blocks: DataFrame, *keep: str) -> DataFrame:
    """``(conv_id, conv, rank, inner, line)``: the lines of all blocks; ``rank``
    numbers them without gaps, conversation by conversation, ``inner`` is the
    line's place in its block (for training only)."""
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    pos = F.coalesce(F.col("turn").cast("long") + 1, F.lit(0).cast("long"))
    b = blocks.select("conv_id", conv.alias("conv"), pos.alias("pos"), F.coalesce("block", F.lit("")).alias("block"), *keep)
    b = _ranked(b.withColumn("ord", F.xxhash64("block")))
    lines = b.select("conv_id", "conv", F.col("rank").alias("pos"), *keep, F.posexplode(F.split("block", "\n")).alias("inner", "line"))
    return _ranked(lines.withColumn("ord", F.col("inner").cast("long"))).drop("pos", "ord")


def observe(lines: DataFrame) -> DataFrame:
    """Split markers off and add the observed features."""
    code, body = F.lit(0), F.col("line")
    for i, role in enumerate(ROLES):
        for m in MARKERS[role]:
            hit = F.col("line").startswith(m)
            code = F.when(hit, i + 1).otherwise(code)
            body = F.when(hit, F.ltrim(F.substr(F.col("line"), F.lit(len(m) + 1)))).otherwise(body)
    d = lines.withColumn("marker", code).withColumn("body", body)
    words = count_words(F.col("body"))
    d = (d.withColumn("length", F.least(F.lit(LENGTHS - 1), F.floor(F.log2(words + 1)).cast("int")))
         .withColumn("asks", F.col("body").rlike(r"\?\s*$").cast("int")))
    empty = lines.filter(F.trim("line") == "").select((F.col("rank") + 1).alias("rank"), F.lit(1).alias("_gap"))
    return d.join(empty, "rank", "left").withColumn("gap", F.coalesce("_gap", F.lit(0))).drop("_gap")


def train(conversations: DataFrame) -> dict:
    """Log tables of start, transition and emission probabilities, smoothed
    by one count. Aggregates of fixed size come to the driver."""
    own = only(conversations, "conv_id", "turn", "role", "text")
    own = own.filter(F.col("role").isin(ROLES) & F.col("turn").isNotNull() & F.col("conv_id").isNotNull())
    role = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")).cast("int") - 1
    seen = numbered_lines(raw_transcript(own, "role"), "role").withColumn("state", role * 2 + (F.col("inner") > 0).cast("int"))
    seen = written(observe(seen).select("conv", "rank", "state", *_FEATURES), "hmm-train")
    trans, start = np.ones((_K, _K)), np.ones(_K)
    before = seen.select("conv", (F.col("rank") + 1).alias("rank"), F.col("state").alias("from"))
    steps = seen.join(before, ["conv", "rank"], "left").groupBy("from", "state").agg(F.count(F.lit(1)).alias("n"))
    for a, b, n in steps.collect():
        if a is None:
            start[b] += n
        else:
            trans[a, b] += n
    emit = {f: np.ones((_K, size)) for f, size in _FEATURES.items()}
    for row in seen.groupBy("state", *_FEATURES).agg(F.count(F.lit(1)).alias("n")).collect():
        for f in _FEATURES:
            emit[f][row["state"], row[f]] += row["n"]
    norm = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    further = np.arange(_K) % 2 == 1
    other = np.arange(_K)[:, None] // 2 != np.arange(_K)[None, :] // 2
    return {"start": np.where(further, _NEVER, norm(start)).tolist(),       # a conversation starts with a first line
            "trans": np.where(other & further[None, :], _NEVER, norm(trans)).tolist(),  # further lines are of the same role
            "emit": {f: norm(x).tolist() for f, x in emit.items()}}


def best_path(mats: np.ndarray, first: int | None, last: int | None) -> list[int]:
    """Viterbi through a run of (max, +) matrices: the states after each, with
    the state before and the state at the end given or free."""
    k = mats.shape[1]
    score = np.full(k, -np.inf)
    score[first if first is not None else 0] = 0.0
    back = np.empty((len(mats), k), dtype=np.int8)
    for t, m in enumerate(mats):
        total = score[:, None] + m
        back[t] = total.argmax(axis=0)
        score = total.max(axis=0)
    state = int(last if last is not None else score.argmax())
    out = [state]
    for t in range(len(mats) - 1, 0, -1):
        state = int(back[t, state])
        out.append(state)
    return out[::-1]


def product(mats: np.ndarray) -> np.ndarray:
    """(max, +) product of a run of matrices."""
    acc = mats[0]
    for m in mats[1:]:
        acc = (acc[:, :, None] + m[None, :, :]).max(axis=1)
    return acc


_MAT = T.StructType([T.StructField("conv", T.StringType()), T.StructField("pos", T.LongType()),
                     T.StructField("mat", T.ArrayType(T.DoubleType()))])
_STATES = T.StructType([T.StructField("conv", T.StringType()), T.StructField("pos", T.LongType()),
                        T.StructField("ord", T.LongType()), T.StructField("state", T.IntegerType()),
                        T.StructField("came", T.IntegerType())])


def _block_matrix(model: dict) -> Column:
    """Matrix of one line: transition (or start, at the first) + emission."""
    def table_of(name: str, s: int) -> Column:
        return F.element_at(F.array(*[F.lit(x) for x in model["emit"][name][s]]), F.col(name).cast("int") + 1)
    emit = [sum((table_of(f, s) for f in _FEATURES), F.lit(0.0)) for s in range(_K)]
    cell = lambda i, j: F.when(F.col("first"), F.lit(model["start"][j])).otherwise(
        F.lit(model["trans"][i][j])) + emit[j]
    return F.array(*[cell(i, j) for i in range(_K) for j in range(_K)])


def decode(blocks: DataFrame, model: dict, span: int = SPAN) -> DataFrame:
    """``blocks(conv_id, turn, block)`` -> ``(conv_id, turn, role, body)``: the
    turns found, numbered from 0 in each conversation."""
    seen = written(observe(numbered_lines(blocks)), "hmm-lines")
    lows = seen.groupBy("conv").agg(F.min("rank").alias("low"))
    elems = seen.select("conv", "rank", *_FEATURES).join(lows, "conv").withColumn("pos", F.col("rank") - F.col("low"))
    elems = elems.withColumn("first", F.col("pos") == 0)
    levels = [written(elems.select("conv", "pos", F.col("rank").alias("ord"), _block_matrix(model).alias("mat")), "hmm-blocks")]
    high = levels[0].agg(F.max("pos")).first()[0] or 0
    while high >= span:
        up = _each_span(levels[-1].withColumn("g", F.floor(F.col("pos") / span)), _fold, _MAT)
        levels.append(written(up.withColumn("ord", F.lit(0).cast("long")).select("conv", "pos", "ord", "mat"), "hmm-spans"))
        high //= span
    known = None
    for lv in reversed(levels):
        lv = lv.withColumn("g", F.floor(F.col("pos") / span))
        if known is None:
            lv = lv.withColumn("came", F.lit(None).cast("int")).withColumn("end", F.lit(None).cast("int"))
        else:
            k = known.select("conv", F.col("pos").alias("g"), "came", F.col("state").alias("end"))
            lv = lv.join(k, ["conv", "g"])
        known = written(_each_span(lv, _walk, _STATES), "hmm-states")
    starts = (F.col("state") % 2 == 0).cast("long")
    ids = _running(known.select(F.col("ord").alias("rank"), "state", starts.alias("starts")), "rank", "starts", span)
    return _turns(seen.join(ids, "rank"))


def _running(rows: DataFrame, at: str, value: str, span: int) -> DataFrame:
    """Add ``run``: the sum of ``value`` up to each row's number ``at``. A
    window holds ``span`` rows; the spans' sums are summed up likewise."""
    rows = written(rows.withColumn("_g", F.floor(F.col(at) / span)), "hmm-running")
    inside = rows.withColumn("run", F.sum(value).over(Window.partitionBy("_g").orderBy(at)))
    if (rows.agg(F.max(at)).first()[0] or 0) < span:
        return inside.drop("_g")
    above = _running(rows.groupBy(F.col("_g").alias("_at")).agg(F.sum(value).alias("_sum")), "_at", "_sum", span)
    above = above.select(F.col("_at").alias("_g"), (F.col("run") - F.col("_sum")).alias("_before"))
    return inside.join(above, "_g").withColumn("run", F.col("run") + F.col("_before")).drop("_g", "_before")


def _turns(lines: DataFrame) -> DataFrame:
    """Lines of one ``run`` put together. Empty lines at a turn's end go."""
    text = F.when(F.col("starts") == 1, F.col("body")).otherwise(F.col("line"))
    found = lines.groupBy("run").agg(
        F.first("conv_id").alias("conv_id"), F.first("conv").alias("conv"), F.max("state").alias("state"),
        F.array_sort(F.collect_list(F.struct("rank", text.alias("text")))).alias("t"))
    found = found.withColumn("body", F.rtrim(F.array_join(F.transform("t", lambda x: x["text"]), "\n"), F.lit("\n")))
    found = written(found.drop("t"), "hmm-turns")
    lows = found.groupBy("conv").agg(F.min("run").alias("low"))
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.floor(F.col("state") / 2).cast("int") + 1)
    return found.join(lows, "conv").select("conv_id", (F.col("run") - F.col("low")).alias("turn"), role.alias("role"), "body")


def _ranked(seen: DataFrame) -> DataFrame:
    """Add ``rank``: a row's number in the order (conv, pos, ord), without gaps.
    Rows are range-sorted, equal ones apart by where they were read, and each
    partition's numbers start after the rows of those before it."""
    keys = ["conv", "pos", "ord", "_tie"]
    rows = seen.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # the upper bits hold the partition, the lower 33 the row in it
    rows = written(rows.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "hmm-ordered")
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_row", F.col("_at") - F.shiftleft("_part", 33))
    starts, at = [], 0
    for part, n in sorted(tuple(r) for r in rows.groupBy("_part").agg(F.count(F.lit(1))).collect()):
        starts.append((part, at))
        at += n
    starts = rows.sparkSession.createDataFrame(starts, "_part long, _start long")
    return (rows.join(F.broadcast(starts), "_part").withColumn("rank", F.col("_start") + F.col("_row"))
            .drop("_at", "_part", "_row", "_start"))


def _each_span(rows: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """``fn`` of the rows of every span (conv, g), in order. A task streams
    through many sorted spans and holds one of them and one Arrow batch."""
    ship_package(rows.sparkSession)
    cols = ["conv", "g", "pos", "ord", "mat", *[c for c in ("came", "end") if c in rows.columns]]
    names = schema.fieldNames()

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        to = to_arrow_schema(schema)
        out = lambda found: pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in found], schema=to)
        key, held = None, []
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    found += fn(held) if held else []
                    key, held = row[:2], []
                held.append(row)
            yield out(found)
        if held:
            yield out(fn(held))

    return (rows.select(*cols).repartition("conv", "g").sortWithinPartitions("conv", "g", "pos", "ord")
            .mapInArrow(run, schema))


def _matrices(held: list) -> np.ndarray:
    return np.array([r[4] for r in held]).reshape(-1, _K, _K)


def _fold(held: list) -> list:
    """One matrix for a span; its position is the span's number."""
    return [(held[0][0], held[0][1], product(_matrices(held)).ravel().tolist())]


def _walk(held: list) -> list:
    """Path inside one span; ``came`` is the state before each element."""
    came, end = held[0][5:]
    path = best_path(_matrices(held), came, end)
    return [(r[0], r[2], r[3], s, c) for r, s, c in zip(held, path, [came or 0] + path[:-1])]


def render(turns: DataFrame) -> DataFrame:
    """Canonical turn: ``<|role|>``, the text, ``<|end|>``."""
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "body", F.lit("\n<|end|>\n")))


def op7_chat_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns found in every conversation's transcript, with roles and canonical
    rendering. The model is fitted on the conversations with an even hash and
    read by all."""
    conv = table(spark, sf_dir, "conversations")
    model = train(conv.filter(F.pmod(F.xxhash64("conv_id"), F.lit(2)) == 0))
    return render(decode(raw_transcript(conv), model)).select("conv_id", "turn", "role", "rendered")
