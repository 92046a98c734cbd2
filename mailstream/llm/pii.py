"""PII (native): fixed patterns, then bootstrapped contextual extraction.

Base kinds (email, ip, card, phone) are regular expressions with code point
offsets: ``split`` and ``regexp_extract_all`` walk a text with the same
matcher, so pieces and matches alternate and offsets are running sums.

The bootstrap looks for identifiers the patterns miss. Every identifier-like
token (it holds a digit) is an instance with its lexical context: the
two words before it, where an identifier starts a word and stands as its shape. Base matches are the seeds. A pattern (context x the
token's shape) is scored by the weight of its instances that are
believed, an instance by the noisy-or of its accepted patterns, and
the two scores are iterated over the pattern-instance graph. Instances that accepted patterns
carry over ``INSTANCE_MIN`` become spans of kind ``context``.

All regular expressions are linear on long runs: a candidate starts at a run's
edge or where the last match ended (``\\G``), and repeats are possessive.

Defined cases: a null text is empty and has no spans; repeated rows get equal
spans; a null doc_id is fine (spans are joined by doc_id and text hash); an
empty table gives an empty result; extra columns are ignored (kept by ``redact``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import written

# Kinds in their order, and their patterns. Same matches as the
# plain forms; the guards only keep long runs linear.
KINDS = ["email", "ip", "card", "phone"]
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this cannot match: most texts skip most patterns.
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

#: Identifier-like: a whole token of 6 or more characters that holds a digit
#: and ends in a letter or digit. The runs are possessive: a token is read once
#: however long it is.
CANDIDATE = (r"(?:\G|(?<![A-Za-z0-9@._+/-]))(?=[A-Za-z@._+/-]*+[0-9])"
             r"[A-Za-z0-9+][A-Za-z0-9@._+/-]{5,}+(?<=[A-Za-z0-9])")

#: A pattern is accepted with this many distinct believed instances in this
#: many documents, and this (smoothed) share of believed weight.
PATTERN_SUPPORT = 8
PATTERN_MIN = 0.85
INSTANCE_MIN = 0.8
#: Confidence that all accepted patterns together may still gain when the
#: rounds end.
SETTLED = 1e-3
#: Elements folded in one block, and code points of a text cut from in one
#: block; results do not depend on them.
BLOCK, CUT = 256, 4096


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Luhn sum: every second digit from the right is doubled."""
    d = F.reverse(F.split(_digits(m), ""))
    total = F.aggregate(
        F.transform(d, lambda c, i: (lambda v: F.when(i % 2 == 1, F.when(v > 4, v * 2 - 9).otherwise(v * 2)).otherwise(v))
                    (c.cast("int"))), F.lit(0), lambda a, v: a + v)
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(n.between(12, 19), _luhn(m)).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _running(values: Column, start, step) -> Column:
    """``step`` folded over an array: the value before each element, and the
    last one. Two levels, blocks of ``BLOCK`` and the blocks' totals, so that
    a text of a million matches does not copy its whole prefix for each."""
    def walk(xs: Column, at) -> Column:
        return F.aggregate(xs, F.array(at), lambda acc, x: F.array_append(acc, step(F.element_at(acc, -1), x)))

    heads = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
    blocks = F.transform(heads, lambda i: F.slice(values, i, BLOCK))
    before = walk(F.transform(blocks, lambda b: F.aggregate(b, start, step)), start)
    inner = F.zip_with(blocks, F.slice(before, 1, F.size(heads)), lambda b, at: F.slice(walk(b, at), 1, F.size(b)))
    return F.concat(F.flatten(inner), F.array(F.element_at(before, -1)))


def _sums(values: Column) -> Column:
    return _running(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _with_matches(d: DataFrame, pattern: str, name: str, some: Column) -> DataFrame:
    """Add ``{name}_p``, the text before each match of ``_t`` (the last piece,
    after the last match, is left out), ``{name}_m``, the matches, and their
    code point offsets ``{name}_at`` (starts and ends alternate). Only texts
    with ``some`` can match; the others are not scanned."""
    t = F.when(some, F.col("_t")).otherwise("")
    d = d.withColumn(f"{name}_m", F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
    d = d.withColumn(f"{name}_p", F.slice(F.split(t, pattern, -1), F.lit(1), F.size(f"{name}_m")))
    size = lambda x: F.length(x).cast("long")
    both = F.flatten(F.zip_with(f"{name}_p", f"{name}_m", lambda p, m: F.array(size(p), size(m))))
    d = d.withColumn(f"{name}_l", both)
    return d.withColumn(f"{name}_at", F.slice(_sums(F.col(f"{name}_l")), F.lit(2), F.size(f"{name}_l")))


def _located(name: str) -> Column:
    """``array<struct<s,e,m>>`` of the columns that ``_with_matches`` adds."""
    odd = lambda r: F.filter(f"{name}_at", lambda x, i: i % 2 == r)
    ends = F.zip_with(odd(0), odd(1), lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    return F.zip_with(ends, F.col(f"{name}_m"), lambda x, m: F.struct(x["s"].alias("s"), x["e"].alias("e"), m.alias("m")))


def _last_words(text: Column, words: str) -> Column:
    """The words at the end of a text, found from its reverse so that long
    runs stay linear."""
    return F.reverse(F.regexp_extract(F.reverse(text), rf"^\s*+({words})", 1))


def _contexts(pieces: Column, matches: Column) -> Column:
    """The two words before each match, a match before counting as its shape.
    A shape starts a word, so the piece before, and one word of what precedes
    the match before it, hold them."""
    def after(marks: Column) -> Column:     # of the element before; the first has none
        return F.slice(F.concat(F.array(F.lit("")), marks), F.lit(1), F.size(matches))

    shapes = F.transform(matches, _shape)
    word = F.zip_with(after(shapes), pieces, lambda m, p: _last_words(F.concat(m, p), r"\S++"))
    heads = F.zip_with(word, shapes, lambda w, m: F.concat(w, F.lit(" "), m))
    return F.zip_with(after(heads), pieces, lambda h, p: F.lower(_last_words(F.concat(h, p), r"\S++\s++\S++")))


def _base_spans(kind: str) -> Column:
    """Valid matches of a kind as ``array<struct<s,k,e>>``."""
    hit = F.filter(_located(f"_{kind}"), lambda x: _valid(kind, x["m"]))
    return F.transform(hit, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"), x["e"].alias("e")))


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``base``: the spans of all base kinds, by start then kind."""
    d = docs.withColumn("_t", F.coalesce(F.col(text_col), F.lit("")))
    for k in KINDS:
        some = F.col("_t").rlike("[0-9]") if _NEEDS[k] is None else F.contains("_t", F.lit(_NEEDS[k]))
        d = _with_matches(d, PATTERNS[k], f"_{k}", some).withColumn(f"_{k}", _base_spans(k))
    d = d.withColumn("base", F.sort_array(F.concat(*[F.col(f"_{k}") for k in KINDS])))
    return d.select(*docs.columns, "base")


def _shape(m: Column) -> Column:
    """Coarse shape of a token: with an at sign, digits and marks, or mixed."""
    return F.when(F.contains(m, F.lit("@")), "@").when(~m.rlike("[A-Za-z]"), "9").otherwise("a9")


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``cand``: identifier-like tokens, ``array<struct<s,e,m,context>>``."""
    d = _with_matches(docs.withColumn("_t", F.coalesce(F.col(text_col), F.lit(""))), CANDIDATE, "_c",
                      F.col("_t").rlike("[0-9]"))
    found = F.zip_with(_located("_c"), _contexts(F.col("_c_p"), F.col("_c_m")), lambda x, c: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lower(x["m"]).alias("m"), c.alias("context")))
    return d.withColumn("cand", found).select(*docs.columns, "cand")


def _with_seeds(found: DataFrame) -> DataFrame:
    """``found`` with ``seed`` in each of ``cand``: whether it meets a base
    span. Base spans by start and candidates by end are walked together: the
    largest end of the spans that start before a candidate's end tells."""
    steps = F.sort_array(F.concat(
        F.transform("base", lambda b: F.struct(b["s"].alias("pos"), F.lit(1).alias("base"), b["e"].alias("v"))),
        F.transform("cand", lambda c: F.struct(c["e"].alias("pos"), F.lit(0).alias("base"), c["s"].alias("v")))))
    d = found.withColumn("_steps", steps)
    d = d.withColumn("_ends", F.transform("_steps", lambda x: F.when(x["base"] == 1, x["v"]).otherwise(F.lit(0).cast("long"))))
    d = d.withColumn("_most", _running(F.col("_ends"), F.lit(0).cast("long"), lambda a, e: F.greatest(a, e)))
    met = F.zip_with("_steps", F.slice("_most", F.lit(1), F.size("_steps")),
                     lambda x, most: F.when(x["base"] == 0, most > x["v"]))
    seeds = F.filter(met, lambda x: x.isNotNull())
    cand = F.zip_with("cand", seeds, lambda c, seed: F.struct(*[c[k].alias(k) for k in ("s", "e", "m", "context")],
                                                              seed.alias("seed")))
    return d.select("doc_id", "h", cand.alias("cand"))


def context_spans(found: DataFrame) -> DataFrame:
    """Bootstrap over ``found(doc_id, h, base, cand)``: ``(doc_id, h, extra)``
    with the spans that accepted patterns add."""
    # outer: a plain explode adds a filter on the array's size, which would
    # carry all of the array's making into its own blocks
    rows = _with_seeds(found).select("doc_id", "h", F.explode_outer("cand").alias("c"))
    rows = written(rows.select("doc_id", "h", F.col("c.s").alias("s"), F.col("c.e").alias("e"), F.col("c.m").alias("m"),
                               F.concat_ws(" ", F.col("c.context"), _shape(F.col("c.m"))).alias("pattern"),
                               F.col("c.seed").alias("seed"))
                   .filter(F.length(F.col("c.context")) > 0), "pii-instances")
    edges = written(rows.groupBy("pattern", "m").agg(F.max("seed").alias("seed"),
                                                     F.count_distinct("doc_id").alias("docs")), "pii-edges")
    # smaller patterns cannot reach the support, whatever is believed
    live = written(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("size"), F.sum("docs").alias("docs"))
                   .filter((F.col("size") >= PATTERN_SUPPORT) & (F.col("docs") >= PATTERN_SUPPORT))
                   .select("pattern", "size"), "pii-patterns")
    graph = written(edges.join(live, "pattern").select("pattern", "m", "size"), "pii-graph")
    seeds = written(edges.filter("seed").select("m", F.lit(1.0).alias("score")).distinct(), "pii-seeds")
    belief, before = seeds, (0, 0.0)
    while True:
        believed = F.sum((F.col("score") >= INSTANCE_MIN).cast("int"))
        scored = (graph.join(belief, "m").groupBy("pattern")
                  .agg((F.sum("score") / (F.first("size") + 1)).alias("conf"), believed.alias("support"))
                  .filter((F.col("conf") >= PATTERN_MIN) & (F.col("support") >= PATTERN_SUPPORT)).select("pattern", "conf"))
        accepted = written(scored, "pii-accepted")
        either = graph.join(accepted, "pattern").groupBy("m").agg(
            (1 - F.exp(F.sum(F.log1p(-F.least("conf", F.lit(0.999)))))).alias("score"))
        belief = written(seeds.union(either).groupBy("m").agg(F.max("score").alias("score")), "pii-belief")
        # belief only grows, so accepted patterns stay; the rounds end when none
        # is new and what is known of the others has settled
        n, conf = accepted.agg(F.count(F.lit(1)), F.coalesce(F.sum("conf"), F.lit(0.0))).first()
        if n == before[0] and conf - before[1] < SETTLED:
            break
        before = (n, conf)
    new = (rows.filter("not seed").join(accepted, "pattern").join(belief.filter(F.col("score") >= INSTANCE_MIN), "m")
           .select("doc_id", "h", F.struct("s", F.lit(len(KINDS)).alias("k"), "e").alias("span")).distinct())
    return new.groupBy("doc_id", "h").agg(F.sort_array(F.collect_list("span")).alias("extra"))


def find(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``base`` and ``spans`` (base and context, by start then
    kind). Both are narrow arrays; texts are read once for them."""
    keyed = docs.withColumn("h", F.xxhash64(F.col(text_col)))
    scan = candidates(base_spans(keyed, text_col), text_col)
    found = written(scan, "pii-found")
    # only rows with context spans: written, so that the join knows their size
    # and a small table goes to the texts, not the texts through a shuffle
    extra = written(context_spans(found), "pii-extra")
    x = extra.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "extra")
    out = found.join(x, found["doc_id"].eqNullSafe(x["_d"]) & (found["h"] == x["_h"]), "left")
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "extra")))
    return out.withColumn("spans", spans).drop("cand", "_d", "_h", "extra", "h")


def _written_as(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS + ["context"]])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op10_personal_data(docs: DataFrame) -> DataFrame:
    """Counts and span digests per document; texts do not leave the scan."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = narrow.withColumn("h", F.xxhash64("text"))
    found = written(candidates(base_spans(keyed)).select("doc_id", "h", "base", "cand"), "pii-found")
    x = context_spans(found).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "extra")
    out = found.join(x, found["doc_id"].eqNullSafe(x["_d"]) & (found["h"] == x["_h"]), "left")
    out = out.withColumn("spans", F.when(F.col("extra").isNull(), F.col("base"))
                         .otherwise(F.sort_array(F.concat("base", "extra"))))
    count = lambda i: F.size(F.filter("base", lambda x: x["k"] == i)).cast("long")
    return out.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                      F.sha2(_written_as("base"), 256).alias("base_sha256"), _written_as("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """Pipeline form: every span is replaced by its kind, such as ``[EMAIL]``;
    overlapping spans become one with the first one's kind. All columns stay; a null text stays
    null."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    own = docs.toDF(*names)
    own = own.withColumn("doc_id", F.col(at["doc_id"]))
    found = find(own, at["text"])
    # the text in blocks of CUT code points: a piece is cut from those it touches
    t, long = at["text"], F.lit(0).cast("long")
    found = found.withColumn("_b", F.regexp_extract_all(F.col(t), F.lit(rf"(?s).{{1,{CUT}}}"), F.lit(0)))
    found = found.withColumn("_ends", F.transform("spans", lambda x: x["e"]))
    found = found.withColumn("_at", _running(F.col("_ends"), long, lambda a, e: F.greatest(a, e)))

    def cut(s: Column, e: Column) -> Column:
        first = F.floor(s / CUT)
        touched = F.slice("_b", (first + 1).cast("int"), (F.floor(e / CUT) - first + 1).cast("int"))
        return F.substr(F.array_join(touched, ""), (s - first * CUT + 1).cast("int"), (e - s).cast("int"))

    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS + ["context"]])
    # a span that starts before the last end is part of the mark before it
    parts = F.zip_with("spans", F.slice("_at", F.lit(1), F.size("spans")), lambda x, at: F.when(
        x["s"] >= at, F.concat(cut(at, x["s"]), F.element_at(tags, x["k"] + 1))).otherwise(""))
    rest = cut(F.element_at("_at", -1), F.length(t).cast("long"))
    clean = F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), rest)).otherwise(F.col(t))
    return found.withColumn(t, clean).select(*names).toDF(*docs.columns)
