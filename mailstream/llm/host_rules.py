"""Quality rules (native): document rules, then host-level verdicts.

Every document gets counts (words, symbols, repeated lines, words in repeated
3-word windows) and a set of rule failures. Failures are summed by host
(``source``); each host's failure rate is shrunk towards the corpus rate by a
beta prior that is fitted to the hosts themselves (method of moments), so a
host with few documents is not judged on noise. A host whose shrunk rate of
any rule reaches ``HOST_LIMIT`` is rejected, and the verdict is joined back to
its documents.

Defined cases: a null text has no words (it fails the length rule); a null
host is a host of its own; an empty table gives an empty result; repeated rows
are judged one by one; extra columns are ignored here and kept by ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.llm.common import SPACE_CHARS, WORD, written

# Fixed values of the base rules.
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"

#: A host is rejected when the shrunk failure rate of a rule reaches this.
HOST_LIMIT = 0.5
#: Prior strength (pseudo documents): at least, so that no host is judged on a
#: few documents, and when the hosts do not differ at all.
MIN_STRENGTH, MAX_STRENGTH = 10.0, 1e6

RULES = ["base", "symbols", "dup_lines", "long_words"]


def _repeat_words(at: str) -> Column:
    """Words covered by a 3-word window that occurs at least twice, from the
    sorted (window hash, position) pairs: a pair whose neighbour has the same
    hash marks its position, and a covered stretch is the union of [p, p+2],
    summed as min(3, gap to the next p)."""
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    x = F.col(at)
    trio = F.arrays_zip(x.alias("x"), F.concat(none, x).alias("b"),
                        F.concat(F.slice(x, 2, F.size(x)), none).alias("a"))
    same = F.filter(trio, lambda t: F.coalesce(t["x"]["h"] == t["b"]["h"], F.lit(False))
                    | F.coalesce(t["x"]["h"] == t["a"]["h"], F.lit(False)))
    pos = F.array_sort(F.transform(same, lambda t: t["x"]["i"]))
    total = F.aggregate(
        pos, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).cast("long").alias("n"),
                                p.alias("last")))
    return F.coalesce(total["n"], F.lit(0))


def document_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_lines, base_failed``. One pass over the text, no shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.withColumn("_t", text)
    d = d.withColumn("_w", F.regexp_extract_all("_t", F.lit(WORD + "+"), F.lit(0)))
    d = d.withColumn("_l", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD)))
    n = F.size("_w")
    windows = F.slice(F.arrays_zip(F.col("_w").alias("a"), F.slice("_w", 2, n).alias("b"),
                                   F.slice("_w", 3, n).alias("c")), 1, F.greatest(n - 2, F.lit(0)))
    d = d.withColumn("_h", F.transform(windows, lambda g: F.xxhash64(g["a"], g["b"], g["c"])))
    # only texts with a repeated window pay for the position sort
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    d = d.withColumn("_at", F.when(repeated, F.sort_array(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    squeezed = F.translate("_t", SPACE_CHARS, "")
    d = d.select(
        *docs.columns,
        n.cast("long").alias("n_words"),
        F.length(squeezed).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeat_words("_at").cast("long").alias("n_repeat_words"))
    return d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def rule_failures() -> dict[str, Column]:
    """Rule name -> failure condition on the counts."""
    return {
        "base": F.col("base_failed"),
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("word_chars"),
        "dup_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "long_words": F.col("word_chars") > 20 * F.col("n_words"),
    }


def host_verdicts(counted: DataFrame, host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures and shrunk rate per rule, and
    ``host_ok``. A partial + final aggregate; the prior needs one more
    aggregate over hosts, which returns a single row."""
    hosts = written(counted.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c.cast("long")).alias(f"f_{r}") for r, c in rule_failures().items()]), "host-rates")
    n = F.col("n").cast("double")
    total = F.sum(n)
    first = hosts.agg(total.alias("n"), F.sum(n * n).alias("nn"), F.count(F.lit(1)).alias("k"),
                      *[F.sum(f"f_{r}").alias(r) for r in RULES]).first()
    if not first["n"]:
        return hosts.withColumn("host_ok", F.lit(True))
    mean = {r: first[r] / first["n"] for r in RULES}
    spread = hosts.agg(*[F.sum(n * (F.col(f"f_{r}") / n - mean[r]) ** 2).alias(r) for r in RULES]).first()
    ok = F.lit(True)
    for r in RULES:
        a, b = beta_prior(mean[r], spread[r], first["n"], first["nn"], first["k"])
        hosts = hosts.withColumn(f"rate_{r}", (F.col(f"f_{r}") + a) / (n + (a + b)))
        ok = ok & (F.col(f"rate_{r}") < limit)
    return hosts.withColumn("host_ok", ok)


def beta_prior(mean: float, spread: float, n: float, nn: float, k: int) -> tuple[float, float]:
    """(alpha, beta) by moments of the weighted host rates: the part of their
    variance that binomial noise does not explain sets the strength."""
    var = (spread - mean * (1 - mean) * (k - 1)) / (n - nn / n) if k > 1 else 0.0
    strength = MAX_STRENGTH
    if var > 0:
        strength = min(MAX_STRENGTH, max(MIN_STRENGTH, mean * (1 - mean) / var - 1))
    return mean * strength, (1 - mean) * strength


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus the counts, ``base_failed``, ``host_ok``
    and ``kept``. Counts are written once and used by both the host aggregate
    and the join back; the host side is one row per host, so a hot host is
    pre-aggregated and its documents are spread by AQE's skew split."""
    counted = written(document_counts(docs, text_col), "rule-counts")
    verdicts = written(host_verdicts(counted, host_col).select(F.col("host").alias("_host"), "host_ok"),
                       "host-verdicts")
    joined = counted.join(verdicts, counted[host_col].eqNullSafe(verdicts["_host"]), "left")
    ok = F.coalesce("host_ok", F.lit(True))
    return (joined.withColumn("host_ok", ok).drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_ok")))


def filter_documents(docs: DataFrame) -> DataFrame:
    """Pipeline form: the documents that pass, with their own columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names)
    at = {c.lower(): n for c, n in zip(docs.columns, names)}
    kept = judge(own, at["source"], at["text"]).filter("kept").select(*names)
    return kept.toDF(*docs.columns)


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed", "kept"]


def op8_host_rules(docs: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "source", "text")).select(*COLUMNS, "host_ok")
