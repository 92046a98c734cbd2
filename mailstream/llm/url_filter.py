"""URL filters (native): rules, then logistic regression on n-grams.

Host and path are cut from the url with SQL functions. A url that no rule fits
is judged by a logistic regression on hashed character n-grams of host and
path, trained from a small labelled URL table by gradient descent on
DataFrames: each step is one aggregate of that table, its result (``BUCKETS``
sums) the only thing the driver sees. Scoring is a column expression with the
weights as a literal: no join, no shuffle.

Defined cases: a null url, or one without ``://``, has empty host and path (no
n-grams, so the bias decides); repeated rows are judged alike; an empty labelled table
allows everything; an empty table gives an empty result; extra columns are kept
by ``judge_urls``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.llm.common import lower_ascii, table

# The query's rules, (rule, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

#: Hash buckets of the n-grams, n-gram sizes, and the labelled rows used at
#: most (the first by url hash, should a larger table be given).
BUCKETS = 4096
SIZES = (3, 4)
MAX_LABELLED = 20_000
STEPS, RATE, DECAY = 15, 0.4, 1e-4
BLOCK_AT = 0.5

# The small labelled URL table: invented hosts of unwanted and ordinary kinds,
# each with a few ordinary paths, so that the host has to tell them apart, and
# unwanted paths on ordinary hosts.
BLOCKED_HOSTS = (
    "casino-royal", "free-casino", "www.casino-win", "m.big-casino", "win-jackpot", "jackpot-slots", "free-spins",
    "free-bets", "bets-today", "m.best-bets", "sport-betting", "poker-bonus", "online-poker", "cheap-pills",
    "www.pills-online", "diet-pills", "buy-viagra", "cheap-meds", "adult-cams", "sexy-cams", "free-porn",
    "xxx-videos", "hot-dating", "adult-dating", "torrent-files", "free-torrents", "crack-keygen", "warez-box",
    "payday-loans", "quick-loans", "popup-ads", "m.ads-track", "click-ads", "ads-server", "track-pixel",
    "spam-mail", "www.spam-farm", "link-farm", "seo-spam", "click-farm", "win-prizes", "free-money")
ALLOWED_HOSTS = (
    "www.garden", "blog.harbor", "m.weather", "library", "museum", "docs.project", "wiki.town", "river", "school",
    "recipes.kitchen", "travel", "forum.bikes", "journal", "www.theatre", "m.another", "blog.northern", "thread",
    "www.orchard", "theory", "radio", "maps", "health.clinic", "bank", "city.council", "m.station", "blog.letters",
    "www.nation", "science", "art", "www.heather", "m.ring", "weather-station", "town-hall", "night-sky", "open-data",
    "farmers-market", "blog.threads", "www.other", "m.thesis", "tions", "www.motion", "m.lotion", "the-whole", "wheat", "m.whistle",
    "earth", "thwart", "blog.month", "www.truth", "whither", "the-hat", "ninth", "www.both", "bathe", "m.the-other")
BLOCKED_PATHS = ("/casino/bonus", "/free-spins", "/poker/play", "/buy/cheap-pills", "/adult/videos", "/porn/1",
                 "/torrent/crack", "/warez/keygen", "/payday/apply", "/ads/popup", "/track/click", "/spam/links")
ORDINARY_PATHS = ("/en/{}", "/fr/{}/", "/de/{}.html", "/es/{}")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #``, A-Z lower-cased;
    then up to ``?`` or ``#``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3))
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits host (or a parent domain) and path, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        domain, start = rule[:rule.index("/")], rule[rule.index("/"):]
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def grams(host: Column, path: Column) -> Column:
    """Bucket of every n-gram of ``^host$`` and ``path$``, with repeats. The
    characters are zipped with their followers, so the cost is linear."""
    out = []
    for mark, s in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(path, F.lit("$")))):
        chars = F.split(s, "")
        for n in SIZES:
            shifted = [F.slice(chars, k + 1, F.length(s)).alias(f"x{k}") for k in range(n)]
            zipped = F.slice(F.arrays_zip(*shifted), 1, F.greatest(F.length(s) - n + 1, F.lit(0)))
            out.append(F.transform(zipped, _bucket(mark, n)))
    return F.concat(*out)


def _bucket(mark: str, n: int):
    return lambda g: F.pmod(F.xxhash64(F.lit(mark), *[g.getField(f"x{k}") for k in range(n)]),
                            F.lit(BUCKETS)).cast("int")


def _literal(weights: list[float]) -> Column:
    """The weights as one constant array (folded when the query is planned)."""
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def _margin(buckets: Column, weights: list[float]) -> Column:
    """bias + mean-scaled sum of weights; the bias is the last weight."""
    w = _literal(weights)
    total = F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.get(w, b))
    return F.lit(weights[-1]) + total / F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double"))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """``(url, label)``: label 1 is unwanted; about 350 rows."""
    rows = []
    for label, hosts in ((1.0, BLOCKED_HOSTS), (0.0, ALLOWED_HOSTS)):
        for i, h in enumerate(hosts):
            rows += [(f"https://{h}.example" + p.format(37 * (i + 1) * (k + 3) % 9973), label)
                     for k, p in enumerate(ORDINARY_PATHS)]
    rows += [(f"https://{h}.example{p}", 1.0) for h, p in zip(ALLOWED_HOSTS, BLOCKED_PATHS)]
    return spark.createDataFrame(rows, "url string, label double")


def train(labelled: DataFrame, steps: int = STEPS) -> list[float]:
    """Weights (``BUCKETS`` and the bias) by full-batch gradient descent, each
    weight's step scaled by its own gradients so far."""
    host, path = url_parts(F.col("url"))
    rows = labelled.filter("label is not null").orderBy(F.xxhash64("url"), "url").limit(MAX_LABELLED)
    rows = rows.select("label", grams(host, path).alias("g")).coalesce(1).cache()
    weights, seen = [0.0] * (BUCKETS + 1), [1e-8] * (BUCKETS + 1)
    n = rows.count()
    for _ in range(steps if n else 0):
        error = rows.select("g", (F.col("label") - 1 / (1 + F.exp(-_margin(F.col("g"), weights)))).alias("r"))
        share = F.col("r") / F.sqrt(F.greatest(F.size("g"), F.lit(1)).cast("double"))
        each = error.select(F.explode(F.concat("g", F.array(F.lit(BUCKETS)))).alias("b"), "r", share.alias("x"))
        step = each.groupBy("b").agg(F.sum(F.when(F.col("b") == BUCKETS, F.col("r")).otherwise(F.col("x"))).alias("d"))
        weights = [w * (1 - DECAY) for w in weights]
        for b, d in step.collect():
            seen[b] += (d / n) ** 2
            weights[b] += RATE * d / n / math.sqrt(seen[b])
    rows.unpersist()
    return weights


def judge_urls(pages: DataFrame, labelled: DataFrame | None = None, url_col: str = "url", rules=RULES) -> DataFrame:
    """All columns plus ``host, path, rule, score, verdict`` (columns of these
    names, in any letter case, are replaced); ``score`` is the
    method's probability of block, given to every url."""
    weights = train(labelled if labelled is not None else labelled_urls(pages.sparkSession))
    names = [f"c{i}" for i in range(len(pages.columns))]
    own = pages.toDF(*names)
    host, path = url_parts(own[{c.lower(): n for c, n in zip(pages.columns, names)}[url_col]])
    d = own.select("*", host.alias("host"), path.alias("path"))
    d = d.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)).withColumn("_g", grams(F.col("host"), F.col("path")))
    d = d.withColumn("score", 1 / (1 + F.exp(-_margin(F.col("_g"), weights)))).drop("_g")
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow"))
    out = d.withColumn("verdict", verdict)
    added = {"host", "path", "rule", "score", "verdict"}
    keep = [F.col(n).alias(c) for c, n in zip(pages.columns, names) if c.lower() not in added]
    return out.select(*keep, "host", "path", "rule", "score", "verdict")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")
