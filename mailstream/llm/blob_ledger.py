"""Secret scans over an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text). The
ledger is a Parquet table of ``(blob, rule_version, found)`` for the blobs that
were scanned; a run scans only the blob and rule-version pairs that it lacks, appends
them, and joins the findings back to all paths that hold the blob. Copies are
folded before the shuffle (a map-side aggregate), so a text that is
everywhere is scanned once and moved once per task.

Defined cases: a null text is the empty text; a null path is kept; repeated
rows get equal findings; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mailstream.llm.common import map_rows, written
from mailstream.session import scratch_path

#: Raise it when a rule changes: every blob is scanned again under it.
RULE_VERSION = 1

# The base kinds in their order; then the kinds added here.
KINDS = ["assign", "access", "hex", "pem", "jwt"]
BASE_KINDS = 3
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                     re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs below 24 fail anyway, so only runs that reach it are looked for
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )?PRIVATE KEY-----")
_JWT = re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}")
MIN_ASSIGN, MIN_ACCESS = 6, 20

_FOUND = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("k", T.IntegerType()),
                                   T.StructField("e", T.LongType())]))
_SCAN = T.StructType([T.StructField("blob", T.BinaryType()), T.StructField("rule_version", T.IntegerType()),
                      T.StructField("found", _FOUND)])


def scan_text(text: str) -> list[tuple[int, int, int]]:
    """All spans ``(start, kind, end)`` of a text, by start then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        out += [(m.start(), 3, m.end()) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in _JWT.finditer(text)]
    return sorted(out)


def _blob() -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty when nothing has been written there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], _SCAN)
    return spark.read.schema(_SCAN).parquet(path)


def scan_versions(versions: DataFrame, ledger: str, rule_version: int = RULE_VERSION) -> DataFrame:
    """``versions(path, version, text)`` -> ``(path, version, blob, found)``;
    the ledger at ``ledger`` grows by the blobs that were new."""
    spark = versions.sparkSession
    known = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version).select("blob")
    blobs = versions.select(_blob().alias("blob"), "text").groupBy("blob").agg(F.first("text").alias("text"))
    unseen = blobs.join(known, "blob", "left_anti")

    def rows(batch):
        for r in batch:
            yield {"blob": r["blob"], "rule_version": rule_version,
                   "found": [{"s": s, "k": k, "e": e} for s, k, e in scan_text(r["text"] or "")]}

    map_rows(unseen, _SCAN, rows).write.mode("append").parquet(ledger)
    found = (read_ledger(spark, ledger).filter((F.col("rule_version") == rule_version) & (F.size("found") > 0))
             .select("blob", "found").dropDuplicates(["blob"]))
    paths = versions.select("path", "version", _blob().alias("blob"))
    return (paths.join(written(found, "secret-findings"), "blob", "left")
            .withColumn("found", F.coalesce("found", F.array().cast(_FOUND))))


def _written_as(found) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def op9_secrets(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Span counts and digests of every document, through a ledger (a new one
    unless a path is given)."""
    where = ledger or scratch_path(docs.sparkSession, "secret-ledger")
    versions = docs.select(F.col("doc_id").cast("long").alias("path"), F.lit(0).alias("version"), "text")
    d = scan_versions(versions, where)
    base = F.filter("found", lambda x: x["k"] < BASE_KINDS)
    count = lambda i: F.size(F.filter("found", lambda x: x["k"] == i)).cast("long")
    return d.select(F.col("path").alias("doc_id"), *[count(i).alias(f"n_{KINDS[i]}") for i in range(BASE_KINDS)],
                    F.sha2(_written_as(base), 256).alias("base_sha256"), _written_as(F.col("found")).alias("spans"))
