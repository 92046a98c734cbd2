"""Compare every registered query with its DuckDB oracle (the driver's
check, locally): row count, column names and an order-insensitive hash of
the values, with columns sorted by name.

    python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from mailstream.plans.oracle import oracle_sql  # noqa: E402
from mailstream.plans.queries import queries  # noqa: E402
from mailstream.session import build_session  # noqa: E402
from mailstream.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
                 "double": "DOUBLE", "float": "FLOAT", "timestamp_ntz": "TIMESTAMP",
                 "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(df, cur):
    duck = {d[0]: str(d[1]) for d in cur.description}
    out = []
    for f in df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if f.name in duck and duck[f.name].upper() != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duckdb {duck[f.name]}")
    return out


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    tz = os.environ.get("CHECK_SESSION_TZ")
    if os.environ.get("CHECK_PLAIN_SESSION"):
        from pyspark.sql import SparkSession   # Spark defaults only, as a foreign driver would
        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    else:
        spark = build_session("local[8]", shuffle_partitions=8,
                              extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names or list(qs):
        t0 = time.time()
        try:
            df = qs[n](spark, sf)
            cols, rows = df.columns, [tuple(r) for r in df.collect()]
            ts = time.time() - t0
            if n not in sqls:
                print(f"{n:24s} rows={len(rows)} (no oracle) {ts:.1f}s")
                continue
            cur = con.execute(sqls[n])
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
            tm = type_mismatches(df, cur)
            if tm:
                print(f"{n:24s} TYPES {tm}")
            h1, l1 = digest(cols, rows)
            h2, l2 = digest(ocols, orows)
            ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
            bad += not ok
            print(f"{n:24s} {'OK ' if ok else 'BAD'} rows={len(rows)}/{len(orows)} {ts:.1f}s"
                  + ("" if sorted(cols) == sorted(ocols) else f" cols {sorted(cols)} vs {sorted(ocols)}"))
            if not ok and sorted(cols) == sorted(ocols):
                a, b = set(l1), set(l2)
                for x in sorted(a - b)[:3]:
                    print("   spark :", x[:600])
                for x in sorted(b - a)[:3]:
                    print("   oracle:", x[:600])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{n:24s} ERROR {type(e).__name__}: {str(e)[:500]}")
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
