"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8): one cold run, then the median of three
warm runs. Every run executes the whole plan through the ``noop`` sink
(no rows are collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mailstream.plans.queries import queries  # noqa: E402
from mailstream.session import build_session  # noqa: E402

HEADLINE = ["wordcount", "wordcount_top10", "page_plan", "window_totals", "route_windows",
            "parcels", "parcels_last", "route_pages", "stream_wordcount", "stream_window_totals"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [a for a in sys.argv[1:]] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="mailstream-bench", shuffle_partitions=8 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    qs = queries()
    times: dict[str, float] = {}
    for n in names:
        run(qs[n](spark, sf_dir))                      # cold: JIT, file listing
        warm = []
        for _ in range(3):
            t0 = time.perf_counter()
            run(qs[n](spark, sf_dir))
            warm.append(time.perf_counter() - t0)
        times[n] = round(statistics.median(warm), 3)
    rates = {}
    if "stream_wordcount" in times:
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        rates["stream_wordcount_rows_per_sec"] = round(events / times["stream_wordcount"], 1)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total_warm_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "rates": rates,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
