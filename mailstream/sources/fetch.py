"""Fetching pages for request URLs.

Two ways, same output ``(url, status, body)``:

* ``fetch_lookup`` - responses already landed as a table: a left outer
  equi-join, so every request keeps exactly one row and failures stay.
  A shuffle join on ``url`` by default (bodies are big and grow with the
  data), hashing the requests and streaming the bodies; a caller that
  knows its response table is small may let the planner broadcast it.
* ``fetch_live`` - a pluggable client called once per Arrow batch inside
  ``mapInPandas``; one client per task, requests spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FETCHED_SCHEMA = "url string, status int, body string"


def fetch_lookup(requests: DataFrame, responses: DataFrame, url_col: str = "url",
                 body_col: str = "body", status_col: str | None = None,
                 miss_status: int = 404, small_responses: bool = False) -> DataFrame:
    """Left join requests to landed responses. A response row without a
    status counts as 200; a request with no response gets ``miss_status``
    and a null body.

    Response bodies grow with the data and are large per row, so by default
    the join is a shuffled hash join built on the requests (URLs only; the bodies
    are streamed past them and never sorted). Its placement is left to the
    planner, so AQE can split a URL that is requested very often. Pass
    ``small_responses=True`` only for a response table known to be small, to
    let the planner broadcast it by size."""
    resp = responses.select(F.col(url_col).alias("_rurl"), F.col(body_col).alias("body"),
                            (F.col(status_col) if status_col else F.lit(200)).cast("int").alias("_rstatus"))
    if not small_responses:
        requests = requests.hint("shuffle_hash")
    joined = requests.join(resp, requests[url_col] == resp["_rurl"], "left")
    status = F.when(F.col("_rurl").isNull(), F.lit(miss_status)).otherwise(F.col("_rstatus"))
    return joined.withColumn("status", status.cast("int")).drop("_rurl", "_rstatus")


def http_get(urls: pd.Series, timeout: float = 30.0) -> pd.DataFrame:
    """Default client: plain HTTP GET with the standard library."""
    import urllib.error
    import urllib.request

    status, body = [], []
    for u in urls:
        try:
            with urllib.request.urlopen(u, timeout=timeout) as r:  # noqa: S310
                status.append(r.status)
                body.append(r.read().decode("utf-8", "replace"))
        except urllib.error.HTTPError as e:
            status.append(e.code)
            body.append(None)
        except Exception:  # noqa: BLE001 - network failure is a status, not a crash
            status.append(-1)
            body.append(None)
    return pd.DataFrame({"status": status, "body": body})


def fetch_live(requests: DataFrame, client: Callable[[pd.Series], pd.DataFrame] = http_get,
               url_col: str = "url", partitions: int | None = None) -> DataFrame:
    """Call ``client`` on batches of URLs; ``client`` returns ``status`` and
    ``body`` aligned with its input. ``partitions`` sets fetch parallelism."""
    from mailstream.session import ship_package

    ship_package(requests.sparkSession)
    req = requests.select(F.col(url_col).alias("url"))
    if partitions:
        req = req.repartition(partitions, "url")

    def run(batches):
        for b in batches:
            got = client(b["url"]).reset_index(drop=True)
            yield pd.DataFrame({"url": b["url"].reset_index(drop=True),
                                "status": got["status"].astype("int32"),
                                "body": got["body"]})

    return req.mapInPandas(run, FETCHED_SCHEMA)
