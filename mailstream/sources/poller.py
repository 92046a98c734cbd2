"""The poll clock: one tick per interval, as a stream.

* ``tick_stream`` - the built-in ``rate-micro-batch`` source advanced by a
  fixed interval per batch: a deterministic clock for replay and tests
  (``start_ms`` sets where the clock starts);
* ``TickSource`` - a Python streaming data source (``pyspark.sql.datasource``)
  that emits the wall-clock minute grid; an offset is the absolute index of
  an interval (epoch div length), so a restarted query resumes from its
  checkpoint without skipping or repeating windows. ``originEpochSeconds`` and
  ``lastEpochSeconds`` bound it, so the clock can be replayed over a table's span.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from mailstream.functions.time import instant_to_ntz

TICK_SCHEMA = "tick timestamp_ntz"


def tick_stream(spark: SparkSession, interval_ms: int = 60_000, rows_per_batch: int = 1,
                start_ms: int = 0) -> DataFrame:
    """Ticks as ``timestamp_ntz`` (UTC wall clock), one per batch."""
    raw = (spark.readStream.format("rate-micro-batch")
           .option("rowsPerBatch", rows_per_batch)
           .option("advanceMillisPerBatch", interval_ms)
           .option("startTimestamp", start_ms).load())
    return raw.select(instant_to_ntz(F.col("timestamp")).alias("tick"))


class _TickReader(SimpleDataSourceStreamReader):
    def __init__(self, options):
        self.interval = int(options.get("intervalSeconds", "60"))
        # where a query without a checkpoint starts; offsets do not depend on it
        self.origin = int(options.get("originEpochSeconds", str(int(time.time()))))
        # a bounded clock ends with the interval of this second; ticks in one read
        last = options.get("lastEpochSeconds")
        self.last = None if last is None else int(last) // self.interval
        self.most = int(options.get("ticksPerBatch", str(1 << 62)))

    def _ticks(self, start: int, end: int):
        return iter([(dt.datetime.fromtimestamp(i * self.interval, dt.UTC).replace(tzinfo=None),)
                     for i in range(start, end)])

    def initialOffset(self):
        return {"i": self.origin // self.interval}

    def read(self, start):
        end = int(time.time()) // self.interval + 1
        if self.last is not None:
            end = min(end, self.last + 1)
        end = max(start["i"], min(end, start["i"] + self.most))
        return self._ticks(start["i"], end), {"i": end}

    def readBetweenOffsets(self, start, end):
        return self._ticks(start["i"], end["i"])

    def commit(self, end):
        pass


class TickSource(DataSource):
    """``spark.dataSource.register(TickSource)`` then
    ``spark.readStream.format("poll_ticks").option("intervalSeconds", 60)``."""

    @classmethod
    def name(cls):
        return "poll_ticks"

    def schema(self):
        return TICK_SCHEMA

    def simpleStreamReader(self, schema):
        return _TickReader(self.options)


def register_tick_source(spark: SparkSession) -> None:
    """Register ``poll_ticks``. The source is planned in a separate Python
    process that does not see files added with ``addPyFile``, so this module
    is pickled by value (the class travels with the query)."""
    import sys

    from pyspark import cloudpickle

    from mailstream.session import ship_package

    ship_package(spark)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TickSource)
