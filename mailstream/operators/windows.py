"""Fixed-lag polling windows over an event clock.

A poll at tick ``t`` asks the feed for the 1-minute window
``[t-6m, t-5m)``: anything published more than five minutes after its
minute is never asked for again. Windows are on the UTC minute grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailstream.functions.time import iso_minute, iso_second, lagged_window, minute_floor

# Poll lag and window length (minutes).
LAG_MINUTES = 5
WINDOW_MINUTES = 1


def poll_windows(ticks: DataFrame, tick_col: str = "tick",
                 lag: int = LAG_MINUTES, length: int = WINDOW_MINUTES) -> DataFrame:
    """Tick -> the window it polls: ``tick, window{start,end}, start, end``
    (``start``/``end`` are the API's minute strings)."""
    start, end = lagged_window(F.col(tick_col), lag, length)
    return ticks.select(
        iso_second(tick_col).alias("tick"),
        F.struct(start.alias("start"), end.alias("end")).alias("window"),
        iso_minute(start).alias("start"),
        iso_minute(end).alias("end"),
    )


def clock_ticks(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Distinct minute ticks of an event clock (one poll per minute that saw
    events). A partial+final aggregate bounded by the number of minutes."""
    return events.select(minute_floor(ts_col).alias("tick")).distinct()


def minute_grid(bounds: DataFrame, lo_col: str = "lo", hi_col: str = "hi") -> DataFrame:
    """Every minute from ``lo`` to ``hi`` inclusive (both on the minute
    grid). Rows grow with the time span (43,200 per 30 days), never with
    data volume; hours are exploded first and spread over tasks, so even a
    span of years is generated in parallel."""
    hours = bounds.select(
        F.explode(F.sequence(F.col(lo_col), F.col(hi_col), F.make_interval(hours=F.lit(1))))
        .alias("_h"), F.col(hi_col).alias("_hi"))
    hours = hours.repartition(F.col("_h"))
    minute = F.col("_h") + F.make_interval(mins=F.col("_m"))
    return (hours.select("_h", "_hi", F.explode(F.sequence(F.lit(0), F.lit(59))).alias("_m"))
            .select(minute.alias("minute"), "_hi")
            .filter(F.col("minute") <= F.col("_hi"))
            .select("minute"))


def window_totals(events: DataFrame, ts_col: str = "ts",
                  length: int = WINDOW_MINUTES) -> DataFrame:
    """Row count per window on a gap-free minute grid, so empty windows
    appear with total 0 (those are what the catch lane receives).

    Counting is a partial+final aggregate on the minute; the grid comes
    from the min/max of that small result and is left-joined to it (AQE
    broadcasts the smaller side once its real size is known).
    """
    counts = (events.select(minute_floor(ts_col).alias("minute"))
              .groupBy("minute").agg(F.count(F.lit(1)).alias("total")))
    bounds = counts.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi"))
    grid = minute_grid(bounds)
    end = F.col("minute") + F.make_interval(mins=F.lit(length))
    return (grid.join(counts, "minute", "left")
            .select(F.struct(F.col("minute").alias("start"), end.alias("end")).alias("window"),
                    iso_minute("minute").alias("start"),
                    iso_minute(end).alias("end"),
                    F.coalesce(F.col("total"), F.lit(0)).cast("long").alias("total")))


def late_rows(events: DataFrame, published_col: str, ts_col: str = "ts",
              lag: int = LAG_MINUTES, length: int = WINDOW_MINUTES) -> DataFrame:
    """Rows published after the only poll that covers their minute
    (``minute(ts) + lag + length``); a fixed-lag poller never sees them."""
    minute = minute_floor(ts_col)
    poll_at = minute + F.make_interval(mins=F.lit(lag + length))
    return (events.withColumn("_poll", poll_at)
            .filter(F.col(published_col) > F.col("_poll"))
            .drop("_poll"))
