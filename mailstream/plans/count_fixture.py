"""Count pages of the feed: what the server answers to a window's count probe.

One answer per minute of the span of ``events``: a feed whose
``openSearch:totalResults`` is the minute's number of events. By a fixed rule
on the minute's number (minutes since 1970) some probes fail: no answer at all,
a busy server, a cut page, a page without a total. The SQL oracle follows the
same rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailstream.functions.time import iso_minute, minute_floor
from mailstream.operators import windows
from mailstream.operators.paging import DEFAULT_BASE_URL, probe_url
from mailstream.plans.atom_fixture import FEED_CLOSE, FEED_OPEN

# Fixed values: (modulus, remainder) of the minutes whose probe fails.
LOST, BUSY, CUT, BARE = (17, 7), (11, 3), (13, 5), (19, 11)


def _is(rule: tuple[int, int]) -> Column:
    return F.col("number") % rule[0] == rule[1]


def minutes(events: DataFrame) -> DataFrame:
    """``(minute, number, total)`` of every minute from the first event's to
    the last one's."""
    counts = events.groupBy(minute_floor("ts").alias("minute")).agg(F.count(F.lit(1)).alias("total"))
    grid = windows.minute_grid(counts.agg(F.min("minute").alias("lo"), F.max("minute").alias("hi")))
    number = F.timestamp_diff("MINUTE", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("minute"))
    return grid.join(counts, "minute", "left").select("minute", number.alias("number"), F.coalesce("total", F.lit(0)).alias("total"))


def poll_ticks(events: DataFrame) -> DataFrame:
    """The clock tick that polls each of these minutes."""
    lag = F.make_interval(mins=F.lit(windows.LAG_MINUTES + windows.WINDOW_MINUTES))
    bounds = events.select(minute_floor("ts").alias("m")).agg(F.min("m").alias("lo"), F.max("m").alias("hi"))
    return windows.minute_grid(bounds).select((F.col("minute") + lag).alias("tick"))


def count_pages(events: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """``(url, status, body)`` of every probe that is answered."""
    end = F.col("minute") + F.make_interval(mins=F.lit(windows.WINDOW_MINUTES))
    total = F.concat(F.lit("<openSearch:totalResults>"), F.col("total").cast("string"), F.lit("</openSearch:totalResults>"))
    body = (F.when(_is(BUSY), F.lit("busy")).when(_is(CUT), F.concat(F.lit(FEED_OPEN), total))
            .when(_is(BARE), F.lit(FEED_OPEN + FEED_CLOSE)).otherwise(F.concat(F.lit(FEED_OPEN), total, F.lit(FEED_CLOSE))))
    return (minutes(events).filter(~_is(LOST))
            .select(probe_url(iso_minute("minute"), iso_minute(end), base_url).alias("url"),
                    F.when(_is(BUSY), 503).otherwise(200).alias("status"), body.alias("body")))
