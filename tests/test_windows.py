import datetime as dt

from pyspark.sql import functions as F

from mailstream.operators import messages as msg
from mailstream.operators import windows


def ts(*a):
    return dt.datetime(2024, 1, 1, *a)


def test_poll_window_is_lagged_minute(spark):
    ticks = spark.createDataFrame([(ts(10, 7, 31),)], "tick timestamp_ntz")
    r = windows.poll_windows(ticks).first()
    assert (r["tick"], r["start"], r["end"]) == ("2024-01-01T10:07:31Z", "2024-01-01T10:01:00Z",
                                                 "2024-01-01T10:02:00Z")


def test_totals_fill_empty_minutes(spark):
    ev = spark.createDataFrame([(ts(0, 0, 5),), (ts(0, 0, 59),), (ts(0, 3, 0),)], "ts timestamp_ntz")
    got = [(r["start"], r["total"]) for r in windows.window_totals(ev).orderBy("start").collect()]
    assert got == [("2024-01-01T00:00:00Z", 2), ("2024-01-01T00:01:00Z", 0),
                   ("2024-01-01T00:02:00Z", 0), ("2024-01-01T00:03:00Z", 1)]


def test_route_windows_lanes(spark):
    totals = spark.createDataFrame([("s1", "e1", 2500), ("s2", "e2", 0), ("s3", "e3", None)],
                                   "start string, end string, total long")
    out = msg.route_windows(totals, "b?").collect()
    urls = sorted(r["value"] for r in out if r["topic"] == msg.URLS_TOPIC)
    assert urls == [f"b?dateDebut=s1&dateFin=e1&startIndex={i}&count=1000" for i in (1, 1001, 2001)]
    catch = {r["start"]: r["reason"] for r in out if r["topic"] == msg.CATCH_WINDOWS_TOPIC}
    assert catch == {"s2": "empty", "s3": "failed"}
    assert all(r["key"] == "" for r in out)
    placed = msg.assign_partition(msg.route_windows(totals, "b?"), 8).collect()
    assert len({r["partition"] for r in placed}) > 1      # empty keys are spread by URL


def test_late_rows(spark):
    ev = spark.createDataFrame([(ts(0, 0, 10), ts(0, 5, 0)), (ts(0, 0, 10), ts(0, 6, 0)),
                                (ts(0, 0, 10), ts(0, 6, 1))], "ts timestamp_ntz, pub timestamp_ntz")
    late = windows.late_rows(ev, "pub").collect()
    assert [r["pub"] for r in late] == [ts(0, 6, 1)]
