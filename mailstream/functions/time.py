"""Time helpers. Wall-clock values are ``timestamp_ntz`` (UTC by
convention); everything here is independent of the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feed API's date formats (UTC, minute grid).
MINUTE_FORMAT = "yyyy-MM-dd'T'HH:mm':00Z'"
SECOND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_EPOCH = _dt.datetime(1970, 1, 1)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def iso_minute(ts) -> Column:
    """UTC ISO text truncated to the minute (seconds printed as ``00``)."""
    return F.date_format(_c(ts), MINUTE_FORMAT)


def iso_second(ts) -> Column:
    return F.date_format(_c(ts), SECOND_FORMAT)


def minute_floor(ts) -> Column:
    """Start of the minute, keeping the ``timestamp_ntz`` type."""
    return F.window(_c(ts), "1 minute").start


def minute_start(ts) -> Column:
    """``minute_floor`` as a plain expression: rows without a time stay (the
    window function filters them out)."""
    return _c(ts) - F.make_interval(secs=F.date_part(F.lit("SECOND"), _c(ts)))


def lagged_window(tick, lag_minutes: int = 5, length_minutes: int = 1):
    """The window a poll at ``tick`` asks for: ``[tick-lag-len, tick-lag)``
    on the minute grid. Returns ``(start, end)`` NTZ columns."""
    t = minute_floor(tick)
    end = t - F.make_interval(mins=F.lit(lag_minutes))
    start = t - F.make_interval(mins=F.lit(lag_minutes + length_minutes))
    return start, end


def instant_to_ntz(ts) -> Column:
    """An instant (``timestamp``) as UTC wall clock, without consulting the
    session time zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)),
                           F.lit(_EPOCH).cast("timestamp_ntz"))
