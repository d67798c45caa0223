"""Epoch and calendar conversions (F08-F13, F18). Clocks can be injected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone in which local dates are rendered.
LOCAL_ZONE = "+08:00"

# Fixed patterns: RFC 3339 in UTC; a timestamp may carry 1-9 fraction digits, a time none.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z$"
TIME_PATTERN = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.0{1,9})?Z$"


def now(clock: Column | None = None) -> Column:
    return F.current_timestamp() if clock is None else clock


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def second_of_millis(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp without its sub-second part."""
    return F.date_trunc("second", F.timestamp_millis(ms))


def local_date_text(ms: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), zone), "yyyy-MM-dd")


def local_time_text(ms: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.date_format(F.from_utc_timestamp(F.timestamp_millis(ms), zone), "yyyy-MM-dd HH:mm:ss")


def minutes_between(earlier: Column, later: Column) -> Column:
    """Whole minutes, truncated."""
    return F.timestamp_diff("MINUTE", earlier, later)


def rfc3339_timestamp(text: Column) -> Column:
    """Strict UTC timestamp; anything else is NULL."""
    return F.when(text.rlike(TIMESTAMP_PATTERN), F.try_to_timestamp(text))


def rfc3339_time(text: Column) -> Column:
    """Strict UTC time of day as ``HH:mm:ss``; a fraction other than zero is NULL."""
    return F.when(text.rlike(TIME_PATTERN), F.substring(text, 1, 8))
