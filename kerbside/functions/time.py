"""Time expressions. All of them work on TIMESTAMP_NTZ and do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: bucket widths that do not divide a day count from Monday 2000-01-03 00:00:00.
BUCKET_ORIGIN_SECONDS = 946857600


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 of the wall-clock time."""
    ts = _col(ts)
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("long") * 86400 + clock


def hour_boundaries(start: Column | str, end: Column | str) -> Column:
    """How many full hours of the clock lie between two times: 00:59 to 07:01 crosses seven."""
    start, end = _col(start), _col(end)
    days = F.datediff(end.cast("date"), start.cast("date")).cast("long")
    return days * 24 + F.hour(end) - F.hour(start)


def bucket_start(ts: Column | str, seconds: int) -> Column:
    """Start of the fixed bucket of ``seconds`` that holds ``ts``."""
    offset = BUCKET_ORIGIN_SECONDS % seconds
    return F.window(_col(ts), f"{seconds} seconds", startTime=f"{offset} seconds")["start"]


def month_label(ts: Column | str) -> Column:
    """``yyyy-MM`` text of the month."""
    return F.date_format(_col(ts), "yyyy-MM")


def day_label(ts: Column | str) -> Column:
    """``yyyy-MM-dd`` text of the day."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def month_start(ts: Column | str) -> Column:
    """First day of the month, as a date."""
    return F.trunc(_col(ts).cast("date"), "month")
