"""Time helpers for TIMESTAMP_NTZ columns; none depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_hours(ts: Column) -> Column:
    """Whole hours since 1970; differences count the hour boundaries crossed."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 24 + F.hour(ts)


def years_between(earlier: Column, later: Column) -> Column:
    """Calendar-year boundaries crossed."""
    return F.year(later) - F.year(earlier)


def round_to_minute(ts: Column) -> Column:
    """Nearest minute: 29.998 seconds go down, 29.999 go up."""
    moved = ts + F.expr("INTERVAL '30.001' SECOND")
    return F.make_timestamp_ntz(
        F.year(moved), F.month(moved), F.day(moved), F.hour(moved), F.minute(moved), F.lit(0)
    )


def moment(value) -> Column:
    """A Python datetime as TIMESTAMP_NTZ."""
    return F.lit(str(value)).cast("timestamp_ntz")
