"""Durations and moving date filters.  The reference time is always an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from crmweave.functions.columns import as_column

SECONDS_PER_DAY = 86400


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", as_column(start), as_column(end))


def mean_days(start: Column | str, end: Column | str, scale: int = 6) -> Column:
    """Aggregate: mean duration in days over rows that have both ends.

    The seconds are summed exactly, so the result does not depend on row order.
    """
    seconds = seconds_between(start, end)
    total = F.sum(seconds.cast("decimal(20,0)")).cast("double")
    return F.round(total / F.nullif(F.count(seconds), F.lit(0)) / SECONDS_PER_DAY, scale)


def literal_time(as_of: datetime | str) -> Column:
    return F.lit(str(as_of)).cast("timestamp_ntz")


def newer_than(value: Column | str, as_of: datetime | str, **span: int) -> Column:
    """``value > as_of - span``, e.g. ``newer_than("ts", now, hours=1)``."""
    cut = literal_time(as_of)
    if months := span.pop("months", 0):
        # timestamp_ntz plus a year-month interval keeps the type and clips month ends.
        cut = cut - F.make_ym_interval(F.lit(0), F.lit(months))
    if span:
        names = {"days": "days", "hours": "hours", "minutes": "mins", "seconds": "secs"}
        parts = {names[unit]: F.lit(count) for unit, count in span.items()}
        cut = cut - F.make_dt_interval(**parts)
    return as_column(value) > cut
