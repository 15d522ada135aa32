"""Points in time as columns."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def at(when: datetime | None) -> Column:
    """A literal instant, or the query's own time if none is given."""
    if when is None:
        return F.current_timestamp()
    if when.tzinfo is None:
        raise ValueError("a time without offset is ambiguous; pass a datetime with tzinfo")
    return F.lit(when)


def hours_before(when: Column, hours: int) -> Column:
    return when - F.make_dt_interval(hours=F.lit(hours))


def days_before(when: Column, days: int) -> Column:
    return when - F.make_dt_interval(days=F.lit(days))
