"""Calendar days, as ``yyyy-MM-dd`` text or as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_date(day: Column | str | None) -> Column:
    if day is None:
        return F.current_date()
    return (F.lit(day) if isinstance(day, str) else day).cast("date")


def current_day(day: Column | str | None = None) -> Column:
    """The given day, or today, as ``yyyy-MM-dd`` text."""
    return _as_date(day).cast("string")


def next_day(day: Column | str | None = None) -> Column:
    """The day after the given day (or today), as ``yyyy-MM-dd`` text."""
    return F.date_add(_as_date(day), 1).cast("string")


def previous_day(day: Column | str | None = None) -> Column:
    """The day before the given day (or today), as ``yyyy-MM-dd`` text."""
    return F.date_sub(_as_date(day), 1).cast("string")


def day_start_ms(day: Column | str, zone: str = "UTC") -> Column:
    """Epoch milliseconds of midnight of ``day`` in ``zone``, whatever the session zone is.

    With a literal day it folds to a constant, so a range test on a timestamp column reaches the scan.
    """
    midnight = F.concat(_as_date(day).cast("string"), F.lit(f" 00:00:00 {zone}"))
    return F.unix_millis(midnight.cast("timestamp"))
