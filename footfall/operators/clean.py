"""Cleaning rules of the raw event log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import blank_to_null, day_start_ms, is_not_blank, next_day


def parse_properties(log: DataFrame, column: str = "properties") -> DataFrame:
    """JSON text to map<string,string>; malformed text becomes null.

    Followed by :func:`required_fields`, malformed rows are dropped.
    """
    return log.withColumn(column, F.from_json(column, "map<string,string>"))


def strip_properties(log: DataFrame, obsolete: Sequence[str], column: str = "properties") -> DataFrame:
    """Remove obsolete keys from the property map.

    Best after the filters: a lambda is not compiled, so it should not become part of their condition.
    """
    return log.withColumn(column, F.map_filter(column, lambda key, _: ~key.isin(list(obsolete))))


def required_fields(
    log: DataFrame,
    not_blank: Sequence[str] = ("deviceId", "eventId", "sessionId"),
    not_null: Sequence[str] = ("properties",),
) -> DataFrame:
    """Keep the rows whose key fields carry a value."""
    tests = [is_not_blank(c) for c in not_blank] + [F.col(c).isNotNull() for c in not_null]
    return log.where(reduce(Column.__and__, tests))


def day_window(
    log: DataFrame,
    from_day: str | Column,
    to_day: str | Column | None = None,
    ts: str = "timeStamp",
    zone: str = "UTC",
) -> DataFrame:
    """Keep events of ``[from_day 00:00, to_day 00:00)`` in ``zone``; one day when ``to_day`` is left out.

    ``from_day`` may be a column (say the partition day of the row) to check many days in one scan.
    """
    end = next_day(from_day) if to_day is None else to_day
    return log.where((F.col(ts) >= day_start_ms(from_day, zone)) & (F.col(ts) < day_start_ms(end, zone)))


def blank_account_to_null(log: DataFrame, account: str = "account") -> DataFrame:
    """'' accounts become null."""
    return log.withColumn(account, blank_to_null(account))
