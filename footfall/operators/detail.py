"""Contract of the event detail table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import blank_to_null

# The columns of the log and of the detail table, in table order.
LOG_COLUMNS = (
    "account", "appId", "appVersion", "carrier", "deviceId", "eventId", "ip", "latitude", "longitude",
    "netType", "osName", "osVersion", "properties", "resolution", "sessionId", "timeStamp",
)
DERIVED_DEFAULTS = {
    "splitedSessionId": "cast(null as string)",
    "filledAccount": "cast(null as string)",
    "province": "cast(null as string)",
    "city": "cast(null as string)",
    "region": "cast(null as string)",
    "guid": "cast(-1 as bigint)",
    "isnew": "0",
}
DETAIL_COLUMNS = (*LOG_COLUMNS, *DERIVED_DEFAULTS)


def to_detail(log: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned log to the 23 detail columns: '' account to null, derived columns at their defaults.

    A derived column that the input already carries is taken over.  ``keep`` names extra columns to
    pass through, such as the row id or the day.
    """
    present = {c.lower() for c in log.columns}
    log_part = [blank_to_null("account").alias("account"), *(F.col(c).alias(c) for c in LOG_COLUMNS[1:])]
    derived = [
        (F.col(c) if c.lower() in present else F.expr(default)).alias(c) for c, default in DERIVED_DEFAULTS.items()
    ]
    return log.select(*log_part, *derived, *keep)
