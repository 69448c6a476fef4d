"""Global visitor ids (guid) kept in a snapshot table.

The rule, in event order: an event with a stored account takes the guid of the account.  Otherwise a
stored device gives its guid, and when the event has an account the key moves from the device to
the account.  Otherwise the next number is issued under the account, or under the device when the
event is anonymous.

Seen from one device, only two kinds of rows matter: anonymous events, and the first event of each
account that is not stored yet (a *binder*), since a binder always leaves the device without a key.  The
binders cut the device's time into *visits*: the anonymous events of one visit and the binder that
closes it share one guid.  That is the device's stored guid for the first visit if there is one, else
one new number, issued at the first row of the visit.  So the sequential rule becomes a running
count of binders, one aggregation per visit, and one dense numbering.

The store has columns ``kind`` ('A' account, 'D' device, 'C' counter), ``k`` and ``guid``; one row per
(kind, k).  Rows must carry a device id.  ``order`` names the event order, epoch milliseconds first.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.lookup import look_up_hot
from footfall.operators.ordering import dense_numbers, running_count

ACCOUNT, DEVICE, COUNTER = "A", "D", "C"
COUNTER_KEY = "guid_cnt"
STORE_SCHEMA = "kind string, k string, guid bigint"
ORDER = ("timeStamp", "event_id")


def _keys(store: DataFrame, kind: str, name: str, guid: str) -> DataFrame:
    return store.where(F.col("kind") == kind).select(F.col("k").alias(name), F.col("guid").alias(guid))


def stored_counter(store: DataFrame) -> int:
    """The last number issued so far; reads one row."""
    row = store.where((F.col("kind") == COUNTER) & (F.col("k") == COUNTER_KEY)).select("guid").first()
    return row[0] if row else 0


def new_account_binders(
    events: DataFrame,
    store: DataFrame,
    account: str = "filledAccount",
    device: str = "deviceId",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """First event of each account that the store does not hold: account, device and event order.

    Combined before the shuffle, so a busy account costs one row per task.
    """
    first = F.min(F.struct(*order, device)).alias("_first")
    stored = _keys(store, ACCOUNT, account, "_guid").select(account)
    return (
        events.where(F.col(account).isNotNull())
        .groupBy(account)
        .agg(first)
        .join(stored, account, "left_anti")
        .select(account, f"_first.{device}", *(f"_first.{c}" for c in order))
    )


def device_visits(
    events: DataFrame,
    store: DataFrame,
    account: str = "filledAccount",
    device: str = "deviceId",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """Anonymous events and binders with ``visit_no``, the number of binders before them on the device.

    Anonymous rows keep all their columns; binder rows carry the order, device and account only.
    """
    anonymous = events.where(F.col(account).isNull())
    binders = new_account_binders(events, store, account, device, order)
    both = anonymous.unionByName(binders, allowMissingColumns=True)
    return running_count(both, [device], [*order, account], F.col(account).isNotNull(), "visit_no")


def visit_starts(
    visits: DataFrame,
    store: DataFrame,
    account: str = "filledAccount",
    device: str = "deviceId",
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """One row per (device, visit): event order of its first row, the account that closed it (null while
    it is open) and, for a first visit, the guid stored for the device."""
    per_visit = visits.groupBy(device, "visit_no").agg(
        F.min(F.struct(*order)).alias("_at"), F.max(account).alias("bound_account")
    )
    stored = _keys(store, DEVICE, device, "stored_guid").withColumn("visit_no", F.lit(0).cast("bigint"))
    return per_visit.join(stored, [device, "visit_no"], "left").select(
        device, "visit_no", "bound_account", "stored_guid", *(f"_at.{c}" for c in order)
    )


def visit_guids(
    starts: DataFrame, base: int, device: str = "deviceId", order: Sequence[str] = ORDER
) -> DataFrame:
    """One row per (device, visit) with its guid: the stored one, else the next number after ``base``."""
    fresh = F.col("stored_guid").isNull()
    numbered = dense_numbers(starts, [*order, device], "_number", F.lit(base).cast("bigint"), flag=fresh)
    return numbered.select(
        device, "visit_no", "bound_account", F.coalesce("stored_guid", "_number").alias("guid")
    )


def account_guids(store: DataFrame, visit_ids: DataFrame, account: str = "filledAccount") -> DataFrame:
    """Guid of every account: the stored ones and those bound in this batch."""
    bound = visit_ids.where(F.col("bound_account").isNotNull()).select(
        F.col("bound_account").alias(account), "guid"
    )
    return _keys(store, ACCOUNT, account, "guid").unionByName(bound)


def assign_guids(
    events: DataFrame,
    visits: DataFrame,
    visit_ids: DataFrame,
    store: DataFrame,
    account: str = "filledAccount",
    device: str = "deviceId",
) -> DataFrame:
    """Every event with its ``guid``: by account when it has one, else by the visit it belongs to.

    Both lookups have one row per key; a sketch finds the busy accounts and visits, whose rows need not meet.
    """
    columns = [c for c in events.columns if c.lower() != "guid"]
    known = events.where(F.col(account).isNotNull()).select(*columns)
    by_account = look_up_hot(known, account_guids(store, visit_ids, account), [account]).select(*columns, "guid")
    ids = visit_ids.select(device, "visit_no", F.col("guid").alias("_guid"))
    anonymous = visits.where(F.col(account).isNull()).select(*columns, "visit_no")
    by_visit = look_up_hot(anonymous, ids, [device, "visit_no"]).select(*columns, F.col("_guid").alias("guid"))
    return by_account.unionByName(by_visit)


def mark_new_visitors(events: DataFrame, base: int, guid: str = "guid", out: str = "isnew") -> DataFrame:
    """1 for a guid issued after ``base``, the counter before the batch; else 0."""
    return events.withColumn(out, F.when(F.col(guid) > F.lit(base), 1).otherwise(0))


def next_store(store: DataFrame, visit_ids: DataFrame, base: int, device: str = "deviceId") -> DataFrame:
    """The store after the batch: new keys in, moved device keys out, counter advanced."""
    accounts = account_guids(store, visit_ids, "k").select(F.lit(ACCOUNT).alias("kind"), "k", "guid")
    still_open = visit_ids.where(F.col("bound_account").isNull()).select(
        F.lit(DEVICE).alias("kind"), F.col(device).alias("k"), "guid"
    )
    seen = visit_ids.select(F.col(device).alias("k")).distinct()
    untouched = store.where(F.col("kind") == DEVICE).join(seen, "k", "left_anti").select("kind", "k", "guid")
    counter = visit_ids.agg(F.greatest(F.max("guid"), F.lit(base).cast("bigint")).alias("guid")).select(
        F.lit(COUNTER).alias("kind"), F.lit(COUNTER_KEY).alias("k"), "guid"
    )
    return accounts.unionByName(still_open).unionByName(untouched).unionByName(counter)


def store_changes(visit_ids: DataFrame, base: int, device: str = "deviceId") -> DataFrame:
    """What the batch changes in the store: rows with ``kind``, ``k``, ``guid`` and ``_removed``, one per key.

    Bound accounts come in, devices with an open visit come in or change, other devices of the batch go, and the counter
    moves on.  The store is not read, so this is as long as the batch has visits.
    """
    kept = F.lit(False).alias("_removed")
    accounts = visit_ids.where(F.col("bound_account").isNotNull()).select(F.lit(ACCOUNT).alias("kind"), F.col("bound_account").alias("k"), "guid", kept)
    still_open = F.max(F.when(F.col("bound_account").isNull(), F.col("guid"))).alias("guid")
    devices = visit_ids.groupBy(F.col(device).alias("k")).agg(still_open)
    devices = devices.select(F.lit(DEVICE).alias("kind"), "k", "guid", F.col("guid").isNull().alias("_removed"))
    counter = visit_ids.agg(F.greatest(F.max("guid"), F.lit(base).cast("bigint")).alias("guid"))
    counter = counter.select(F.lit(COUNTER).alias("kind"), F.lit(COUNTER_KEY).alias("k"), "guid", kept)
    return accounts.unionByName(devices).unionByName(counter)


def resolve(
    events: DataFrame,
    store: DataFrame,
    base: int,
    stage: Callable[[DataFrame, str], DataFrame],
    account: str = "filledAccount",
    device: str = "deviceId",
    order: Sequence[str] = ORDER,
    changes_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``events`` with ``guid`` and ``isnew``, and the next store, or with ``changes_only`` what changes in it.

    Pass narrow events, read from a table.  ``stage`` writes the visits and their guids, which several
    later steps read; each is narrower or shorter than the one before.
    """
    visits = stage(device_visits(events, store, account, device, order), "visits")
    starts = stage(visit_starts(visits, store, account, device, order), "visit_starts")
    ids = stage(visit_guids(starts, base, device, order), "visit_guids")
    rows = mark_new_visitors(assign_guids(events, visits, ids, store, account, device), base)
    return rows, store_changes(ids, base, device) if changes_only else next_store(store, ids, base, device)
