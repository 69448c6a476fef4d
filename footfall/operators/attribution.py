"""Event attribution: which touchpoints led to a target event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.operators.lookup import look_up_hot
from footfall.operators.ordering import CELL, row_positions, running_count, with_cell

# The coupon attribution job's events and the labels in its result table.
TARGET = "fetchCoupon"
TOUCHPOINTS = ("goodsView", "addCart", "adShow")
MODEL = "优惠券获取归因分析"
STRATEGY = "线性归因"


def ordered_events(
    events: DataFrame, user: str = "guid", ts: str = "timeStamp", event: str = "eventId", tie: Sequence[str] = ()
) -> DataFrame:
    """Each user's events with their place ``position`` 1..n by (time, event)."""
    return row_positions(events.where(F.col(user).isNotNull()), [user], [ts, event, *tie], "position")


def event_lists(
    events: DataFrame,
    user: str = "guid",
    ts: str = "timeStamp",
    event: str = "eventId",
    part_size: int = 10_000,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Ordered ``"<ts>_<event>"`` lists per user, in parts of ``part_size``.

    A list longer than ``part_size`` continues in the next ``part`` (0, 1, ...), so no row and no task
    has to hold all events of a very busy user, and none is dropped.
    """
    placed = ordered_events(events, user, ts, event, tie)
    entry = F.struct(F.col("position").alias("p"), F.concat_ws("_", ts, event).alias("e"))
    return (
        placed.withColumn("part", F.expr(f"(position - 1) div {part_size}"))
        .groupBy(user, "part")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(user, "part", F.col("_entries.e").alias("events"))
    )


def event_segments(
    events: DataFrame,
    target: str = TARGET,
    touchpoints: Sequence[str] = TOUCHPOINTS,
    user: str = "guid",
    ts: str = "timeStamp",
    event: str = "eventId",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Target and touchpoint events with ``segment``, the number of targets the user had before.

    A target closes its segment and carries the segment's number (``is_target``).
    """
    wanted = events.where(F.col(event).isin(target, *touchpoints) & F.col(user).isNotNull())
    counted = running_count(wanted, [user], [ts, event, *tie], F.col(event) == target, "segment")
    return counted.withColumn("is_target", F.col(event) == target)


def linear_weights(
    segments: DataFrame,
    target: str = TARGET,
    model: str = MODEL,
    strategy: str = STRATEGY,
    user: str = "guid",
    event: str = "eventId",
    converted_only: bool = False,
    ts: str = "timeStamp",
) -> DataFrame:
    """Each touchpoint of a segment gets 100 / number of touchpoints in it; repeats are rows of their own.

    Events after the last target, and users without any, count as a segment too;
    ``converted_only=True`` leaves them out.

    A segment may hold a large share of all rows, so its touchpoints are not joined to its size but, cell
    by cell, to a summary row of the cell that knows it; only those summary rows meet in one window.  A cell that a
    burst crowds is found by a sketch and looked up without a shuffle by cell.
    """
    cells = with_cell(segments, ts)
    touches = cells.where(~F.col("is_target"))
    whole = W.partitionBy(user, "segment")
    per_cell = cells.groupBy(user, "segment", CELL).agg(
        F.count_if(~F.col("is_target")).alias("_touches"), F.count_if("is_target").alias("_targets")
    )
    sizes = per_cell.select(
        user, "segment", CELL, F.sum("_touches").over(whole).alias("_size"), F.sum("_targets").over(whole).alias("_targets")
    )
    if converted_only:
        sizes = sizes.where("_targets > 0")
    return look_up_hot(touches, sizes, [user, "segment", CELL], "inner").select(
        F.lit(model).alias("model"),
        F.lit(strategy).alias("strategy"),
        user,
        F.lit(target).alias("dest_event"),
        F.col(event).alias("attr_event"),
        (F.lit(100.0) / F.col("_size")).alias("weight"),
    )
