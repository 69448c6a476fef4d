"""Daily event attribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import attribution as op
from footfall.sources import overwrite_day, read_days


def build(
    detail: DataFrame,
    target: str = op.TARGET,
    touchpoints: Sequence[str] = op.TOUCHPOINTS,
    user: str = "guid",
    converted_only: bool = False,
) -> DataFrame:
    """Linear weights of every touchpoint in ``detail``."""
    segments = op.event_segments(detail, target, touchpoints, user)
    return op.linear_weights(segments, target, user=user, converted_only=converted_only)


def run(
    spark: SparkSession,
    detail: str,
    weights: str,
    day: str,
    target: str = op.TARGET,
    touchpoints: Sequence[str] = op.TOUCHPOINTS,
    user: str = "guid",
    converted_only: bool = False,
) -> None:
    """Overwrite day ``day`` of the weight table from that day of the detail table."""
    found = build(read_days(spark, detail, day), target, touchpoints, user, converted_only)
    overwrite_day(found, weights, day)
