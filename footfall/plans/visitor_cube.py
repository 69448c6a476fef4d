"""Visitor cube of page views, and its roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from footfall.operators.visitors import base_cuboid, roll_up, visitor_counts
from footfall.sources import read_csv, read_table, replace_table

# Dimensions and measure of the page-view cube.
DIMS = ("devicetype", "province", "isnew")
MEASURES = ("acc_tml",)


def report(
    cuboid: DataFrame, dims: Sequence[str], measures: Sequence[str] = MEASURES, keep_bitmaps: bool = False
) -> DataFrame:
    """Visitors and measures over ``dims`` from a stored cuboid, or its bitmaps for a further roll-up."""
    rolled = roll_up(cuboid, dims, measures)
    return rolled if keep_bitmaps else visitor_counts(rolled, dims, measures)


def run(
    spark: SparkSession,
    page_views: str,
    cuboid: str,
    dims: Sequence[str] = DIMS,
    measures: Sequence[str] = MEASURES,
    visitor: str = "guid",
    report_dims: Sequence[str] = (),
    rolled_up: str | None = None,
) -> DataFrame:
    """Store the base cuboid of a CSV log and return it, read back.

    With ``rolled_up`` its roll-up over ``report_dims`` is stored there too.
    """
    replace_table(base_cuboid(read_csv(spark, page_views), dims, visitor, measures), cuboid)
    stored = read_table(spark, cuboid)
    if rolled_up is not None:
        replace_table(report(stored, report_dims, measures), rolled_up)
    return stored
