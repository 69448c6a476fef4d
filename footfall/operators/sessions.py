"""Session splitting by inactivity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GAP_MS = 30 * 60 * 1000


def split_sessions(
    log: DataFrame,
    session: str = "sessionId",
    ts: str = "timeStamp",
    gap_ms: int = GAP_MS,
    out: str = "splitedSessionId",
) -> DataFrame:
    """Cut a session wherever two neighbouring events lie more than ``gap_ms`` apart.

    Time is cut into cells as wide as the gap.  Two events of one cell are less than a gap apart, so a
    cut can only fall between cells, and first and last event time of each (session, cell) decide it.
    These come from a map-side combined aggregation; the rows themselves are never sorted or gathered
    by session, they only look up the start of their cell's part.  A session that holds a large share
    of the log meets itself with one row per cell, and the lookup join can be split at run time.
    The id is ``<session>_<time of the first event of the part>``: the same on every run, and different for
    parts that come in different batches.
    """
    # div alone rounds towards zero, which would make the cell around 0 twice as wide
    cell = F.expr(f"(`{ts}` - pmod(`{ts}`, {gap_ms})) div {gap_ms}")
    cells = log.withColumn("_cell", cell)
    by_time = W.partitionBy(session).orderBy("_cell")
    cuts = (
        cells.groupBy(session, "_cell")
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
        .withColumn("_cut", F.coalesce(F.col("_first") - F.lag("_last").over(by_time) > gap_ms, F.lit(True)))
        .withColumn("_start", F.last(F.when(F.col("_cut"), F.col("_first")), ignorenulls=True).over(by_time))
        .select(session, "_cell", "_start")
    )
    return (
        cells.drop(out)
        .join(cuts, [session, "_cell"], "left")
        .withColumn(out, F.concat(session, F.lit("_"), "_start"))
        .drop("_cell", "_start")
    )
