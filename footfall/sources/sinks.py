"""Sinks.  A location with a slash is a path of parquet files, anything else a catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def _writer(df: DataFrame, mode: str) -> DataFrameWriter:
    return df.write.mode(mode).option("partitionOverwriteMode", "dynamic")


def _write_days(df: DataFrame, location: str, by: str, mode: str, rebalance: bool) -> None:
    if rebalance:
        # Even files within each day; a day that is much larger than others is split at run time.
        df = df.hint("rebalance", by)
    if "/" in location:
        _writer(df, mode).partitionBy(by).parquet(location)
    elif df.sparkSession.catalog.tableExists(location):
        in_table_order = df.select(*df.sparkSession.table(location).columns)
        _writer(in_table_order, mode).insertInto(location, overwrite=mode == "overwrite")
    else:
        df.write.mode(mode).partitionBy(by).saveAsTable(location)


def overwrite_days(df: DataFrame, location: str, by: str = "dt", rebalance: bool = False) -> None:
    """Replace exactly the day partitions that ``df`` holds; the same input twice gives the same table.

    ``rebalance`` costs a shuffle of the rows; use it when many days are written at once.
    """
    _write_days(df, location, by, "overwrite", rebalance)


def overwrite_day(df: DataFrame, location: str, day: str, by: str = "dt") -> None:
    """Replace the partition of one named day by ``df``; without rows the day is empty afterwards.

    Other days are not touched.  A column ``by`` of ``df`` is ignored.
    """
    spark, rows = df.sparkSession, df.drop(by)
    if "/" in location:
        rows.write.mode("overwrite").parquet(f"{location.rstrip('/')}/{by}={day}")
    elif spark.catalog.tableExists(location):
        columns = [c for c in spark.table(location).columns if c.lower() != by.lower()]
        named = ", ".join(f"`{c}`" for c in columns)
        query = f"insert overwrite table {location} partition ({by} = :day) ({named}) select {named} from {{rows}}"
        spark.sql(query.replace(":day", "'" + day.replace("'", "''") + "'"), rows=rows.select(*columns))
    else:
        rows.withColumn(by, F.lit(day)).write.partitionBy(by).saveAsTable(location)


def append_days(df: DataFrame, location: str, by: str = "dt", rebalance: bool = False) -> None:
    """Add rows to day partitions; a rerun adds them again."""
    _write_days(df, location, by, "append", rebalance)


def replace_table(df: DataFrame, location: str) -> None:
    """Replace an unpartitioned table."""
    writer = df.write.mode("overwrite")
    writer.parquet(location) if "/" in location else writer.saveAsTable(location)


def write_bucketed(df: DataFrame, table: str, by: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace a catalog table by ``df`` in ``buckets`` hash buckets, each sorted, and read it back.

    Rows are dealt to one task per bucket first, so a bucket is one file.  Joins of two tables with equal buckets on
    exactly ``by`` move no rows.  With ``path`` the files lie there, else in the warehouse.
    """
    writer = df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)
