"""Scans.  A location with a slash is a path of files, anything else a catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns of the sample page-view log.
PAGE_VIEW_SCHEMA = (
    "guid int, ip string, sesid string, pgid string, jpout string, acc_tml int, "
    "deviceType string, province string, isnew int"
)


def read_table(spark: SparkSession, location: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table, or the files below a path."""
    return spark.read.format(fmt).load(location) if "/" in location else spark.table(location)


def read_days(
    spark: SparkSession, location: str, from_day: str, to_day: str | None = None, by: str = "dt"
) -> DataFrame:
    """The day partitions ``[from_day, to_day)``, or just ``from_day``; the files of other partitions are not read."""
    day = F.col(by).cast("string")
    wanted = day == from_day if to_day is None else (day >= from_day) & (day < to_day)
    return read_table(spark, location).where(wanted)


def read_csv(spark: SparkSession, path: str, schema: str = PAGE_VIEW_SCHEMA) -> DataFrame:
    """CSV files with a header line; the schema is given, so no pass over the data is spent on inferring it."""
    return spark.read.csv(path, schema=schema, header=True)


def id_splits(ids: DataFrame, partitions: int, column: str = "id") -> list[str]:
    """Conditions on ``column`` that part the table into pieces of about equal size: between quantiles of a sample of its ids.

    The first takes nulls too, and the outer ones are open, so every row meets exactly one of them.  An empty sample
    gives a single condition for all rows.
    """
    shares = [k / partitions for k in range(1, partitions)]
    row = ids.agg(F.percentile_approx(column, shares, 10_000).alias("cuts")).first() if shares else None
    cuts = sorted(set(row["cuts"] or [])) if row else []
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {low} and {column} < {high}" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} or {column} is null", *inner, f"{column} >= {cuts[-1]}"]


def read_areas_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partitions: int,
    column: str = "id",
    sample_every: int = 64,
) -> DataFrame:
    """The area tree from a database, in parallel ranges of ``column``; user and password are the caller's.

    The ranges follow the ids that are there: one in ``sample_every`` ids (by remainder) is read first, that column alone, and
    its quantiles part the table, so gaps and dense stretches make no partition much larger than the others.
    """
    sample = f"(select {column} from {table} where mod({column}, {sample_every}) = 0) ids"
    splits = id_splits(spark.read.jdbc(url, sample, properties=properties), partitions, column)
    return spark.read.jdbc(url, table, predicates=splits, properties=properties)
