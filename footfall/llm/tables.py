"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns that results are about to replace, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def set_aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with numbered column names, which no column an operator adds clashes with, and the new name of each column."""
    names = {c: f"_{k}" for k, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def put_back(names: dict[str, str]) -> list[Column]:
    """The columns set aside, under the names they had."""
    return [F.col(n).alias(c) for c, n in names.items()]


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether the checksum of the id as text falls into the fold; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def look_up_hot(rows: DataFrame, keyed: DataFrame, key: str, copies: str, share: int = 1000) -> DataFrame:
    """Inner join of ``rows`` to ``keyed``, which has one row per non-null ``key`` and its number of ``copies`` in ``rows``.

    A key with more than one in ``share`` of the rows is hot.  There are fewer than ``share`` such keys, so
    they are broadcast and their rows never move; the others are joined by a shuffle without a heavy key.
    """
    total = keyed.agg(F.coalesce(F.sum(copies), F.lit(0)).alias("n")).first()["n"]
    heavy = F.col(copies) > max(total // share, 1)
    hot, rest = keyed.filter(heavy).drop(copies), keyed.filter(~heavy).drop(copies)
    names = [*rows.columns, *[c for c in hot.columns if c != key]]
    on_hot = rows.join(F.broadcast(hot), key).select(names)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key).select(names)
    return on_hot.unionByName(others)


def fields(struct: str, names: Sequence[str]) -> list[Column]:
    return [F.col(f"{struct}.{n}").alias(n) for n in names]
