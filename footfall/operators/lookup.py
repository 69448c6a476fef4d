"""Looking up one row per key when a key may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

# A key is hot if more than one in so many rows has it, so there are fewer hot keys than that.
HOT_SHARE = 512
# A sketch of this many entries misses no such key: its error is below a quarter of that share.
_SKETCH_ITEMS = 10 * HOT_SHARE
# Below this size, as Spark estimates it before running, a single task can take a key with all rows, and no sketch is made.
LEAST_BYTES = 64 * 2**20
# Sketches are merged in two levels, so no task merges those of all tasks.
_SKETCH_GROUPS = 64


def look_up(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per ``on``.

    Adaptive execution splits a hot key only where both sides of a join come straight from a shuffle.  A
    table that was just aggregated by the key would be joined in place instead.  Joining on a digest of
    the key as well makes it shuffle once more, which is cheap at one row per key, and keeps the
    rows splittable.  A small table is still broadcast.
    """
    named = {c: f"_{c}_of_table" for c in on}
    pairs: list[Column] = [F.col(c) == F.col(n) for c, n in named.items()]
    digest = F.xxhash64(*on) == F.xxhash64(*named.values())
    same = reduce(Column.__and__, pairs, digest)
    return rows.join(table.withColumnsRenamed(named), same, how).drop(*named.values())


def may_crowd(rows: DataFrame) -> bool:
    """Whether ``rows`` come from so much data that one key of them could crowd a task; asks the planner, runs no job.

    What is read counts; the planner's estimate of a join is the product of its sides, far more than any lookup gives.
    """
    leaves = rows._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())) >= LEAST_BYTES


def hot_keys(rows: DataFrame, key: Column) -> DataFrame:
    """``item``, ``share``, ``total``: a superset of the keys that more than one in ``HOT_SHARE`` rows has, fewer than ``HOT_SHARE`` in all.

    ``key`` is a bigint expression; null is never hot, and ``share`` is of the ``total`` rows with a key.  A frequent-items sketch
    finds them in one pass that shuffles sketches only.  An empty table gives no rows.
    """
    keyed = rows.select(key.alias("key"), (F.spark_partition_id() % _SKETCH_GROUPS).alias("group")).where("key is not null")
    some = keyed.groupBy("group").agg(F.expr(f"approx_top_k_accumulate(key, {_SKETCH_ITEMS})").alias("sketch"), F.count("*").alias("n"))
    # Grouped, since sketches of nothing cannot be combined.
    all_ = some.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {_SKETCH_ITEMS})").alias("sketch"), F.sum("n").alias("n"))
    found = all_.select("n", F.explode(F.expr(f"approx_top_k_estimate(sketch, {HOT_SHARE - 1})")).alias("found"))
    return found.select("found.item", (F.col("found.count") / F.col("n")).alias("share"), F.col("n").alias("total"))


def spread(rows: DataFrame) -> Column:
    """A number that differs between rows that differ: where a row may go when its key must not decide.

    It is a pure function of the row, so a repeated task deals its rows out as before.
    """
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if not _holds_map(f.dataType)]
    return F.xxhash64(*hashed) if hashed else F.lit(0).cast("bigint")


def _holds_map(kind) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return True
    if hasattr(kind, "elementType"):
        return _holds_map(kind.elementType)
    return any(_holds_map(f.dataType) for f in getattr(kind, "fields", ()))


def look_up_hot(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """:func:`look_up` that needs no help at run time to stay even: hot keys are found by a sketch first.

    The table's rows of hot keys are broadcast, fewer than ``HOT_SHARE`` of them.  In the shuffle for the other
    keys, rows with a hot key or a null one are dealt out by their own digest and match nothing, so no
    partition holds more than a small share, with adaptive execution or without.  ``rows`` is read twice, once
    for ``on`` alone.  Rows with a null key find nothing.  ``how`` is ``left`` or ``inner``.  Few rows are looked up plainly.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    if any(rows.select(c).dtypes[0][1] != table.select(c).dtypes[0][1] for c in on):
        raise ValueError("keys of different types have different digests")
    if not may_crowd(rows.select(*on)):
        return look_up(rows, table, on, how)
    named = {c.lower() for c in on}
    values = [c for c in table.columns if c.lower() not in named]
    key = F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in on]), F.xxhash64(*on))
    hot = hot_keys(rows.select(*on), key)
    found = F.struct(F.lit(True).alias("there"), *values)
    known = table.select(*on, found.alias("_hit"))
    hot_known = known.join(F.broadcast(hot), F.xxhash64(*on) == F.col("item"), "left_semi").withColumnRenamed("_hit", "_hot_hit")
    tagged = (
        rows.withColumn("_hot_key", key)
        .join(F.broadcast(hot.select(F.col("item").alias("_hot_key"), F.lit(True).alias("_is_hot"))), "_hot_key", "left")
        .join(F.broadcast(hot_known), list(on), "left")
        .withColumn("_dealt", F.when(F.col("_hot_key").isNull() | F.col("_is_hot"), spread(rows).bitwiseOR(F.lit(1).cast("bigint"))).otherwise(F.lit(0).cast("bigint")))
    )
    # Always 0, but no constant, which the planner would take out of the keys of the shuffle.
    cold = known.withColumn("_dealt", F.pmod(F.xxhash64(*on), F.lit(1)))
    joined = tagged.join(cold, [*on, "_dealt"], "left").withColumn("_hit", F.coalesce("_hot_hit", "_hit"))
    if how == "inner":
        joined = joined.where("_hit.there")
    return joined.select(*[f"`{c}`" for c in rows.columns], *[F.col(f"_hit.`{c}`").alias(c) for c in values])
