"""Exact visitor sets that take the room they need.

The sets of ``visitors`` hold one bitmap of 4 KB per bucket of 32,768 ids, however few of them are there.  Here a bucket
with up to ``SPARSE_IDS`` ids is a sorted list of the steps from one id to the next, two bytes each before compression, and
only a fuller one is a bitmap.  A set is a struct ``steps`` / ``bits`` of which one is null, beside its ``bucket``; unions may
mix both kinds, and a union that outgrows the bound turns into a bitmap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many ids a bucket is a list, which is then at most an eighth of a bitmap.
SPARSE_IDS = 256
SET_TYPE = "struct<steps: array<smallint>, bits: binary>"


def _steps(positions: Column) -> Column:
    """Sorted positions as the first one and the differences to the next; 32,767 is the largest of either."""
    return F.transform(positions, lambda p, k: (p - F.when(k == 0, 0).otherwise(F.get(positions, k - 1))).cast("smallint"))


def _positions(steps: Column) -> Column:
    """The positions that ``_steps`` came from."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))

    def further(seen: Column, step: Column) -> Column:
        at = seen["at"] + step
        return F.struct(at.alias("at"), F.array_append(seen["all"], at).alias("all"))

    return F.aggregate(steps, start, further, lambda seen: seen["all"])


def _set(n: Column, positions: Column, bits: Column, out: str) -> Column:
    sparse = n <= SPARSE_IDS
    return F.struct(F.when(sparse, _steps(F.sort_array(positions))).alias("steps"), F.when(~sparse, bits).alias("bits")).alias(out)


def base_sets(
    events: DataFrame, dims: Sequence[str], visitor: str = "guid", measures: Sequence[str] = (), out: str = "uv_set"
) -> DataFrame:
    """``dims``, ``bucket``, the set of visitors and summed measures, like :func:`visitors.base_cuboid`.

    Events are reduced to one row per (dims, visitor) before they meet, so a group is at most 32,768 rows.  Null ids keep
    their measures and count as no visitor.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    bucket = F.bitmap_bucket_number(visitor).alias("bucket")
    per_visitor = events.groupBy(*dims, bucket, F.col(visitor).alias("_visitor")).agg(*(sums or [F.count("*").alias("_events")]))
    position = F.bitmap_bit_position("_visitor")
    grouped = per_visitor.repartition(*dims, "bucket").groupBy(*dims, "bucket")
    built = grouped.agg(
        F.count("_visitor").alias("_n"), F.collect_list(position.cast("int")).alias("_positions"), F.bitmap_construct_agg(position).alias("_bits"), *sums
    )
    return built.select(*dims, "bucket", _set(F.col("_n"), F.col("_positions"), F.col("_bits"), out), *measures)


def union_sets(sets: DataFrame, keys: Sequence[str] = (), measures: Sequence[str] = (), of: str = "uv_set") -> DataFrame:
    """``keys``, ``bucket``, the union of the sets and the summed measures; ``keys`` are some of the columns of ``sets``.

    Lists give one row per distinct id and bitmaps are united before anything is shuffled, so a group receives at most 32,768
    ids, and one bitmap and one sum from each task.
    """
    by = [*keys, "bucket"]
    nothing = {"_position": F.lit(None).cast("int"), "_united": F.lit(None).cast("binary")}
    lists = sets.where(F.col(of)["steps"].isNotNull()).select(*by, F.explode(_positions(F.col(of)["steps"])).alias("_position")).distinct()
    maps = sets.where(F.col(of)["bits"].isNotNull()).groupBy(*by).agg(F.bitmap_or_agg(F.col(of)["bits"]).alias("_united"))
    # One row for every group, also for those of empty sets.
    sums = sets.groupBy(*by).agg(*([F.sum(m).alias(m) for m in measures] or [F.lit(0).alias("_any")])).withColumns(nothing)
    both = sums.unionByName(lists, allowMissingColumns=True).unionByName(maps, allowMissingColumns=True)
    gathered = (
        both.repartition(*by)
        .groupBy(*by)
        .agg(
            F.count("_position").alias("_n"), F.collect_list("_position").alias("_positions"), F.bitmap_construct_agg(F.col("_position").cast("bigint")).alias("_own"),
            F.first("_united", ignorenulls=True).alias("_united"), *[F.sum(m).alias(m) for m in measures],
        )
    )
    # Two bitmaps are united by the aggregate too; both rows of a group are where the group is.
    halves = gathered.withColumn("_half", F.explode(F.when(F.col("_united").isNull(), F.array("_own")).otherwise(F.array("_own", "_united"))))
    whole = halves.groupBy(*by).agg(
        F.bitmap_or_agg("_half").alias("_bits"), F.first("_n").alias("_n"), F.first("_positions").alias("_positions"), F.max(F.col("_united").isNotNull()).alias("_dense"), *[F.first(m).alias(m) for m in measures]
    )
    size = F.when(F.col("_dense"), SPARSE_IDS + 1).otherwise(F.col("_n"))
    return whole.select(*by, _set(size, F.col("_positions"), F.col("_bits"), of), *measures)


def set_size(of: str = "uv_set") -> Column:
    """How many ids a set holds."""
    steps, bits = F.col(of)["steps"], F.col(of)["bits"]
    return F.when(steps.isNotNull(), F.size(steps).cast("bigint")).otherwise(F.bitmap_count(bits))


def set_counts(
    sets: DataFrame, dims: Sequence[str], measures: Sequence[str] = (), of: str = "uv_set", out: str = "uv"
) -> DataFrame:
    """Distinct visitors ``out`` and measures of each group of ``sets`` over exactly ``dims``."""
    return sets.groupBy(*dims).agg(F.sum(set_size(of)).alias(out), *[F.sum(m).alias(m) for m in measures])


def to_sets(cuboid: DataFrame, bitmap: str = "uv_bitmap", out: str = "uv_set") -> DataFrame:
    """A cuboid of bitmaps with sets in their place: full bitmaps stay as they are, the others become lists.

    The ids of a sparse bitmap are read off its bytes, so a stored cuboid need not be built anew.
    """
    sparse = F.bitmap_count(bitmap) <= SPARSE_IDS
    text, no_bytes = F.hex(bitmap), F.sequence(F.lit(0), F.lit(4095))
    byte = F.transform(no_bytes, lambda k: F.struct(k.alias("at"), F.conv(F.substring(text, k * 2 + 1, F.lit(2)), 16, 10).cast("int").alias("value")))
    set_bytes = F.filter(byte, lambda b: b["value"] != 0)

    def positions(b: Column) -> Column:
        return F.array_compact(F.array(*[F.when(b["value"].bitwiseAND(F.lit(1 << j)) != 0, b["at"] * 8 + j) for j in range(8)]))

    inside = F.flatten(F.transform(set_bytes, positions))
    kept = [c for c in cuboid.columns if c != bitmap]
    return cuboid.select(*kept, F.struct(F.when(sparse, _steps(F.sort_array(inside))).alias("steps"), F.when(~sparse, F.col(bitmap)).alias("bits")).alias(out))
