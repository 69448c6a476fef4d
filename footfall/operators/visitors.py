"""Exact distinct-visitor cubes over stored bitmaps.

A visitor set is held as one fixed bitmap per bucket of 32,768 ids.  Every frame here keeps the ``bucket``
column: unions work per bucket, and a count is the sum over the buckets.  Measures are stored per
bucket too, so they stay additive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The length of Spark's bitmaps, and the 64-bit words that unions combine together.
BITMAP_BYTES, CHUNK_WORDS = 4096, 8
CHUNK_BYTES = 8 * CHUNK_WORDS
N_CHUNKS = BITMAP_BYTES // CHUNK_BYTES


def base_cuboid(
    events: DataFrame,
    dims: Sequence[str],
    visitor: str = "guid",
    measures: Sequence[str] = (),
    bitmap: str = "uv_bitmap",
) -> DataFrame:
    """Visitor bitmap and summed measures for each combination of ``dims``, by id bucket.

    Events are first reduced to one row per (dims, visitor), combined before the shuffle.  After that a
    (dims, bucket) group has at most 32,768 rows however skewed the events are, and its bitmap is
    built where the group lives: bitmaps of 4 KB are never sent once per task.
    Null ids keep their measures and count as no visitor.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    bucket = F.bitmap_bucket_number(visitor).alias("bucket")
    per_visitor = events.groupBy(*dims, bucket, F.col(visitor).alias("_visitor")).agg(
        F.count("*").alias("_events"), *sums
    )
    return (
        per_visitor.repartition(*dims, "bucket")
        .groupBy(*dims, "bucket")
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_visitor")).alias(bitmap), *sums)
    )


def _chunks(cuboid: DataFrame, bitmap: str) -> DataFrame:
    """The chunks ``_bits`` that hold ids, by number ``_chunk``, after a chunk -1 of every bitmap, null or empty ones too.

    As in Spark's aggregates a shorter bitmap ends in zeros, and what is beyond 4,096 bytes does not count.
    """
    none, number = F.lit(bytes(CHUNK_BYTES)), F.col("_chunk")
    bits = F.rpad(F.substring(bitmap, number * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES)), CHUNK_BYTES, F.lit(b"\0"))
    every = cuboid.withColumn("_chunk", F.explode(F.sequence(F.lit(-1), F.lit(N_CHUNKS - 1))))
    return every.withColumn("_bits", F.when(number < 0, none).otherwise(bits)).where((number < 0) | (F.col("_bits") != none))


def _word(k: int) -> Column:
    """The ``k``-th eight bytes of a chunk as a number."""
    word = F.substring("_bits", 8 * k + 1, 8)
    return F.when(word == F.lit(bytes(8)), 0).otherwise(F.conv(F.hex(word), 16, -10).cast("bigint"))


def _whole(chunks: Column) -> Column:
    """The bitmap of a list of chunks."""
    by_number = F.map_from_entries(chunks)
    words = F.transform(
        F.sequence(F.lit(0), F.lit(N_CHUNKS - 1)),
        lambda k: F.coalesce(by_number[k], F.array_repeat(F.lit(0).cast("bigint"), CHUNK_WORDS)),
    )
    return F.unhex(F.array_join(F.transform(F.flatten(words), lambda w: F.lpad(F.hex(w), 16, "0")), ""))


def _united(cuboid: DataFrame, by: Sequence[str], measures: Sequence[str], bitmap: str) -> DataFrame:
    """``by``, the OR of the bitmaps and the summed measures.

    Equal chunks of a group are combined in a hash table before the shuffle.  A task holds the chunks of its results,
    however many bitmaps it reads; a group has at most 64 of them when its bitmap is put together again.
    """
    names = [f"_word{k}" for k in range(CHUNK_WORDS)]
    sums = [F.sum(F.when(F.col("_chunk") == -1, F.col(m))).alias(m) for m in measures]
    combined = (
        _chunks(cuboid, bitmap)
        .withColumns({name: _word(k) for k, name in enumerate(names)})
        .groupBy(*by, "_chunk")
        .agg(*[F.bit_or(name).alias(name) for name in names], *sums)
    )
    chunk = F.when(F.col("_chunk") >= 0, F.struct("_chunk", F.array(*names)))
    gathered = combined.groupBy(*by).agg(F.collect_list(chunk).alias("_chunks"), *[F.max(m).alias(m) for m in measures])
    return gathered.select(*by, _whole(F.col("_chunks")).alias(bitmap), *measures)


def union_bitmaps(bitmaps: DataFrame, keys: Sequence[str] = (), bitmap: str = "uv_bitmap") -> DataFrame:
    """OR of the bitmaps per ``keys`` and bucket."""
    return _united(bitmaps, [*keys, "bucket"], (), bitmap)


def roll_up(
    cuboid: DataFrame, dims: Sequence[str], measures: Sequence[str] = (), bitmap: str = "uv_bitmap"
) -> DataFrame:
    """A cuboid over fewer dimensions, from a stored cuboid and without the events."""
    return _united(cuboid, [*dims, "bucket"], measures, bitmap)


def visitor_counts(
    cuboid: DataFrame,
    dims: Sequence[str],
    measures: Sequence[str] = (),
    bitmap: str = "uv_bitmap",
    out: str = "uv",
) -> DataFrame:
    """Distinct visitors ``out`` and measures of each row group of a cuboid over ``dims``."""
    sums = [F.sum(m).alias(m) for m in measures]
    return cuboid.groupBy(*dims).agg(F.sum(F.bitmap_count(bitmap)).alias(out), *sums)
