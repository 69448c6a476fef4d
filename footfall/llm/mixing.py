"""Mixing sources to target weights by Poisson replication.

A source with target weight ``w`` gets the mean repetition rate ``rows * w / rows of the source``.  Every
document draws its number of copies from the Poisson distribution of that mean, by inversion at a uniform
number hashed from the document and the seed: the draw is a pure function of the row, needs no knowledge of
other rows, and is the same on any partitioning.  Copies are then dealt out and ordered by a hash, so they
lie anywhere in the result.
"""

from __future__ import annotations

from functools import lru_cache
from math import lgamma, log, log1p, pi, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import look_up_hot, put_back, set_aside, without

#: Rates are broadcast up to so many sources (some tens of bytes each); beyond, those of hot sources are, and the others are joined by a shuffle.
BROADCAST_SOURCES = 100_000


#: Copies of one document that are made in one place; a document with more is dealt out in blocks first.
BLOCK = 10_000
#: Deviations from the mean beyond which no double below one tells counts apart.
TAIL = 12
#: The first terms of Stirling's series.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260)


@lru_cache(maxsize=4096)
def cumulated(mean: float) -> tuple[int, np.ndarray]:
    """The first count that matters, and P(count <= k) from there until no double below one is left out.

    As long as the square root of the mean, not as the mean.
    """
    first = max(int(mean - TAIL * sqrt(mean)), 0)
    k = np.arange(first, int(mean + TAIL * sqrt(mean)) + 40)
    # Sums of small steps from the peak, where the terms are largest: no two large numbers are taken from each other.
    peak = int(mean)
    steps = np.log(mean / np.maximum(k, 1))
    at = peak - first
    logs = np.cumsum(steps) - np.cumsum(steps)[at] + _log_chance(mean, peak)
    return first, np.minimum(np.cumsum(np.exp(logs)), 1.0)


def _log_chance(mean: float, k: int) -> float:
    """log P(count = k) near the mean, without the cancellation of k log(mean) - mean - log k! for large means."""
    if k < 100:
        return k * log(mean) - mean - lgamma(k + 1)
    # log k! = k log k - k + log(2 pi k) / 2 + 1/(12 k) - 1/(360 k^3) + ...
    return k * log1p((mean - k) / k) - (mean - k) - log(2 * pi * k) / 2 - sum(c / k ** (2 * i + 1) for i, c in enumerate(_STIRLING))


def poisson(mean: np.ndarray, uniform: np.ndarray) -> np.ndarray:
    """The least count whose cumulated probability exceeds the uniform number, for each row."""
    counts = np.zeros(len(mean), np.int64)
    for rate in np.unique(mean):
        here = mean == rate
        if rate > 0:
            first, table = cumulated(float(rate))
            counts[here] = first + np.searchsorted(table, uniform[here], side="right")
    return counts


def _uniform(key: Column) -> Column:
    """A hash as one of 2**53 equidistant numbers in [0, 1)."""
    return F.shiftrightunsigned(key, 11) * F.lit(2.0**-53)


def _tagged(source: Column) -> Column:
    """A key that is never null: sources without a name are one source."""
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source.cast("string")))


def tempered_weights(docs: DataFrame, power: float, source: str = "source") -> DataFrame:
    """``source``, ``weight``: shares in proportion to the sources' sizes raised to ``power``; 1 keeps them, 0 evens them out."""
    return docs.groupBy(F.col(source).alias("source")).agg((F.count("*").cast("double") ** power).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, epochs: float = 1.0, source: str = "source") -> tuple[DataFrame, int, float]:
    """``_key``, ``rate`` and ``copies`` (rows) of each source of ``docs``, the number of sources and the highest rate.

    ``weights`` (``source``, ``weight``) need not add up to one; they are taken in relation to those of the sources that
    have rows.  A source without a weight, or with a null or negative one, has rate zero; of a source named
    twice the weights are added.  Only four numbers over all sources reach the driver.
    """
    sizes = docs.groupBy(_tagged(F.col(source)).alias("_key")).agg(F.count("*").alias("copies"))
    wanted = weights.groupBy(_tagged(F.col("source")).alias("_key")).agg(F.sum(F.greatest(F.col("weight").cast("double"), F.lit(0.0))).alias("_weight"))
    both = sizes.join(wanted, "_key", "left").withColumn("_weight", F.coalesce("_weight", F.lit(0.0)))
    total = both.agg(F.count("*").alias("sources"), F.sum("copies").alias("rows"), F.sum("_weight").alias("weights"), F.max(F.col("_weight") / F.col("copies")).alias("most")).first()
    share = F.col("_weight") / total["weights"] if total["weights"] else F.lit(0.0)
    most = epochs * total["rows"] * total["most"] / total["weights"] if total["weights"] else 0.0
    return both.select("_key", (epochs * (total["rows"] or 0) * share / F.col("copies")).alias("rate"), "copies"), total["sources"], most


def mix(
    docs: DataFrame, weights: DataFrame, epochs: float = 1.0, seed: int = 0, source: str = "source", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The copies of all documents in shuffled order: all columns of ``docs``, ``copy`` (from 1) and ``shuffle_key``.

    Partitions, and the rows in each, ascend by ``shuffle_key``, whose order does not depend on the number of
    partitions: that of ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``, else of ``spark.sql.shuffle.partitions``.  A
    document may get any number of copies; blocks of them are made in different tasks.  Rows equal in id and text draw the same number; a null text or id is hashed as absent.  A
    document of a source with rate zero gets no copy.
    """
    spark = docs.sparkSession
    known, sources, most = rates(docs, weights, epochs, source)
    docs, names = set_aside(without(docs, ["copy", "shuffle_key"]))
    source, doc_id, text = names[source], names[doc_id], names[text]
    keyed = docs.withColumn("_key", _tagged(F.col(source)))
    if sources <= BROADCAST_SOURCES:
        rated = keyed.join(F.broadcast(known.drop("copies")), "_key")
    else:
        rated = look_up_hot(keyed, known, "_key", "copies")

    # Not to be evaluated once more in a filter that the planner derives from the explode.
    @F.pandas_udf("bigint")
    def drawn(mean: pd.Series, uniform: pd.Series) -> pd.Series:
        return pd.Series(poisson(mean.to_numpy(), uniform.to_numpy()))

    draw = drawn.asNondeterministic()
    row = F.xxhash64(F.col(doc_id), F.xxhash64(F.col(text)))
    counted = rated.withColumn("_row", row).withColumn("_n", draw("rate", _uniform(F.xxhash64("_row", F.lit(seed), F.lit("draw")))))
    one = F.lit(1).cast("bigint")
    parts = int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if most > BLOCK / 2:
        # Someone's copies may be too many for one place: blocks of them are dealt out before they are made.
        blocks = F.explode(F.when(F.col("_n") > 0, F.expr(f"sequence(0L, (_n - 1) div {BLOCK})")))
        counted = counted.select(*names.values(), "_row", "_n", blocks.alias("_block")).repartition(parts, "_row", "_block")
        copies = F.explode(F.sequence(F.col("_block") * BLOCK + one, F.least(F.col("_n"), (F.col("_block") + one) * BLOCK)))
    else:
        copies = F.explode(F.when(F.col("_n") > 0, F.sequence(one, F.col("_n"))))
    spread = counted.select(*names.values(), "_row", copies.alias("copy")).withColumn("shuffle_key", F.xxhash64("_row", F.lit(seed), "copy"))
    at = F.floor((F.shiftright(F.col("shuffle_key"), 11) * F.lit(2.0**-53) + 0.5) * parts).cast("int")
    dealt = spread.drop("_row").repartitionById(parts, F.least(at, F.lit(parts - 1))).sortWithinPartitions("shuffle_key", doc_id, "copy")
    return dealt.select(*put_back(names), "copy", "shuffle_key")
