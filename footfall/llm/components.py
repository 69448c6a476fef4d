"""Connected components of links between 64-bit keys."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.sources.staging import Staging


def lowest_reachable(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 linked by ``left[i]``–``right[i]``: the lowest node that each one reaches."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        nearer = label.copy()
        np.minimum.at(nearer, left, low)
        np.minimum.at(nearer, right, low)
        # The lower label also goes to the node that carried the higher one, so chains shrink fast.
        np.minimum.at(nearer, label[left], low)
        np.minimum.at(nearer, label[right], low)
        nearer = nearer[nearer]
        if np.array_equal(nearer, label):
            return label
        label = nearer


def components(links: DataFrame, stage: Staging) -> DataFrame:
    """``key`` and ``root`` for every key of ``links`` (``a``, ``b`` bigint); keys that reach each other share the root.

    Every round joins each key to its lowest neighbour, follows those joints twice, and carries the links
    over to what they lead to; links inside one key vanish.  At least half of the linked keys go in each
    round, so rounds grow with the logarithm of the longest chain.  Each round is written to the shared
    folder.  Only the count of the links left reaches the driver.  A link to itself gives no row; a null
    end or an empty table gives none either.
    """
    step, joints = 0, []
    left = stage(links.filter("a <> b").select("a", "b").distinct(), "links-0")
    while not left.isEmpty():
        both = left.select(F.col("a").alias("key"), F.col("b").alias("to")).union(left.select("b", "a"))
        joint = stage(both.groupBy("key").agg(F.least("key", F.min("to")).alias("to")), f"joint-{step}")
        further = joint.select(F.col("key").alias("to"), F.col("to").alias("further"))
        joint = stage(joint.join(further, "to").select("key", F.col("further").alias("to")), f"joint-{step}-twice")
        joints.append(joint)
        left = stage(
            left.join(joint.select(F.col("key").alias("a"), F.col("to").alias("a2")), "a")
            .join(joint.select(F.col("key").alias("b"), F.col("to").alias("b2")), "b")
            .filter("a2 <> b2")
            .select(F.col("a2").alias("a"), F.col("b2").alias("b"))
            .distinct(),
            f"links-{step + 1}",
        )
        step += 1
    if not joints:
        return left.select(F.col("a").alias("key"), F.col("b").alias("root"))

    def follow(known: DataFrame, joint: DataFrame) -> DataFrame:
        after = joint.select(F.col("key").alias("root"), F.col("to").alias("next"))
        return known.join(after, "root", "left").select("key", F.coalesce("next", "root").alias("root"))

    return reduce(follow, joints[1:], joints[0].withColumnRenamed("to", "root"))
