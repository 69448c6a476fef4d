"""WARC archives of pages and the audit of their replicas by Merkle trees.

Records are hashed; the records of a file whose offsets lie in one range make a leaf, ranges in order make
the next level up to one root a file.  Two replicas are compared root by root, then only the children of
nodes that differ, down to the records.  A node is a group of bounded size: a leaf spans a fixed number of bytes
and no record is empty, an inner node has a fixed number of children.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.sources.staging import Staging

FILE_BYTES = 1 << 30
LEAF_BYTES = 1 << 16
FAN_OUT = 16
#: Records of a file are summed up in blocks of about this many.
BLOCK_RECORDS = 256
#: Places on the ring of digests: the first 15 hexadecimal digits.
RING = 1 << 60


def record(page_id: Column, url: Column, html: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """A resource record as bytes; a null url or page counts as empty, a null id is left out of the record's id."""
    payload = F.coalesce(html, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), "[\r\n]", ""),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), payload, F.lit("\r\n\r\n").cast("binary"))


def lay_out(records: DataFrame, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Add ``file`` and ``offset`` to records (``digest``, ``length``, others): about ``file_bytes`` a file, ordered by digest.

    Digests must be distinct.  Offsets are summed up in blocks of the digests' ring, so no file is in one task.
    """
    place = F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint")
    total = records.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    files = max(1, -(-total["bytes"] // file_bytes))
    blocks = files * max(1, -(-total["n"] // (BLOCK_RECORDS * files)))
    # blocks is a multiple of files, so no block lies in two of them
    block = F.least(F.floor(place / F.lit(float(RING)) * blocks), F.lit(blocks - 1))
    placed = records.withColumn("_block", block).withColumn("file", F.expr(f"_block div {blocks // files}"))
    sums = placed.groupBy("file", "_block").agg(F.sum("length").alias("_bytes"))
    before = W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("file", "_block", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"))
    inside = W.partitionBy("file", "_block").orderBy("digest").rowsBetween(W.unboundedPreceding, -1)
    running = placed.withColumn("_inside", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    return running.join(starts, ["file", "_block"]).withColumn("offset", F.col("_start") + F.col("_inside")).drop("_start", "_inside", "_block")


def tree(manifest: DataFrame, levels: int, stage: Staging, name: str, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> list[DataFrame]:
    """Nodes ``file``, ``range``, ``hash`` of each level, leaves first, for ``manifest`` (``file``, ``offset``, ``length``, ``digest``)."""

    def joined(parts: Column) -> Column:
        return F.sha2(F.concat_ws("\n", F.transform(F.sort_array(F.collect_list(parts)), lambda x: x["word"])), 256)

    word = F.concat_ws(" ", "offset", "length", "digest")
    leaf = F.expr(f"offset div {leaf_bytes}").alias("range")
    level = manifest.groupBy("file", leaf).agg(joined(F.struct("offset", word.alias("word"))).alias("hash"))
    found = [stage(level, f"{name}-0")]
    for k in range(1, levels):
        word = F.concat_ws(" ", "range", "hash")
        above = found[-1].groupBy("file", F.expr(f"range div {fan_out}").alias("above"))
        level = above.agg(joined(F.struct("range", word.alias("word"))).alias("hash")).withColumnRenamed("above", "range")
        found.append(stage(level, f"{name}-{k}"))
    return found


def differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """``file``, ``range`` of nodes that are not in both trees with the same hash."""
    theirs = two.withColumnRenamed("hash", "_hash")
    return one.join(theirs, ["file", "range"], "full").filter(~F.col("hash").eqNullSafe(F.col("_hash"))).select("file", "range")


def audit(one: DataFrame, two: DataFrame, stage: Staging, leaf_bytes: int = LEAF_BYTES, fan_out: int = FAN_OUT) -> DataFrame:
    """Records in which the replicas differ: ``file``, ``offset``, ``status``, and ``length``, ``digest`` of either (the second as ``replica_``).

    Manifests have ``file``, ``offset`` (from 0), ``length`` (1 or more) and ``digest``.  Status is ``changed``, ``missing``
    (in the second) or ``extra``.  Repeated rows count once; rows without file or offset are left out.  Two
    records at one offset of a replica are compared as a set.  Records are known by where they lie: if one replica is shifted
    by an insertion, all that follows in the file is found changed, missing or extra.
    """
    columns = ["file", "offset", "length", "digest"]
    one, two = (m.select(*columns).dropna(subset=["file", "offset"]).distinct() for m in (one, two))
    far = one.select("offset").union(two.select("offset")).agg(F.max("offset")).first()[0] or 0
    levels, ranges = 1, far // leaf_bytes + 1
    while ranges > 1:
        levels, ranges = levels + 1, -(-ranges // fan_out)
    trees = [tree(m, levels, stage, name, leaf_bytes, fan_out) for m, name in ((one, "one"), (two, "two"))]
    nodes = differing(trees[0][-1], trees[1][-1])
    for k in range(levels - 2, -1, -1):
        # Only the children of nodes that differ are read on.
        up = stage(nodes, f"differing-{k + 1}").withColumnRenamed("range", "_above")
        below = [
            t[k].withColumn("_above", F.expr(f"range div {fan_out}")).join(up, ["file", "_above"], "left_semi").drop("_above") for t in trees
        ]
        nodes = differing(*below)
    leaves = stage(nodes, "differing-0")
    parts = [
        m.withColumn("range", F.expr(f"offset div {leaf_bytes}")).join(leaves, ["file", "range"], "left_semi")
        .groupBy("file", "offset").agg(F.min("length").alias("length"), F.array_join(F.sort_array(F.collect_set("digest")), " ").alias("digest"))
        for m in (one, two)
    ]
    theirs = parts[1].withColumnsRenamed({"length": "replica_length", "digest": "replica_digest"})
    status = F.when(F.col("digest").isNull(), "extra").when(F.col("replica_digest").isNull(), "missing").otherwise("changed")
    both = parts[0].join(theirs, ["file", "offset"], "full")
    apart = ~(F.col("digest").eqNullSafe(F.col("replica_digest")) & F.col("length").eqNullSafe(F.col("replica_length")))
    return both.filter(apart).select("file", "offset", status.alias("status"), "length", "digest", "replica_length", "replica_digest")
