"""SimHash near-duplicates: every pair of fingerprints within the radius, compared exactly in tiles.

Distinct fingerprints are put into cells by the population counts of their four 16-bit words.  The counts
of two fingerprints differ in total by no more than their distance, so a pair of cells whose counts differ
by more than the radius is skipped; all other pairs of tiles are compared whole, by exclusive-or and bit
counts.  A cell that grows beyond a tile is dealt over several tiles by hash, so copies and hot
cells never meet in one task.  A pair of tiles hands on a spanning forest of its links, never the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.components import components, lowest_reachable
from footfall.llm.tables import look_up_hot, put_back, set_aside
from footfall.sources.staging import Staging

SHINGLE_WORDS = 4
RADIUS = 4
#: Fingerprints in a tile.
TILE = 4096
#: Shingles whose bits are counted at a time.
SLAB = 1 << 15
#: Pairs of tiles with no more comparisons than this are worked off together.
SMALL = 1 << 11
WORDS = 4


def shingles_of(text: str | None, width: int) -> list[bytes]:
    """Every run of ``width`` lowercase words; of a shorter text all its words, of one without words nothing."""
    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and exactly \x20 \x09-\x0D
    if not words:
        return []
    line = b" ".join(words)
    if len(words) < width:
        return [line]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - width].tolist()]
    return [line[s:e] for s, e in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]


def fingerprint_of(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number: bit set if it is set in over half of the shingle hashes."""
    spans = shingles_of(text, width)
    if not spans:
        return 0
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(spans), SLAB):
        hashes = np.array([digest(s, 42) for s in spans[at : at + SLAB]], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(spans), bitorder="little").view("<i8")[0])


def fingerprint(text: Column) -> Column:
    @F.pandas_udf("bigint")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")

    return fingerprints(text)


def _word(fp: Column, i: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("bigint")))


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Differences of counts to a cell at or after one's own, so that each pair of cells comes once."""
    steps = product(range(-radius, radius + 1), repeat=WORDS)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * WORDS]


def _within(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and ``b`` of all pairs within the radius, compared a slab of about a million at a time."""
    step, left, right = max(1, (1 << 20) // len(b)), [], []
    for at in range(0, len(a), step):
        near = np.bitwise_count((a[at : at + step, None] ^ b[None, :]).view(np.uint64)) <= radius
        if near.any():
            i, j = np.nonzero(near)
            left.append(i + at)
            right.append(j)
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between the keys ``a`` and ``b``, thinned to one for each key that is not the first of its group."""
    keys, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = lowest_reachable(at[: len(a)], at[len(a) :], len(keys))
    moved = np.flatnonzero(low != np.arange(len(keys)))
    return keys[moved], keys[low[moved]]


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        a_at, b_at = (batch.column(c).offsets.to_numpy().astype(np.int64) for c in ("fps", "other"))
        a_all, b_all = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("fps", "other"))
        same = batch.column("same").to_numpy(zero_copy_only=False)
        a_size, b_size = np.diff(a_at), np.diff(b_at)
        pairs = a_size * b_size
        for k in np.flatnonzero(pairs > SMALL):
            a, b = a_all[a_at[k] : a_at[k + 1]], b_all[b_at[k] : b_at[k + 1]]
            i, j = _within(a, b, radius)
            a, b = _forest(a[i], b[j])
            found_a.append(a)
            found_b.append(b)
        # Small pairs of tiles, about a million comparisons at a time.
        small = np.flatnonzero(pairs <= SMALL)
        runs = np.flatnonzero(np.diff(np.cumsum(pairs[small]) >> 20)) + 1
        for group in np.split(small, runs):
            n = pairs[group]
            pair = np.repeat(group, n)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            i, j = nth // b_size[pair], nth % b_size[pair]
            once = ~same[pair] | (i < j)
            a, b = a_all[a_at[pair] + i], b_all[b_at[pair] + j]
            near = once & (np.bitwise_count((a ^ b).view(np.uint64)) <= radius)
            found_a.append(a[near])
            found_b.append(b[near])
        a, b = _forest(np.concatenate(found_a), np.concatenate(found_b))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links ``a``, ``b`` that connect all of ``prints`` (``fp`` bigint, distinct) within the radius."""
    cell = [_word(F.col("fp"), i).alias(f"w{i}") for i in range(WORDS)]
    names = [f"w{i}" for i in range(WORDS)]
    placed = prints.select("fp", *cell)
    # At most 17 ** 4 rows of some bytes, whatever the input.
    sizes = placed.groupBy(*names).agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    tiles = (
        placed.join(F.broadcast(sizes), names)
        .withColumn("tile", F.pmod(F.xxhash64("fp"), "tiles").cast("int"))
        .groupBy(*names, "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    near = F.array(*[F.struct(*[F.lit(d).alias(n) for d, n in zip(s, names, strict=True)]) for s in _neighbours(radius)])
    there = [(F.col(n) + F.col(f"step.{n}")).alias(f"to_{n}") for n in names]
    asked = (
        tiles.withColumn("step", F.explode(near))
        .select("*", *there)
        .join(F.broadcast(sizes.select(*[F.col(n).alias(f"to_{n}") for n in names], F.col("tiles").alias("to_tiles"))), [f"to_{n}" for n in names])
        .withColumn("same_cell", F.expr(" and ".join(f"step.{n} = 0" for n in names)))
        .withColumn("first", F.when(F.col("same_cell"), F.col("tile")).otherwise(0))
        .withColumn("to_tile", F.explode(F.sequence("first", F.col("to_tiles") - 1)))
        .withColumn("same", F.col("same_cell") & (F.col("tile") == F.col("to_tile")))
        .select(*[f"to_{n}" for n in names], "to_tile", "fps", "same")
    )
    others = tiles.select(*[F.col(n).alias(f"to_{n}") for n in names], F.col("tile").alias("to_tile"), F.col("fps").alias("other"))
    pairs = asked.join(others, [f"to_{n}" for n in names] + ["to_tile"]).select("fps", "other", "same")
    return pairs.mapInArrow(lambda batches: _links(batches, radius), "a bigint, b bigint")


def classes(prints: DataFrame, stage: Staging, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One row per distinct fingerprint of ``prints`` (``doc_id``, ``fp``): ``fp``, ``root``, ``component_id``, ``copies``."""
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "distinct")
    roots = components(stage(near_links(distinct, radius, tile), "links"), stage).withColumnRenamed("key", "fp")
    rooted = stage(
        distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")).select("fp", "root", "first_id", "copies"),
        "rooted",
    )
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return stage(rooted.join(lowest, "root").select("fp", "root", "component_id", "copies"), "classes")


def near_duplicates(
    docs: DataFrame, stage: Staging, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed), ``root`` (the same for all that reach each other), ``component_id``.

    ``component_id`` is the smallest id reachable, null if no such document has an id.  A null text counts
    as empty; texts without a word have fingerprint zero and are linked like any other.  Repeated rows
    and ids stay as they are.  Other columns are not carried along.
    """
    prints = stage(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "prints")
    return look_up_hot(prints, classes(prints, stage, radius, tile), "fp", "copies")


def lowest_of_each(docs: DataFrame, rooted: DataFrame, stage: Staging, doc_id: str, digest: Column) -> DataFrame:
    """Of each ``root`` of ``rooted`` (``root``, ``doc_id``, ``_digest``) the row of ``docs`` with the smallest id, then digest."""
    best = rooted.groupBy("root").agg(F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "_digest")).alias("best"))
    kept = stage(best.select(F.col("best.doc_id").alias("_kept_id"), F.col("best._digest").alias("_kept_digest")), "kept")
    keyed = docs.withColumn("_digest", digest)
    same = F.col(doc_id).eqNullSafe(F.col("_kept_id")) & (F.col("_digest") == F.col("_kept_digest"))
    return keyed.join(kept, same, "left_semi").dropDuplicates([doc_id, "_digest"])


def one_of_each(docs: DataFrame, stage: Staging, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the document with the smallest id stays.

    Rows without an id come after all others.  Rows with the same id are told apart by their text; of rows
    equal in both, any one stays.  All columns are carried along.
    """
    docs, names = set_aside(docs)
    doc_id, text = names[doc_id], names[text]
    digest = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    prints = stage(docs.select(F.col(doc_id).alias("doc_id"), digest.alias("_digest"), fingerprint(F.col(text)).alias("fp")), "prints")
    rooted = look_up_hot(prints, classes(prints, stage), "fp", "copies")
    return lowest_of_each(docs, rooted, stage, doc_id, digest).select(*put_back(names))


def hexadecimal(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
