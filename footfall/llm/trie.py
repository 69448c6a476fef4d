"""Trie of conversation prefixes, as a z-fast trie.

Conversations are sequences of turns; a sequence is named by a chained digest, so two prefixes have one name only if all
their turns are equal.  A compacted node stands for the edge from its parent down to its own depth, its extent, and
is filed under its handle: the prefix whose length is the two-fattest number on the edge.  A fat
binary search finds the node at which a new conversation leaves the trie, in as many lookups as its length has
binary digits.  Conversations come in batches: all of a batch are located at once, edges they leave halfway are
cut there, and what is new of them is added as compacted nodes.  Each batch is several times as large as all
before it, so their number is fixed and almost everything is located rather than built anew.

At the end sums over subtrees run up the compacted nodes by doubling pointers, and edges are expanded to one row per node.

A conversation is one row that holds 32 bytes a turn, however long its texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.operators.lookup import look_up, look_up_hot

#: Conversations are dealt into so many parts; a batch takes the parts below its bound that earlier ones have not taken.
PARTS = 64
BATCHES = (1, 9, PARTS)
#: Lookups of the fat binary search between two writes to the shared folder.
ROUNDS = 4
ROOT = b""
_STEP = "struct<h: binary, size: bigint, total: bigint>"

Stage = Callable[[DataFrame, str], DataFrame]


def turns(said: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id``, ``pos`` (from 1, by turn, null first), ``key`` (digest of role and text) and ``size`` (UTF-8 bytes of the text).

    A null role or text counts as empty; rows without ``conv_id`` belong to no conversation and are left out.  Rows of one
    turn are ordered by role, then by digest.  Texts end here: what follows is narrow.
    """
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    key = F.unhex(F.md5(F.concat(F.md5(role_), F.md5(text_))))
    rows = said.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("_turn"), role_.alias("_role"), key.alias("key"), F.octet_length(text_).cast("bigint").alias("size")
    )
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("_turn"), "_role", "key")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "key", "size")


def _chained(steps: Column) -> Column:
    """Of sorted (pos, key, size): the digest of each prefix, the size of its last turn, and all sizes so far."""

    @F.arrow_udf(f"array<{_STEP}>")
    def chain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = batch.flatten()
            keys, sizes = values.field("key").to_pylist(), values.field("size").to_pylist()
            digests, totals, offsets = [], [], [0]
            for start, count in zip((at := batch.offsets.to_pylist())[:-1], (b - a for a, b in zip(at, at[1:], strict=False)), strict=True):
                last, total = ROOT, 0
                for k in range(start - at[0], start - at[0] + count):
                    last = hashlib.md5(last + keys[k]).digest()
                    total += sizes[k]
                    digests.append(last)
                    totals.append(total)
                offsets.append(len(digests))
            flat = pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())], ["h", "size", "total"])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)

    return chain(steps)


def paths(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``sid`` (name of the whole sequence) and ``path`` of every row of ``conversations``, turnless ones included."""
    marks = conversations.select("conv_id", F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("key"), F.lit(None).cast("bigint").alias("size"))
    step = F.struct("pos", "key", "size")
    listed = rows.select("conv_id", "pos", "key", "size").unionByName(marks).groupBy("conv_id").agg(F.collect_list(F.when(F.col("pos").isNotNull(), step)).alias("_steps"))
    path = _chained(F.sort_array("_steps"))
    return listed.select("conv_id", path.alias("path")).select("conv_id", _name(F.col("path"), F.size("path")).alias("sid"), "path")


def _name(path: Column, depth: Column) -> Column:
    """The name of the prefix of so many turns."""
    return F.when(depth == 0, F.lit(ROOT)).otherwise(F.get(path, depth - 1)["h"])


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that ends with most zero bits."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("bigint"), bits))


def _node(edge: Column, top: Column, parent: Column) -> list[Column]:
    """The columns of a compacted node with the prefixes of depths ``top`` + 1, ... on its edge."""
    depth = top + F.size(edge)
    return [
        F.element_at(edge, -1)["h"].alias("id"), parent.alias("parent"), top.alias("top"), depth.alias("depth"), F.get(edge, F.lit(0))["h"].alias("opens"),
        F.get(edge, (two_fattest(top, depth) - top - 1).cast("int"))["h"].alias("handle"), edge.alias("edge"),
    ]


def locate(strings: DataFrame, nodes: DataFrame, longest: int, stage: Stage, name: str) -> DataFrame:
    """``strings`` (``sid``, ``path``) with ``matched``, the turns that the trie has, and ``exit``, the node on whose edge they end (null: at a node)."""
    length = F.size("path").cast("bigint")
    filed = nodes.select(F.col("handle").alias("_ask"), F.col("id").alias("_id"), F.col("depth").alias("_depth"))
    state = strings.withColumns({"low": F.lit(0).cast("bigint"), "high": length, "exit": F.lit(None).cast("binary")})
    rounds = max(longest, 1).bit_length() + 1
    for k in range(1, rounds + 1):
        searching = F.col("exit").isNull() & (F.col("low") < F.col("high"))
        asked = state.withColumn("_at", F.when(searching, two_fattest(F.col("low"), F.col("high")))).withColumn("_ask", F.get("path", (F.col("_at") - 1).cast("int"))["h"])
        found = look_up(asked, filed, ["_ask"])
        hit = F.col("_id").isNotNull()
        whole = F.coalesce(F.get("path", (F.col("_depth") - 1).cast("int"))["h"] == F.col("_id"), F.lit(False))
        state = found.withColumns(
            {
                "low": F.when(hit & whole, F.col("_depth")).otherwise(F.col("low")),
                "exit": F.when(hit & ~whole, F.col("_id")).otherwise(F.col("exit")),
                "high": F.when(F.col("_at").isNotNull() & ~hit, F.col("_at") - 1).otherwise(F.col("high")),
            }
        ).select(*strings.columns, "low", "high", "exit")
        if k % ROUNDS == 0 or k == rounds:
            state = stage(state, f"{name}-{k}")
    # An edge may be left before its handle: then its first turn names it.
    opened = nodes.select(F.col("opens").alias("_ask"), F.col("id").alias("_id"))
    asked = state.withColumn("_ask", F.when(F.col("exit").isNull(), F.get("path", F.col("low").cast("int"))["h"]))
    state = look_up(asked, opened, ["_ask"]).withColumn("exit", F.coalesce("exit", "_id")).select(*strings.columns, "low", "exit")
    state = look_up(state, nodes.select(F.col("id").alias("exit"), "top", "edge"), ["exit"])
    ahead = F.slice("path", (F.col("top") + 1).cast("int"), F.size("edge"))
    equal = F.size(F.filter(F.zip_with(ahead, "edge", lambda a, b: a["h"] == b["h"]), lambda e: F.coalesce(e, F.lit(False)))).cast("bigint")
    matched = F.when(F.col("exit").isNull(), F.col("low")).otherwise(F.col("top") + equal)
    return stage(state.select(*strings.columns, matched.alias("matched"), "exit"), f"{name}-found")


def cut_edges(nodes: DataFrame, located: DataFrame) -> DataFrame:
    """``nodes`` with every edge cut at the depths where located conversations leave it."""
    places = located.filter("exit is not null").groupBy(F.col("exit").alias("id")).agg(F.sort_array(F.collect_set("matched")).alias("_cuts"))
    both = nodes.join(places, "id", "left")
    inside = F.filter(F.coalesce("_cuts", F.array().cast("array<bigint>")), lambda d: (d > F.col("top")) & (d < F.col("depth")))
    bounds = both.withColumn("_bounds", F.concat(F.array("top"), inside, F.array("depth")))
    part = F.posexplode(F.expr("transform(sequence(1, size(_bounds) - 1), k -> struct(_bounds[k - 1] as low, _bounds[k] as high))"))
    parts = bounds.select("*", part.alias("_nth", "_part")).select(
        F.when(F.col("_nth") == 0, F.col("parent")).otherwise(F.get("edge", (F.col("_part.low") - F.col("top") - 1).cast("int"))["h"]).alias("parent"),
        F.col("_part.low").alias("top"),
        F.slice("edge", (F.col("_part.low") - F.col("top") + 1).cast("int"), (F.col("_part.high") - F.col("_part.low")).cast("int")).alias("edge"),
    )
    return parts.select(*_node(F.col("edge"), F.col("top"), F.col("parent")))


def new_nodes(located: DataFrame, stage: Stage, name: str) -> DataFrame:
    """Compacted nodes of what the trie lacks of the located conversations.

    Every new prefix is owned by the first conversation (by name) that has it; what a conversation owns is one piece of
    its path, so pieces come together by owner.  A piece ends an edge where a conversation ends or another
    piece starts.
    """
    named = F.transform(
        "path", lambda s, k: F.struct((k + 1).cast("bigint").alias("d"), s.alias("step"), F.when(k == 0, F.lit(ROOT)).otherwise(F.get("path", k - 1)["h"]).alias("parent"), (k + 1 == F.size("path")).alias("ends"))
    )
    lacking = F.slice(named, (F.col("matched") + 1).cast("int"), F.size("path"))
    rest = located.filter(F.col("matched") < F.size("path")).select("sid", F.explode(lacking).alias("_new")).select("sid", "_new.*", "_new.step.h")
    # All rows of one name have the same depth, step and parent.
    owned = stage(
        rest.groupBy("h").agg(F.min("sid").alias("owner"), F.max("ends").alias("ends"), F.max("d").alias("d"), F.max("parent").alias("parent"), F.max(F.struct("step.size", "step.total")).alias("sizes")),
        f"{name}-owned",
    )
    starts = owned.groupBy("owner").agg(F.min(F.struct("d", "parent")).alias("_first")).select(F.col("_first.parent").alias("h"), F.lit(True).alias("_forks")).distinct()
    marked = owned.join(starts, "h", "left").withColumn("_closes", F.col("ends") | F.col("_forks").isNotNull())
    order = W.partitionBy("owner").orderBy("d").rowsBetween(W.unboundedPreceding, -1)
    pieces = marked.withColumn("_piece", F.coalesce(F.count_if("_closes").over(order), F.lit(0)))
    step = F.struct("d", F.col("h"), F.col("sizes.size").alias("size"), F.col("sizes.total").alias("total"))
    edges = pieces.groupBy("owner", "_piece").agg(F.sort_array(F.collect_list(step)).alias("_steps"), F.min(F.struct("d", "parent")).alias("_first"))
    edge = F.transform("_steps", lambda s: F.struct(s["h"].alias("h"), s["size"].alias("size"), s["total"].alias("total")))
    shaped = edges.select((F.col("_first.d") - 1).alias("top"), F.col("_first.parent").alias("parent"), edge.alias("edge"))
    return shaped.select(*_node(F.col("edge"), F.col("top"), F.col("parent")))


def build(strings: DataFrame, stage: Stage) -> DataFrame:
    """The compacted nodes, but for the root, of the trie of distinct ``strings`` (``sid``, ``path``)."""
    strings = stage(strings.select("sid", "path").withColumn("_part", F.pmod(F.xxhash64("sid"), F.lit(PARTS))), "strings")
    longest = strings.agg(F.max(F.size("path")).alias("n")).first()["n"] or 0
    nodes, low = None, 0
    for k, high in enumerate(BATCHES):
        batch = strings.filter(F.col("_part").between(low, high - 1)).drop("_part")
        if nodes is None:
            located = batch.withColumns({"matched": F.lit(0).cast("bigint"), "exit": F.lit(None).cast("binary")})
            nodes = stage(new_nodes(located, stage, f"batch-{k}"), f"nodes-{k}")
        else:
            located = locate(batch, nodes, longest, stage, f"batch-{k}")
            nodes = stage(cut_edges(nodes, located).unionByName(new_nodes(located, stage, f"batch-{k}")), f"nodes-{k}")
        low = high
    return nodes


_SUMS = ("n", "leaves", "paid", "held")


def _subtree_sums(own: DataFrame, stage: Stage) -> DataFrame:
    """``own`` (``id``, ``parent``, sums and ``first``) with the sums, and the least ``first``, of each whole subtree.

    After k rounds a node has the sums of what lies less than 2**k levels below, and a pointer 2**k levels up.
    """
    sums = own.select("id", *_SUMS, "first")
    up = own.filter("parent is not null").select("id", F.col("parent").alias("to"))
    step = 0
    while not up.isEmpty():
        more = up.join(sums, "id").groupBy(F.col("to").alias("id")).agg(*[F.sum(c).alias(f"_{c}") for c in _SUMS], F.min("first").alias("_first"))
        joined = sums.join(more, "id", "left")
        added = [(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in _SUMS]
        sums = stage(joined.select("id", *added, F.least("first", "_first").alias("first")), f"sums-{step}")
        further = up.select(F.col("id").alias("to"), F.col("to").alias("_next"))
        up = stage(look_up_hot(up, further, ["to"], "inner").select("id", F.col("_next").alias("to")), f"up-{step}")
        step += 1
    return sums


def _digests_of_ends(members: DataFrame) -> DataFrame:
    """``id``, ``ends_sha256``: the digest of the ascending ids of the conversations that are this very sequence.

    Such a digest is one chain by its nature.  Ids are sorted by range over all tasks and joined to texts there;
    the chain of a sequence that a large share of the conversations have reads some long texts, one at a time.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch.column("sid").to_pylist(), batch.column("conv_id").to_pylist()
            found: tuple[list, list, list] = ([], [], [])
            start = 0
            for k in range(1, len(names) + 1):
                if k == len(names) or names[k] != names[start]:
                    for values, value in zip(found, (names[start], ids[start], ",".join(map(str, ids[start:k]))), strict=True):
                        values.append(value)
                    start = k
            yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.string())], ["id", "first", "text"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, chain = None, hashlib.sha256()
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if name != last:
                    if last is not None:
                        done[0].append(last)
                        done[1].append(chain.hexdigest())
                    last, chain = name, hashlib.sha256()
                else:
                    chain.update(b",")
                chain.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["id", "ends_sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([chain.hexdigest()])], ["id", "ends_sha256"])

    ranged = members.select("sid", "conv_id").repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id")
    texts = ranged.mapInArrow(joined, "id binary, first bigint, text string")
    return texts.repartition("id").sortWithinPartitions("id", "first").mapInArrow(chained, "id binary, ends_sha256 string")


def prefix_trie(rows: DataFrame, conversations: DataFrame, stage: Stage) -> DataFrame:
    """One row per distinct sequence of first turns, from ``rows`` (``conv_id`` bigint, ``pos``, ``key``, ``size``: see :func:`turns`).

    ``conv_id``: the least member; ``depth``; ``parent_conv_id``: that of the parent, null for the root; ``n_convs``: members;
    ``n_children``; ``n_leaves``: childless nodes in the subtree; ``saved_tokens``: over the subtree, members but one times the
    bytes of the node's last text; ``ends_sha256``: digest of the ids of members that end here, ascending, with commas.
    ``conversations`` (``conv_id``, distinct, not null) names the members, so that those without a turn count.  Without any there are no rows.
    """
    members = stage(paths(rows, conversations), "members")
    strings = stage(members.groupBy("sid").agg(F.any_value("path").alias("path"), F.count("*").alias("n"), F.min("conv_id").alias("first")), "sequences")
    nodes = stage(build(strings.filter(F.size("path") > 0), stage), "nodes")
    root = strings.limit(1).select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("top"), F.lit(0).cast("bigint").alias("depth"), F.array().cast(f"array<{_STEP}>").alias("edge")
    )
    all_nodes = nodes.select("id", "parent", "top", "depth", "edge").unionByName(root)
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    ends = strings.select(F.col("sid").alias("id"), "n", "first", F.coalesce(F.try_element_at("path", F.lit(-1))["total"], F.lit(0)).alias("_total"))
    nothing = F.lit(0).cast("bigint")
    whole = stage(
        all_nodes.join(ends, "id", "left").join(children, "id", "left").select(
            "id", "parent", "top", "depth", "edge", F.coalesce("n", nothing).alias("n"), "first",
            F.coalesce(F.col("n") * F.col("_total"), nothing).alias("paid"),
            F.aggregate("edge", nothing, lambda a, s: a + s["size"]).alias("held"),
            F.coalesce("n_children", nothing).alias("n_children"), F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        ),
        "whole",
    )
    sums = stage(_subtree_sums(whole.select("id", "parent", *_SUMS, "first"), stage), "sums")
    above = sums.select(F.col("id").alias("parent"), F.col("first").alias("_parent_first"))
    opening = F.get("edge", F.lit(0))
    shaped = whole.select("id", "parent", "top", "depth", "edge", "n_children", F.coalesce(opening["total"] - opening["size"], nothing).alias("_top_total"))
    placed = look_up_hot(shaped, above, ["parent"]).join(sums, "id").join(_digests_of_ends(members), "id", "left")
    empty = hashlib.sha256().hexdigest()
    # The root has no edge; it is expanded as a single step without bytes.
    step = F.when(F.size("edge") == 0, F.array(F.struct(F.lit(ROOT).alias("h"), nothing.alias("size"), nothing.alias("total")))).otherwise(F.col("edge"))
    spread = placed.select("top", "depth", "n_children", "_top_total", "_parent_first", *_SUMS, "first", "ends_sha256", F.posexplode(step).alias("_k", "_step"))
    at = F.when(F.col("depth") == 0, nothing).otherwise(F.col("top") + F.col("_k") + 1)
    last = at == F.col("depth")
    before = F.col("_step.total") - F.col("_step.size")  # bytes of the turns above this one
    skipped = before - F.col("_top_total")  # of them, on this edge
    return spread.select(
        F.col("first").alias("conv_id"), at.alias("depth"), F.when(F.col("_k") == 0, F.col("_parent_first")).otherwise(F.col("first")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("n_children")).otherwise(1).cast("bigint").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("paid") - F.col("n") * before - (F.col("held") - skipped)).alias("saved_tokens"),
        F.when(last, F.coalesce("ends_sha256", F.lit(empty))).otherwise(F.lit(empty)).alias("ends_sha256"),
    )
