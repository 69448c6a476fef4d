"""Conversations out of reply trees, and their format with a loss mask.

Messages answer messages.  Unbranched runs of messages are found by pointer doubling, so a chain of n takes log n
self-joins; the tree of runs is then walked from the roots, one self-join a branching level, and gives every
root-to-leaf path.  Paths are ranked by score, and only the chosen ones fetch their texts.

A turn is written ``<turn ROLE>TEXT</turn>`` and a line feed; in roles and texts, backslash and the angle brackets get
a backslash before them, so no text can hold a mark, and taking the backslashes off gives it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.sources.staging import Staging

END = "</turn>\n"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"([\\<>])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def thread(turns: DataFrame) -> DataFrame:
    """Messages of plain conversations (``conv_id``, ``turn``, ``role``, ``text``): each turn answers the one before it.

    Turns of equal number are ordered by role and text, a null number comes first.
    """
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    at = F.row_number().over(order).cast("bigint")
    numbered = turns.select("conv_id", at.alias("message_id"), "role", "text")
    return numbered.withColumns({"parent_id": F.nullif(F.col("message_id") - 1, F.lit(0)), "score": F.lit(0.0)})


def runs(messages: DataFrame, stage: Staging) -> DataFrame:
    """``conv``, ``id``, ``parent``, ``head``, ``at``, ``total`` of each message: the first message of its unbranched run, its
    place behind that, and the sum of scores from there to itself.

    A message starts a run if it has no parent among the messages or its parent has several answers.  Each round
    doubles the reach of a pointer towards the head.  Messages that answer each other in a circle reach none and are left
    out, with all that answer them alone.
    """
    answers = messages.groupBy("conv", F.col("parent").alias("id")).agg(F.count("*").alias("answers"))
    known = stage(messages.join(answers, ["conv", "id"], "left").withColumn("answers", F.coalesce("answers", F.lit(0))), "messages")
    above = known.select("conv", F.col("id").alias("parent"), F.col("answers").alias("siblings"))
    first = F.coalesce(F.col("siblings") != 1, F.lit(True))
    start = known.join(above, ["conv", "parent"], "left").select(
        "conv", "id", F.when(F.col("siblings").isNotNull(), F.col("parent")).alias("parent"), "answers",
        F.when(first, F.col("id")).alias("head"), F.when(first, F.col("id")).otherwise(F.col("parent")).alias("to"),
        F.when(first, 0).otherwise(1).cast("bigint").alias("at"), "score", F.col("score").alias("total"),
    )
    # total covers the messages from this one up to, but not including, the one pointed to, unless that is the head.
    state, step, open_before = stage(start, "runs-0"), 0, None
    while True:
        left = state.filter("head is null").count()
        if left == 0 or left == open_before:
            return state.filter("head is not null").select("conv", "id", "parent", "answers", "head", "at", "total")
        ahead = state.select("conv", F.col("id").alias("to"), F.col("head").alias("_head"), F.col("to").alias("_to"), F.col("at").alias("_at"), F.col("total").alias("_total"))
        waiting = state.filter("head is null").join(ahead, ["conv", "to"])
        moved = waiting.select(
            "conv", "id", "parent", "answers", F.col("_head").alias("head"), F.col("_to").alias("to"),
            (F.col("at") + F.col("_at")).alias("at"), "score", (F.col("total") + F.col("_total")).alias("total"),
        )
        step, open_before = step + 1, left
        state = stage(state.filter("head is not null").unionByName(moved), f"runs-{step}")


def paths(found: DataFrame, stage: Staging) -> DataFrame:
    """``conv``, ``leaf``, ``score``, ``heads`` (runs from the root) of each root-to-leaf path over ``runs``; score is the sum of its messages'."""
    last = found.groupBy("conv", "head").agg(F.max_by(F.struct("id", "answers", "total"), "at").alias("last"))
    parents = found.filter("id = head").select("conv", "head", "parent")
    nodes = stage(last.join(parents, ["conv", "head"]).select("conv", "head", "parent", "last.id", "last.answers", "last.total"), "nodes")
    front = nodes.filter("parent is null").select("conv", "id", "answers", F.col("total").alias("score"), F.array("head").alias("heads"))
    front, done, level = stage(front, "front-0"), [], 0
    while True:
        done.append(front.filter("answers = 0").select("conv", F.col("id").alias("leaf"), "score", "heads"))
        open_ends = front.filter("answers > 0").select("conv", F.col("id").alias("parent"), "score", "heads")
        if open_ends.isEmpty():
            break
        level += 1
        grown = nodes.join(open_ends, ["conv", "parent"]).select(
            "conv", "id", "answers", (F.col("score") + F.col("total")).alias("score"), F.concat("heads", F.array("head")).alias("heads")
        )
        front = stage(grown, f"front-{level}")
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every


def conversations(messages: DataFrame, stage: Staging, best: int = 1) -> DataFrame:
    """The ``best`` paths of each conversation: ``conv_id``, ``path`` (1 the best), ``at`` (from 0), ``role``, ``text``.

    ``messages`` have ``conv_id``, ``message_id``, ``parent_id``, ``role``, ``text`` and ``score`` (null: 0).  Paths are ranked by score,
    then by their leaf's id.  A null conv_id is a conversation like others; messages without id are left out; of
    messages with the same id the first in order of parent, role and text stays.  An answer to a message that
    is not there starts a tree.
    """
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    told = messages.filter(F.col("message_id").isNotNull()).groupBy(conv.alias("conv"), F.col("message_id").alias("id")).agg(
        F.min(F.struct(F.col("parent_id").alias("parent"), "role", "text", F.coalesce("score", F.lit(0.0)).alias("score"), "conv_id")).alias("m")
    )
    told = stage(told.select("conv", "id", "m.*"), "told")
    found = stage(runs(told.select("conv", "id", "parent", "score"), stage), "runs")
    rank = F.row_number().over(W.partitionBy("conv").orderBy(F.desc("score"), "leaf"))
    chosen = paths(found, stage).withColumn("path", rank).filter(F.col("path") <= best)
    steps = chosen.select("conv", "path", F.posexplode("heads").alias("run", "head"))
    placed = found.select("conv", "head", "id", "at").join(steps, ["conv", "head"])
    texts = told.select("conv", "id", "conv_id", "role", "text")
    order = W.partitionBy("conv", "path").orderBy("run", "_place")
    return (
        placed.withColumnRenamed("at", "_place").join(texts, ["conv", "id"])
        .withColumn("at", F.row_number().over(order) - 1).select("conv_id", "conv", "path", "at", "role", "text")
    )


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``path``, ``formatted`` and ``mask`` of ``conversations``: spans (``start`` from 0, ``length``) of what is learned.

    A null role or text is written as empty.  The mask covers the texts of ``LEARNED_ROLE`` and nothing else.
    """
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    pieces = turns.withColumn("_open", F.concat(F.lit("<turn "), role, F.lit(">"))).withColumn("_text", text)
    size = F.length("_open") + F.length("_text") + len(END)
    before = W.partitionBy("conv", "path").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    placed = pieces.withColumn("_size", size).withColumn("_from", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    span = F.when(F.col("role") == LEARNED_ROLE, F.struct((F.col("_from") + F.length("_open")).alias("start"), F.length("_text").alias("length")))
    whole = placed.groupBy("conv", "path").agg(
        F.first("conv_id").alias("conv_id"),
        F.sort_array(F.collect_list(F.struct("at", F.concat("_open", "_text", F.lit(END)).alias("piece"), span.alias("span")))).alias("all"),
    )
    joined = F.array_join(F.transform("all", lambda x: x["piece"]), "")
    mask = F.array_compact(F.transform("all", lambda x: x["span"]))
    return whole.select("conv_id", "path", joined.alias("formatted"), mask.alias("mask"))


def read_back(text: Column) -> Column:
    """The turns (``role``, ``text``) of a formatted conversation."""
    rule = r"(?s)^<turn ((?:[^\\<>]|\\.)*+)>(.*)$"
    parts = F.filter(F.split(text, END), lambda p: p != "")
    return F.transform(
        parts, lambda p: F.struct(unescaped(F.regexp_extract(p, rule, 1)).alias("role"), unescaped(F.regexp_extract(p, rule, 2)).alias("text"))
    )


def under_mask(text: Column, mask: Column) -> Column:
    """The learned texts of a formatted conversation, unescaped, in order."""
    spans = F.transform(mask, lambda s: unescaped(F.substring(text, (s["start"] + 1).cast("int"), s["length"])))
    return F.array_join(spans, "")
