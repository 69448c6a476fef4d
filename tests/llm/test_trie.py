"""The trie of conversation prefixes against a plain one."""

import hashlib
import random
from collections import defaultdict

import pytest

from footfall.llm import trie
from footfall.sources.staging import Staging

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def by_hand(conversations):
    """``conversations``: id to its list of (role, text)."""
    members, children = defaultdict(list), defaultdict(set)
    for c, said in conversations.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    for node in members:
        if node:
            children[node[:-1]].add(node)
    leaves, saved, rows = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        saved[node] = sum(saved[k] for k in children[node]) + (len(node) > 0 and (len(members[node]) - 1) * len(node[-1][1].encode()))
        ends = sorted(c for c in members[node] if len(conversations[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves[node], saved[node], digest))
    return sorted(rows, key=str)


def found(spark, conversations):
    rows = [(c, k, role, text) for c, said in conversations.items() for k, (role, text) in enumerate(said)]
    said = trie.turns(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id bigint")
    result = trie.prefix_trie(said, ids, Staging(spark))
    assert tuple(result.columns) == COLUMNS and {t for _, t in result.dtypes} == {"bigint", "string"}
    return sorted((tuple(r) for r in result.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_a_plain_one(spark, seed):
    """Few different turns, so that edges are cut in every batch; a third of the conversations is one."""
    rng = random.Random(seed)
    turns = [("user", "a"), ("user", "é"), ("assistant", "a"), ("", "long " * 9)][: 2 + seed]
    shared = [rng.choice(turns) for _ in range(5)]
    conversations = {}
    for c in rng.sample(range(-50, 10_000), 260):
        conversations[c] = shared if rng.random() < 0.33 else [rng.choice(turns) for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9, 14]))]
    assert found(spark, conversations) == by_hand(conversations)


def test_chains_and_long_conversations(spark):
    """Each conversation goes on where another ends: one path, cut at every depth."""
    line = [("user", f"{k % 3}") for k in range(40)]
    conversations = {c: line[:c] for c in range(41)} | {100: line * 8, 101: line * 8 + [("user", "z")], 102: line[:20] + [("user", "z")]}
    assert found(spark, conversations) == by_hand(conversations)


def test_turnless_and_single_conversations(spark):
    for conversations in ({3: [], 1: []}, {5: [("user", "")]}, {5: [("", "x")], 2: [], 9: [("", "x")]}):
        assert found(spark, conversations) == by_hand(conversations)


def test_order_nulls_and_clashing_names(spark):
    rows = [(1, 2, "b", "two"), (1, None, None, None), (1, 1, "a", "one"), (1, 1, "a", "one"), (None, 1, "a", "one"), (2, 0, "", ""), (2, 5, "a", "one")]
    said = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").selectExpr("*", "'taken' as key", "0 as pos", "'x' as size", "1 as depth")
    turns = trie.turns(said)
    assert [tuple(r) for r in turns.orderBy("conv_id", "pos").select("conv_id", "pos", "size").collect()] == [(1, 1, 0), (1, 2, 3), (1, 3, 3), (1, 4, 3), (2, 1, 0), (2, 2, 3)]
    got = trie.prefix_trie(turns, turns.select("conv_id").distinct(), Staging(spark)).collect()
    expected = by_hand({1: [("", ""), ("a", "one"), ("a", "one"), ("b", "two")], 2: [("", ""), ("a", "one")]})
    assert sorted((tuple(r) for r in got), key=str) == expected


def test_empty(spark):
    said = trie.turns(spark.createDataFrame([], "conv_id bigint, turn int, role string, text string"))
    assert trie.prefix_trie(said, said.select("conv_id").distinct(), Staging(spark)).collect() == []


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", trie.two_fattest(F.col("a"), F.col("b")).alias("f")).collect()
    for r in rows:
        assert r["f"] == max(range(r["a"] + 1, r["b"] + 1), key=lambda n: n & -n)
