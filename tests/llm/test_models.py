"""Language, quality, BPE and mixing against brute force, the reference library or held-out rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import bpe, language, mixing, quality
from footfall.llm.tables import held_out

ODD = [None, "", " \n\t", "1234 !?", "x" * 200_000, "Straße " * 5]


def frame(spark, texts, extra=""):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string" + extra)


def longest_phrases(text, learned):
    """Greedy parse into the longest matches with ``learned``, byte by byte."""
    n, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in learned:
            end += 1
        n, at = n + 1, end
    return n


@pytest.mark.parametrize("seed", range(5))
def test_phrases_equal_a_greedy_parse(seed):
    chance = random.Random(seed)
    texts = {k: bytes(chance.choice(b"abc ") for _ in range(300)) for k in ("one", "two")}
    parser = language.Parser(texts)
    asked = [bytes(chance.choice(b"abc ") for _ in range(chance.randrange(1, 200))) for _ in range(30)]
    expected = [[longest_phrases(t, texts[k]) for k in parser.languages] for t in asked]
    assert parser.phrases(asked).tolist() == expected


def test_blocks_of_a_long_text_add_up(monkeypatch):
    parser = language.Parser({"a": b"abab ba", "b": b"bbbaaa"})
    text = b"ab" * 700
    whole = [parser.phrases([text[k : k + 64]])[0] for k in range(0, len(text), 64)]
    monkeypatch.setattr(language, "BLOCK", 64)
    assert parser.phrases([text])[0].tolist() == np.sum(whole, axis=0).tolist()


def test_language_of_odd_texts(spark):
    learned = frame(spark, ["the cat and the dog", "der Hund und die Katze", "no language", None, "!!"]).withColumn(
        "lang", F.element_at(F.array(F.lit("en"), F.lit("de"), F.lit(None), F.lit("en"), F.lit("xx")), (F.col("doc_id") + 1).cast("int"))
    )
    parser = language.learn(learned)
    assert parser.languages == ["de", "en"]
    docs = frame(spark, [*ODD, "the dog and the cat", "die Katze und der Hund"]).withColumn("SCORE", F.lit("taken")).withColumn("more", F.lit(1))
    rows = {r["doc_id"]: r for r in language.identify(docs, parser).collect()}
    assert [rows[k]["lang_pred"] for k in range(4)] == ["und"] * 4 and [rows[k]["score"] for k in range(4)] == [0.0] * 4
    assert [rows[k]["lang_pred"] for k in (6, 7)] == ["en", "de"] and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[0].asDict().keys() == {"doc_id", "text", "more", "lang_pred", "score"}
    assert language.learn(learned.limit(0)) is None
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.limit(0), parser).count() == 0


def test_additive_model_finds_an_interaction():
    chance = np.random.default_rng(1)
    x = chance.random((3000, len(quality.MEASURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    cuts, coarse_cuts = quality.cuts_of(x, quality.BINS), quality.cuts_of(x, quality.PAIR_BINS)
    fine, coarse = (np.stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cs)], axis=1) for cs in (cuts, coarse_cuts))
    tables, pair_tables = quality.boost(fine, coarse, y, 0.0)
    n = x.shape[1]
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    model = quality.Model(cuts, coarse_cuts, 0.0, tables, pairs, pair_tables)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95
    assert np.argmax(np.abs(pair_tables).sum(axis=(1, 2))) == pairs.index((0, 1))


def test_quality_of_held_out_and_odd_texts(spark):
    good = [f"The {w} walks over the hill {k} times. It sees a house and a tree." for k, w in enumerate(["cat", "dog", "cow", "hen"] * 30)]
    bad = ["$$$ " * (k % 7 + 3) + "&&& buy" for k in range(120)]
    docs = frame(spark, [t for pair in zip(good, bad, strict=True) for t in pair] + ODD)
    labels = spark.range(240).select(F.col("id").alias("doc_id"), (1 - F.col("id") % 2).cast("int").alias("quality"))
    odd_labels = spark.createDataFrame([(None, 1), (5, None), (0, 1)], "doc_id bigint, quality int")
    model = quality.learn(docs, labels.union(odd_labels).filter(~held_out("doc_id", 3, 1)))
    rows = quality.score(docs.withColumn("Predicted", F.lit("taken")), model).collect()
    assert len(rows) == 246 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert all(r["predicted"] == 1 - r["doc_id"] % 2 for r in rows if r["doc_id"] < 240)
    assert quality.learn(docs, labels.limit(0)) is None
    assert {r["score"] for r in quality.score(docs, None).collect()} == {0.5}


@pytest.fixture(scope="module")
def vocabulary():
    public = pytest.importorskip("public_tokenizers")
    return bpe.Bpe(bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")))


def test_hash_is_minimal_and_perfect():
    keys = [str(k).encode() for k in range(3000)]
    found = bpe.MinimalHash(keys)
    assert sorted(found.key_at.tolist()) == list(range(3000)) and found.find(keys) == list(range(3000))
    assert found.find([b"x", b"", b"3000"]) == [-1] * 3
    assert bpe.MinimalHash([]).find([b"a"]) == [-1] and bpe.MinimalHash([b"a"]).find([b"a", b"b"]) == [0, -1]


def test_ids_equal_the_public_library(spark, vocabulary, monkeypatch):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    known = tiktoken.Encoding("known", pat_str=public.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    chance = random.Random(3)
    signs = "ab AB'stlmrevd\n\t\x1c\x85\xa0​ ½²éÉßжΩ漢字ก🙂🇩́!?#$%\x00\x0b\r_'' s"
    texts = ["".join(chance.choice(signs) for _ in range(chance.randrange(60))) for _ in range(3000)] + ["", "ab" * 50_000, "word " * 40_000]
    assert [i.tolist() for i in vocabulary.encode_many(texts)] == [known.encode_ordinary(t) for t in texts]
    monkeypatch.setattr(bpe, "SLAB", 50)
    monkeypatch.setattr(bpe, "KEPT", 100)
    long = [" ".join(texts[k : k + 20]) for k in range(0, 400, 20)]
    assert [i.tolist() for i in vocabulary.encode_many(long)] == [known.encode_ordinary(t) for t in long]


def test_round_trip(spark, vocabulary):
    docs = frame(spark, ODD).withColumn("Token_Ids", F.lit("taken"))
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in rows)
    assert rows[0]["token_ids"] == [] and len(rows) == len(ODD)
    assert bpe.encode(docs.limit(0), vocabulary).count() == 0
    with pytest.raises(ValueError, match="vocabulary"):
        vocabulary.decoder().decode(np.array([50256]))


def inverted(mean, u):
    """Count by adding up probabilities one after the other."""
    k, p = 0, math.exp(-mean)
    total = p
    while u >= total and k < 10_000:
        k += 1
        p *= mean / k
        total += p
    return k


def test_poisson_equals_adding_up():
    chance = np.random.default_rng(5)
    for mean in (0.01, 0.7, 3.0, 40.0):
        u = chance.random(500)
        assert mixing.poisson(np.full(500, mean), u).tolist() == [inverted(mean, x) for x in u]
    assert mixing.poisson(np.zeros(3), np.array([0.0, 0.5, 0.999])).tolist() == [0, 0, 0]
    big = mixing.poisson(np.full(2000, 1e6), chance.random(2000))
    assert abs(big.mean() - 1e6) < 200


def test_mixture_hits_the_weights_in_a_stable_order(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "a").otherwise("b").alias("source"), F.lit(9).alias("Copy"),
    )
    weights = spark.createDataFrame([(None, 3.0), ("a", 1.0), ("a", 0.0), ("b", None), ("absent", 50.0)], "source string, weight double")
    rows = mixing.mix(docs, weights, epochs=2.0, seed=4).collect()
    share = {s: sum(r["source"] == s for r in rows) for s in (None, "a", "b")}
    assert share["b"] == 0 and abs(share[None] - 9000) < 400 and abs(share["a"] - 3000) < 250
    keys = [r["shuffle_key"] for r in rows]
    assert keys == sorted(keys) and len(set(keys)) == len(keys) and "Copy" not in rows[0]
    again = mixing.mix(docs.repartition(7), weights, epochs=2.0, seed=4).collect()
    assert [(r["doc_id"], r["copy"]) for r in again] == [(r["doc_id"], r["copy"]) for r in rows]
    assert mixing.mix(docs.limit(0), weights).count() == 0 and mixing.mix(docs, weights.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None, None), (1, None, None), (1, None, None)], "doc_id bigint, text string, source string")
    assert mixing.mix(odd, spark.createDataFrame([(None, 1.0)], "source string, weight double"), epochs=30.0).count() > 30
