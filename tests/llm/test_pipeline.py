"""Every stage of the pipeline, and the whole of it, against plain Python on documents with planted cases."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import bpe, mixing, quality, simhash
from footfall.llm.queries import MIX_POWER, MIX_SEED
from footfall.llm.tables import held_out
from footfall.sources.staging import Staging
from test_models import inverted

ENGLISH = "the river ran past an old mill and people there told of quiet years while they kept their gardens well and sang in the evening".split()
GERMAN = "der fluss lief an einer alten mühle vorbei und die leute dort erzählten von stillen jahren als sie ihre gärten pflegten und abends sangen".split()


def documents():
    rng, rows = random.Random(11), []

    def prose(words, n):
        return ". ".join(" ".join(rng.choice(words) for _ in range(9)).capitalize() for _ in range(n)) + "."

    for k in range(90):
        rows.append((k, prose(ENGLISH, 6), "en", "web" if k % 4 else "books"))
        rows.append((100 + k, prose(GERMAN, 6), "de", "web"))
    for k in range(60):
        rows.append((200 + k, "$$$ " * (5 + k % 9) + "&&& kaufen buy " * (k % 5 + 2), "en" if k % 2 else "de", "web"))
    for k in range(0, 90, 7):
        rows.append((300 + k, rows[2 * k][1], "en", "web"))  # exact copies
        rows.append((500 + k, rows[2 * k][1].upper(), "en", "web"))  # that differ in case only
    # Without letters, empty, null, mixed, and rows without an id.
    rows += [(900, "123 456 !?", None, "web"), (901, "", "en", None), (902, None, "en", "web"), (903, prose(ENGLISH, 4) + " " + prose(GERMAN, 4), None, "web")]
    rows += [(None, prose(ENGLISH, 5), "en", "web"), (None, prose(GERMAN, 5), "de", None)]
    return rows


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    rows = [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in documents()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{root}/documents.parquet")
    labels = [(d, int(not 200 <= d < 300), 0) for d, *_ in documents() if d is not None]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


@pytest.fixture(scope="module")
def stages(spark, corpus):
    """The rows that go into each stage and come out of it."""
    stage, docs, found = Staging(spark), spark.read.parquet(f"{corpus}/documents.parquet"), {}
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, corpus), name)
        found[name] = docs, after
        docs = after
    return found


def told(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "near_duplicates", "mixture", "tokens"]


def test_language_keeps_all_that_has_letters(stages):
    before, after = stages["language"]
    expected = Counter({k: n for k, n in told(before).items() if any(c.isalpha() for c in k[1] or "")})
    assert told(after) == expected and (903 in {d for d, _ in told(after)})


def plain_score(model, measures):
    """Bin by bin and table by table."""
    total = model.start
    for k, cuts in enumerate(model.cuts):
        total += model.tables[k][sum(c <= measures[k] for c in cuts)]
    for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
        total += table[sum(c <= measures[i] for c in model.pair_cuts[i])][sum(c <= measures[j] for c in model.pair_cuts[j])]
    return 1 / (1 + math.exp(-total))


def test_quality_keeps_what_the_added_tables_say(spark, corpus, stages):
    before, after = stages["quality"]
    model = quality.learn(before, spark.read.parquet(f"{corpus}/labels.parquet").filter(~held_out("doc_id", 3, 1)))
    scores = {k: plain_score(model, quality.measures([k[1]])[0]) for k in told(before)}
    mine = {(r["doc_id"], r["text"]): r["score"] for r in quality.score(before, model).collect()}
    assert all(abs(mine[k] - scores[k]) < 1e-9 for k in scores)
    assert told(after) == Counter({k: n for k, n in told(before).items() if scores[k] >= 0.5})
    kept = {d for d, _ in told(after)}
    assert not kept & set(range(200, 260)) and kept >= {d for d in range(90)} | {100 + d for d in range(90)}


def test_one_document_of_each_class_stays(stages):
    before, after = stages["near_duplicates"]
    rows = sorted(told(before), key=str)
    prints = [simhash.fingerprint_of(t) & (1 << 64) - 1 for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    classes = defaultdict(list)
    for k, row in enumerate(rows):
        classes[find(k)].append(row)
    kept = told(after)
    assert len(kept) == len(classes) < len(rows) and set(kept.values()) == {1}
    for members in classes.values():
        named = [d for d, _ in members if d is not None]
        (stays,) = [r for r in members if r in kept]
        assert stays[0] == min(named, default=None)
    assert not {d for d, _ in kept if d is not None and 300 <= d < 700}


def test_copies_are_those_of_each_draw(stages):
    before, after = stages["mixture"]
    sizes = Counter(r["source"] for r in before.collect())
    weights = {s: n**MIX_POWER for s, n in sizes.items()}
    row = F.xxhash64(F.col("doc_id"), F.xxhash64(F.col("text")))
    keys = before.select("doc_id", "text", "source", F.shiftrightunsigned(F.xxhash64(row, F.lit(MIX_SEED), F.lit("draw")), 11).alias("u")).collect()
    expected = Counter()
    for r in keys:
        rate = sum(sizes.values()) * weights[r["source"]] / sum(weights.values()) / sizes[r["source"]]
        if copies := inverted(rate, r["u"] / 2**53):
            expected[r["doc_id"], r["text"]] += copies
    assert told(after) == expected and after.columns == before.columns


def test_tokens_are_those_of_the_library(spark, stages):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    known = tiktoken.Encoding("known", pat_str=public.PATTERN, mergeable_ranks=bpe.read_ranks(public.path("byte_bpe_50k.tiktoken")), special_tokens={})
    before, after = stages["tokens"]
    expected = Counter((r["doc_id"], tuple(known.encode_ordinary(r["text"]))) for r in before.collect())
    assert Counter((r["doc_id"], tuple(r["token_ids"])) for r in after.collect()) == expected
    assert all(r["n_tokens"] == len(r["token_ids"]) for r in after.collect())


def test_the_whole_run_is_its_stages(spark, corpus, stages):
    rows = lambda df: Counter((r["doc_id"], tuple(r["token_ids"]), r["decoded_sha256"]) for r in df.collect())
    assert rows(corpus_pipeline.run(spark, corpus)) == rows(stages["tokens"][1])


def test_a_shared_header_does_not_decide_the_language(spark):
    """All documents open with the same long English licence; what follows is in two languages."""
    from footfall.llm import language

    rng, header = random.Random(3), " ".join(ENGLISH * 20)
    rows = []
    for k in range(120):
        words = (ENGLISH, GERMAN)[k % 2]
        rows.append((k, f"{header}\n" + " ".join(rng.choice(words) for _ in range(900)), ("en", "de")[k % 2]))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    parser = language.learn(docs.filter("doc_id < 80"))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs.filter("doc_id >= 80").select("doc_id", F.expr("substr(text, 3000)").alias("text")), parser).collect()}
    assert found == {k: ("en", "de")[k % 2] for k in range(80, 120)}


def test_training_is_thinned_and_spread(spark):
    from footfall.llm import language

    # Far more rows than the sample takes; each text says where in it a character stands.
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("a"), 3000), F.repeat(F.lit("é"), 3000)).alias("text"), F.lit("x").alias("lang"))
    (text,) = language.training_texts(docs).values()
    assert len(text) <= language.TRAIN_BYTES and 0.2 < text.decode().count("é") / len(text.decode()) < 0.8
    few = language.training_texts(docs.filter("doc_id < 3"))
    assert len(few["x"]) <= 3 * 2 * (language.TRAIN_CHARS_A_DOC + language.TRAIN_SPANS)


def test_a_document_with_very_many_copies(spark):
    """One document of a source of its own, at an even mixture: its copies are counted, not gathered."""
    docs = spark.range(1, 3).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"), F.col("id").cast("string").alias("source"))
    weights = spark.createDataFrame([("1", 1.0), ("2", 1e-9)], "source string, weight double")
    found = mixing.mix(docs, weights, epochs=1e6, seed=1)
    counted = found.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("copy").alias("low"), F.max("copy").alias("high"), F.count_distinct("copy").alias("copies")).collect()
    (one,) = [r for r in counted if r["doc_id"] == 1]
    assert abs(one["n"] - 2e6) < 12 * math.sqrt(2e6) and one["low"] == 1 and one["high"] == one["n"] == one["copies"]


def test_a_rate_of_two_hundred_million():
    chance = np.random.default_rng(5)
    u = chance.random(1000)
    counts = mixing.poisson(np.full(1000, 2e8), u)
    assert len(mixing.cumulated(2e8)[1]) < 400_000 and abs(counts.mean() - 2e8) < 5 * math.sqrt(2e8 / 1000)
    assert abs(np.std(counts) / math.sqrt(2e8) - 1) < 0.1 and (np.argsort(counts, kind="stable") == np.argsort(u, kind="stable")).mean() > 0.9


def test_a_very_long_host():
    from footfall.llm.urls import HostRule, Hosts, parts

    hosts = Hosts([HostRule("block", "net", "/"), HostRule("allow", "example.net", "/en/")])
    host, path = parts("http://" + "a." * 40_000 + "example.net/en/x")
    assert len(host) > 80_000 and hosts.find(host, path).name == "example.net/en/" and hosts.find("b" * 80_000, "/") is None
