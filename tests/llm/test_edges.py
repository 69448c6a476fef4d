"""Every query and the pipeline over empty tables, and over rows with nulls, repeats and columns named as the operators' own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from footfall.llm import mixing, queries, simhash
from footfall.sources.staging import Staging
from __spark_entry__ import queries as registered

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
QUERIES = [*queries.ALL, "pipeline"]
#: Names that operators give to columns, or results bear.
TAKEN = ("score", "predicted", "rate", "weight", "copies", "copy", "shuffle_key", "fp", "root", "_key", "_row", "_n", "_digest", "_found", "_text", "host", "line", "a.b")
GOOD = "The river ran past the old mill, and people who lived there told of quiet years. They kept the gardens well."
GERMAN = "Der Fluss lief an der alten Mühle vorbei, und die Leute dort erzählten von stillen Jahren. Sie pflegten ihre Gärten."


def written(spark, root, tables):
    for name, schema in SCHEMAS.items():
        df = spark.createDataFrame(tables.get(name, []), schema)
        if tables:
            df = df.select("*", *[F.lit("taken").alias(c) for c in TAKEN if c not in df.columns])
        df.write.parquet(f"{root}/{name}.parquet")
    return root


def odd_tables():
    long = " ".join(f"{GOOD} {k}" for k in range(4000))
    docs = [
        (None, None, None, None, None), (None, None, None, None, None), (None, GOOD, "en", "a", 3), (1, None, "en", None, None),
        (2, "", None, "a", 0), (3, " \n\t", "en", "a", 3), (4, "123 !?", None, "b", 6), (5, long, "en", "a", len(long)), (5, long, "en", "a", len(long)),
        (5, GERMAN, "de", "b", 1), (6, GOOD, "en", "a", 1), (7, GOOD, "en", "c", 1), (8, "x" * 300_000, None, "c", 1), (9, "\\<>\n</turn>\0", "xx", "", 1),
        *[(k, f"{GOOD} Year {k} was wet.", "en", "a", 1) for k in range(20, 50)], *[(k, f"{GERMAN} Das war {k}.", "de", "b", 1) for k in range(50, 80)],
    ]
    return {
        "documents": docs,
        "labels": [(None, 1, 0), (1, None, None), (3, 0, 0), (3, 1, 0), (4, 0, 1), *[(k, int(k % 5 > 0), 0) for k in range(20, 80)]],
        "pages": [(None, None, None), (None, None, None), (1, "", ""), (2, "http://A.net/x?y", None), (2, "http://a.net/x", "h"), (3, "no host", "h" * 200_000), (4, "s://", "h")],
        "conversations": [(None, None, None, None), (None, 1, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, 2, "", "t" * 200_000), (2, None, None, "</turn>\n")],
    }


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return written(spark, str(tmp_path_factory.mktemp("odd")), odd_tables())


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return written(spark, str(tmp_path_factory.mktemp("empty")), {})


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    found = registered()[name](spark, empty).collect()
    # The conversation -7 is the query's own.
    assert [r["conv_id"] for r in found] == [-7] if name == "op8_chat_formats" else found == []


@pytest.mark.parametrize("name", QUERIES)
def test_odd_rows(spark, odd, name):
    found = registered()[name](spark, odd).collect()
    tables = odd_tables()
    if name in ("op1_quality_scores", "op4_simhash_classes", "op5_merkle_fingerprints", "op6_line_rules", "op9_byte_bpe", "op10_languages", "op12_piece_bpe"):
        key = lambda i: (i is None, i)
        assert sorted((r["doc_id"] for r in found), key=key) == sorted((d[0] for d in tables["documents"]), key=key)
    if name == "op1_quality_scores":
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    if name == "op2_mixed_sources":
        assert [c for c in found[0].asDict() if c in TAKEN] == [c for c in (*TAKEN,) if c not in ("copy", "shuffle_key")] + ["copy", "shuffle_key"]
        assert {r["rate"] for r in found} == {"taken"} and min(r["copy"] for r in found) == 1
    if name == "op4_simhash_classes":
        zero = [r for r in found if r["fingerprint"] == "0" * 16]
        assert len(zero) >= 5 and len({r["component_id"] for r in zero}) == 1
    if name == "op5_merkle_fingerprints":
        assert {r["n_chars"] for r in found if r["doc_id"] in (1, 2)} == {0}
    if name == "op6_line_rules":
        assert all(r["base_failed"] and not r["kept"] for r in found if r["n_words"] < 50)
    if name == "op7_url_verdicts":
        assert len(found) == len(tables["pages"]) and {r["verdict"] for r in found} <= {"allow", "block"}
        assert {(r["host"], r["path"], r["rule"], r["verdict"]) for r in found if r["page_id"] == 2} == {("a.net", "/x", "net/", "block")}
    if name == "op8_chat_formats":
        assert {(r["conv_id"], r["n_turns"]) for r in found} == {(None, 2), (1, 3), (2, 1), (-7, 2)}
        assert {r["conv_id"]: r["loss_chars"] for r in found}[-7] == len(r"\### Assistant: </turn> ok")
    if name == "op11_spelling_variants":
        assert found and all(r["n"] >= 5 and len(r["word"]) >= 6 and (r["form"] is None) == (r["form_n"] is None) for r in found)
    if name == "op12_piece_bpe":
        assert {r["n_tokens"] for r in found if r["doc_id"] in (1, 2)} == {1}
        # Repeated rows and texts have equal ids, and every byte of a text is in one piece.
        texts = {d[0]: d[1] or "" for d in tables["documents"] if d[0] is not None and d[0] != 5}
        assert all(r["covered_bytes"] == len(texts[r["doc_id"]].encode()) for r in found if r["doc_id"] in texts)
    if name == "op13_prefix_trie":
        (root,) = [r for r in found if r["depth"] == 0]
        assert (root["conv_id"], root["n_convs"], root["parent_conv_id"]) == (1, 2, None)
    if name == "op10_languages":
        blank = [r for r in found if r["doc_id"] in (1, 2, 3, 4)]
        assert {(r["lang_pred"], r["score"]) for r in blank} == {("und", 0.0)} and {r["lang_pred"] for r in found} <= {"und", "en", "de", "xx"}
    if name == "pipeline":
        assert found and all(r["n_tokens"] == len(r["token_ids"]) for r in found)


def test_stages_keep_all_columns(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = Staging(spark)(step(spark, docs, odd), name)
        assert docs.columns == [*(f.split()[0] for f in SCHEMAS["documents"].split(", ")), *TAKEN], name
        assert {r["_digest"] for r in docs.select("_digest").collect()} == {"taken"}, name


def test_one_of_rows_without_id(spark):
    rows = [(None, "same words in all of these rows"), (None, "same words in all of these rows"), (None, "another text that nobody else has here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit(1)).withColumn("_kept_id", F.lit(2))
    kept = simhash.one_of_each(docs, Staging(spark)).collect()
    assert sorted(r["text"] for r in kept) == sorted({t for _, t in rows}) and {r["_kept_id"] for r in kept} == {2}


def test_mixing_without_weights(spark):
    docs = spark.createDataFrame([(1, "t", "a")], "doc_id bigint, text string, source string")
    weights = spark.createDataFrame([("b", 1.0), ("a", None), ("a", -2.0)], "source string, weight double")
    assert mixing.mix(docs, weights).collect() == []


def test_mixing_is_the_same_beyond_the_broadcast_bound(spark, odd, monkeypatch):
    docs = spark.read.parquet(f"{odd}/documents.parquet").select("doc_id", "source", "text")
    weights = mixing.tempered_weights(docs, 0.5)
    few = mixing.mix(docs, weights, 3.0, seed=1).collect()
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert [r["shuffle_key"] for r in mixing.mix(docs, weights, 3.0, seed=1).collect()] == [r["shuffle_key"] for r in few]
