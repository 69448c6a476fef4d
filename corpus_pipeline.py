"""From documents to token ids: language, quality, near-duplicates, mixture, tokens.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns what stays of ``docs``.  All but the last
return the columns of documents.  ``run`` writes each stage below ``spark.checkpoint.dir`` and reads it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, language, mixing, quality, simhash
from footfall.llm.queries import MIX_POWER, MIX_SEED, public_bpe
from footfall.llm.tables import held_out, put_back, set_aside, table
from footfall.sources.staging import Staging


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages, mixed ones in that of most of their text; only those without text or letters go."""
    parser = language.learn(docs.filter(~held_out("doc_id", 4, 2)))
    named, names = set_aside(docs)
    found = language.identify(named, parser, names["text"])
    return found.filter(F.col("lang_pred") != language.UNDETERMINED).select(*put_back(names))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives an even chance or better."""
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 3, 1))
    model = quality.learn(docs, labels)
    named, names = set_aside(docs)
    return quality.score(named, model, names["text"]).filter("predicted = 1").select(*put_back(names))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates (fingerprints of 4-word shingles at most 4 bits apart): the one with the smallest id."""
    return simhash.one_of_each(docs, Staging(spark))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in shuffled order, sources weighted by the square root of their size."""
    named, names = set_aside(docs)
    weights = mixing.tempered_weights(named, MIX_POWER, names["source"])
    copies = mixing.mix(named, weights, seed=MIX_SEED, source=names["source"], doc_id=names["doc_id"], text=names["text"])
    return copies.select(*put_back(names))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``token_ids``, ``n_tokens`` and ``decoded_sha256``, the digest of what the ids decode to."""
    vocabulary = public_bpe()
    read = bpe.decode(bpe.encode(docs.select("doc_id", "source", "text"), vocabulary).drop("text"), vocabulary)
    return read.select("doc_id", "source", "token_ids", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", without_near_duplicates),
    ("mixture", mixed),
    ("tokens", tokens),
]

#: SQL has neither the classifiers nor the fingerprints' 64-bit hash; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage, docs = Staging(spark), table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
