"""One query per operator over the whole of its table, with the parameters it is meant to run with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import bpe, chat, language, lines, mixing, paragraphs, pieces, quality, simhash, trie, urls, variants, warc
from footfall.llm.tables import held_out, table
from footfall.sources.staging import Staging

MIX_POWER, MIX_SEED = 0.5, 20_240_501
#: Pages whose copy in the replica is damaged or lost, by the remainder of their id.
DAMAGE_EVERY, CHANGED, LOST = 97, 5, 6
#: A run of letters in so many loses a letter.
SLIP_EVERY = 199
#: A conversation takes its first turns, fewer than so many, from the one whose id is the next lower multiple.
LENT_TURNS, LENDER_EVERY = 9, 5

HOST_RULES = (
    urls.HostRule("block", "net", "/"),
    urls.HostRule("allow", "example.net", "/en/"),
    urls.HostRule("block", "example.com", "/de/"),
    urls.HostRule("allow", "org", "/fr/"),
)
PATTERNS = (
    ".casino-win.", "-casino.", "/casino/", "||cheap-pills.", ".cheap-pills.", "-pills.", "/pills/", "/viagra/", "||slots.", "/slots/",
    "||adserver.", "/adserver/", "/banner/", "/banners/", "/doubleclick/", "||tracker.", "/tracker/", "/pixel.gif", "&affiliate=", "?affiliate=",
    "?sessionid=", "&sessionid=", "/wp-login.php", "/cgi-bin/", "/torrent/", "||torrent.", "||xxx.", "/xxx/", "/porn/", "||porn.",
    "@@||support.*/casino/", "@@/robots.txt|",
)


def op1_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a model of the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out("doc_id", 3, 1).alias("held_out"))
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 3, 1))
    return quality.score(docs, quality.learn(docs, labels)).select("doc_id", "held_out", "score", "predicted")


def op2_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of all documents in shuffled order, sources weighted by the square root of their size."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.tempered_weights(docs, MIX_POWER), seed=MIX_SEED)


def op3_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the pages' archive that a replica with planted damage has lost or changed."""
    pages, stage = table(spark, sf_dir, "pages"), Staging(spark)
    record = warc.record(F.col("page_id"), F.col("url"), F.col("html"))
    rest = F.coalesce(F.col("page_id") % DAMAGE_EVERY, F.lit(0))
    spoilt = warc.record(F.col("page_id"), F.col("url"), F.concat(F.lit("?"), F.substring("html", 2, 2**31 - 1)))
    copy = F.when(rest == CHANGED, F.sha2(spoilt, 256)).when(rest != LOST, F.sha2(record, 256))
    hashed = pages.select("page_id", F.sha2(record, 256).alias("digest"), F.octet_length(record).cast("bigint").alias("length"), copy.alias("copy"))
    # Equal pages are one record.
    records = hashed.groupBy("digest").agg(F.min("page_id").alias("page_id"), F.min("length").alias("length"), F.min("copy").alias("copy"))
    archive = stage(warc.lay_out(stage(records, "records")), "archive")
    mine = archive.select("file", "offset", "length", "digest")
    replica = archive.filter("copy is not null").select("file", "offset", "length", F.col("copy").alias("digest"))
    found = warc.audit(mine, replica, stage)
    return found.join(archive.select("file", "offset", "page_id"), ["file", "offset"], "left").select(
        "page_id", "file", "offset", "status", "length", "digest", "replica_length", "replica_digest"
    )


def op4_simhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document; classes are linked by fingerprints at most 4 bits apart."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), Staging(spark))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def op5_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are to it and to the next one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = docs.withColumn("fingerprint", paragraphs.fingerprint(F.col("text")))
    following = paragraphs.with_next(marked, ["text", "fingerprint"])
    changed = following.withColumn("edited", paragraphs.edited(F.col("text"), F.col("next_text")))
    both = changed.withColumn("edited_fingerprint", paragraphs.fingerprint(F.col("edited")))
    mine = F.col("fingerprint")
    return both.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        paragraphs.likeness(mine, F.col("edited_fingerprint")).alias("near_edited"), paragraphs.likeness(mine, F.col("next_fingerprint")).alias("near_next"),
    )


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document, once the lines that many texts of its host share are removed."""
    return lines.judge(table(spark, sf_dir, "documents"), Staging(spark))


def op7_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict of every page's url."""
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), HOST_RULES, PATTERNS).drop("url")


def op8_chat_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is read back from the formatted conversations, and from one that holds control strings."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = F.lit(r"\### Assistant: </turn> ok")
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), odd.alias("text"))
    stage = Staging(spark)
    chosen = chat.conversations(chat.thread(said.unionByName(own)), stage)
    done = stage(chat.formatted(chosen), "formatted")
    read = done.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("learned", chat.under_mask(F.col("formatted"), F.col("mask")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def public_bpe(path: str | None = None) -> bpe.Bpe:
    """The public 50k vocabulary, or that of another rank file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.Bpe(bpe.read_ranks(path))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the digest of what they decode to."""
    vocabulary = public_bpe()
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
    read = bpe.decode(coded, vocabulary)
    return read.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def public_pieces(path: str | None = None) -> pieces.Model:
    """The public 32k model, or that of another model file."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.read_model(path)


def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by automata of the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out("doc_id", 4, 2).alias("held_out"))
    parser = language.learn(docs.filter("not held_out"))
    return language.identify(docs.drop("lang"), parser).select("doc_id", "held_out", "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents, some with a planted slip, and the frequent word each rare one is a variant of."""
    return variants.group_variants(variants.words_with_slips(table(spark, sf_dir, "documents"), SLIP_EVERY), Staging(spark))


def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text with an end id, what they decode to, and how many bytes of the text the pieces cover."""
    model = public_pieces()
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text")
    read = pieces.decode(coded, model)
    covered = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("bigint"), lambda a, n: a + n)
    return read.select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), covered.alias("covered_bytes"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that begin with turns of another one, so that many share their beginning."""
    stage = Staging(spark)
    said = stage(trie.turns(table(spark, sf_dir, "conversations")), "turns")
    taken = F.crc32(F.col("conv_id").cast("string")) % LENT_TURNS
    conversations = stage(said.select("conv_id").distinct(), "conversations")
    lent = said.filter(F.col("pos") < LENT_TURNS).withColumnRenamed("conv_id", "_lender")
    takers = conversations.withColumn("_lender", F.col("conv_id") - F.col("conv_id") % LENDER_EVERY)
    first = takers.join(lent, "_lender").filter(F.col("pos") <= taken)
    rebuilt = first.select("conv_id", "pos", "key", "size").unionByName(said.filter(F.col("pos") > taken))
    return trie.prefix_trie(rebuilt, conversations, stage)


ALL = {
    f.__name__: f
    for f in (
        op1_quality_scores, op2_mixed_sources, op3_fixity_audit, op4_simhash_classes, op5_merkle_fingerprints,
        op6_line_rules, op7_url_verdicts, op8_chat_formats, op9_byte_bpe, op10_languages, op11_spelling_variants, op12_piece_bpe, op13_prefix_trie,
    )
}
