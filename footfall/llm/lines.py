"""Quality rules over lines that many documents of a host share, next to rules on the text alone.

Normalised lines are hashed, and per host the distinct documents with each line are counted.  A line in more
documents than the limits allow is boilerplate and is removed; a document that loses more than a share of
its characters that way is rejected.  Everything is a Spark expression.

Texts are read twice, once to count lines and once to remove them.  The lines to remove go to the texts, as one list a host, so
a text moves nowhere and its lines are looked up where it is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.exprs import BLANKS, let, without_signs, words
from footfall.llm.tables import put_back, set_aside, without
from footfall.operators.lookup import look_up_hot
from footfall.sources.staging import Staging

SYMBOLS = "#*$%&|<>"
WINDOW = 3
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_share", "kept", "cleaned_sha256")
#: Boilerplate lines are broadcast up to this number (some tens of bytes each); beyond, they are joined by a shuffle.
BROADCAST_LINES = 100_000


@dataclass(frozen=True)
class Limits:
    """A line is boilerplate in more than ``documents`` texts of a host and more than ``share`` of them.

    ``most``, if set, is a number of texts beyond which a line of ``long_chars`` characters or more is boilerplate whatever its
    share.  A document is depleted if it loses more than ``depleted``.
    """

    documents: int = 20
    share: float = 0.05
    most: int | None = None
    long_chars: int = 200
    depleted: float = 0.5
    least_words: int = 50
    repeat_percent: int = 50


def repeated_words(found: Column) -> Column:
    """Words of the array that lie in 3-word windows found twice or more, the first included.

    Windows are compared by a 64-bit hash of their words.  Most texts have no such window, which one pass over a
    hash set shows; only the others are sorted.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            def twin(x: Column, k: Column) -> Column:
                after = F.get(s, k + 1)["h"]
                before = F.when(k > 0, F.get(s, F.greatest(k - 1, F.lit(0)))["h"])
                return F.coalesce(x["h"] == after, F.lit(False)) | F.coalesce(x["h"] == before, F.lit(False))

            return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

        def union(at: Column) -> Column:
            reach = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
            return F.aggregate(reach, F.lit(0).cast("bigint"), lambda total, n: total + n)

        return let(let(placed, repeated), union)

    def windows(w: Column) -> Column:
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(hashes, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(covered(hashes))

    return let(let(found, windows), count)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")


def with_base(docs: DataFrame, text: str, limits: Limits) -> DataFrame:
    """``docs`` with the measures of the text alone; ``_text`` and ``_words`` stay."""
    full = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    lines = let(_lines(F.col("_text")), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))
    both = let(
        words(F.col("_text")),
        lambda w: F.struct(F.size(w).cast("bigint").alias("n"), F.length(F.array_join(w, "")).cast("bigint").alias("chars"), repeated_words(w).alias("r")),
    )
    measured = full.withColumn("_counts", both).withColumns(
        {
            "n_words": F.col("_counts.n"),
            "word_chars": F.col("_counts.chars"),
            "n_symbols": (F.length("_text") - F.length(without_signs(F.col("_text"), SYMBOLS))).cast("bigint"),
            "n_dup_lines": lines,
            "n_repeat_words": F.col("_counts.r"),
        }
    )
    failed = (F.col("n_words") < limits.least_words) | (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words"))
    return measured.withColumn("base_failed", failed).drop("_counts")


def aligned(text: Column) -> Column:
    """Every line in lower case, with single spaces between words and none around; lines without a word are empty."""
    single = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " ")
    return F.transform(F.split(single, "\n"), lambda x: F.trim(x))  # F.trim alone would take a line's place for the signs to trim


def normalised(text: Column) -> Column:
    """The lines with a word, see :func:`aligned`."""
    return F.filter(aligned(text), lambda x: x != "")


def digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _host(host: Column) -> Column:
    """Never null: documents without a host have one of their own."""
    return F.when(host.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), host.cast("string")))


def _key(host: Column, text: Column) -> Column:
    """A document as its host and text: copies on a host are one document."""
    return F.unhex(F.md5(F.concat(host, F.lit("\n"), text)))


def _line_rows(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``host``, ``doc``, ``line``, ``chars`` of every line with a word."""
    full = docs.select(_host(F.col(host)).alias("host"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = full.select("host", _key(F.col("host"), F.col("text")).alias("doc"), F.explode(normalised(F.col("text"))).alias("line"))
    return rows.select("host", "doc", digest(F.col("line")).alias("line"), F.length("line").cast("bigint").alias("chars"))


def boilerplate(docs: DataFrame, limits: Limits, text: str = "text", host: str = "source") -> DataFrame:
    """``host``, ``line`` (digest) and ``documents`` of the lines above the limits, counted over distinct texts of the host.

    The only shuffles are those of the counts, combined before them: first by (host, line, document), so that a common line
    is spread over all tasks, then by (host, line).
    """
    rows = _line_rows(docs, text, host)
    counted = rows.groupBy("host", "line").agg(F.count_distinct("doc").alias("documents"), F.max("chars").alias("chars")).filter(F.col("documents") > limits.documents)
    sizes = (
        docs.select(_host(F.col(host)).alias("host"), _key(_host(F.col(host)), F.coalesce(F.col(text), F.lit(""))).alias("doc"))
        .groupBy("host").agg(F.count_distinct("doc").alias("of"))
    )
    common = F.col("documents") > limits.share * F.col("of")
    if limits.most is not None:
        common = common | ((F.col("documents") > limits.most) & (F.col("chars") >= limits.long_chars))
    return counted.join(sizes, "host").filter(common).select("host", "line", "documents")


def _with_hits(docs: DataFrame, common: DataFrame) -> DataFrame:
    """``docs`` (``host``, ``text``) with ``_hits``, the digests of lines of the host (or of the text) that are to be removed; null for none."""
    if common.limit(BROADCAST_LINES + 1).count() <= BROADCAST_LINES:
        by_host = common.groupBy(F.col("host").alias("_host")).agg(F.collect_list("line").alias("_hits"))
        return docs.withColumn("_host", _host(F.col("host"))).join(F.broadcast(by_host), "_host", "left").drop("_host")
    # Too many to go everywhere: the lines are looked up one by one, and what was found comes back to the texts.
    place = F.concat("line", F.col("host").cast("binary")).alias("place")
    key = _key(_host(F.col("host")), F.coalesce(F.col("text"), F.lit("")))
    lines = _line_rows(docs, "text", "host").select("doc", "line", place).distinct()
    found = look_up_hot(lines, common.select(place, F.lit(True).alias("_common")), ["place"], "inner")
    hits = found.groupBy("doc").agg(F.collect_list("line").alias("_hits"))
    return look_up_hot(docs.withColumn("doc", key), hits, ["doc"]).drop("doc")


def without_boilerplate(
    docs: DataFrame, stage: Staging, limits: Limits = Limits(), text: str = "text", host: str = "source"
) -> DataFrame:
    """``docs`` with ``cleaned``, the text without the lines that are boilerplate on its host, and ``removed_share``.

    ``removed_share`` is the share of the characters in normalised lines that goes, 0 without lines.  Lines without a word stay, and
    so does the text of a line as it was written.  A null text is empty and a null host is a host; repeated rows are
    cleaned alike.  Columns of these two names are replaced, all others are carried along.
    """
    docs, names = set_aside(without(docs, ["cleaned", "removed_share"]))
    full = docs.withColumns({"text": F.coalesce(F.col(names[text]), F.lit("")), "host": F.col(names[host])})
    common = stage(boilerplate(full, limits, host="host"), "boilerplate")

    def removed(lines: Column) -> Column:
        def by(found: Column) -> Column:
            def gone(k: Column) -> Column:
                return F.coalesce(F.array_contains(found, F.get(lines, k)["digest"]), F.lit(False))

            kept = F.filter(F.split("text", "\n"), lambda _, k: ~gone(k))
            chars = F.aggregate(lines, F.lit(0).cast("bigint"), lambda n, x: n + x["chars"])
            lost = F.aggregate(F.filter(lines, lambda x: F.coalesce(F.array_contains(found, x["digest"]), F.lit(False))), F.lit(0).cast("bigint"), lambda n, x: n + x["chars"])
            return F.struct(F.array_join(kept, "\n").alias("cleaned"), (lost / chars).alias("removed_share"))

        nothing = F.struct(F.col("text").alias("cleaned"), F.lit(0.0).alias("removed_share"))
        hits = F.array_intersect(F.transform(lines, lambda x: x["digest"]), "_hits")
        return let(hits, lambda found: F.when(F.size(found) > 0, by(found)).otherwise(nothing))

    def line(x: Column) -> Column:
        return F.struct(F.when(x != "", digest(x)).alias("digest"), F.length(x).cast("bigint").alias("chars"))

    untouched = F.struct(F.col("text").alias("cleaned"), F.lit(0.0).alias("removed_share"))
    result = F.when(F.col("_hits").isNull(), untouched).otherwise(let(F.transform(aligned(F.col("text")), line), removed))
    return _with_hits(full, common).withColumn("_result", result).select(*put_back(names), "_result.cleaned", "_result.removed_share")


def judge(
    docs: DataFrame, stage: Staging, limits: Limits = Limits(), doc_id: str = "doc_id", text: str = "text", host: str = "source"
) -> DataFrame:
    """One row per document: ``doc_id`` and ``RESULTS``; the digest is that of the cleaned text, see :func:`without_boilerplate`.

    A null text has no words and fails; a null host is a host.  Repeated rows are judged alike.  Other columns are not carried along.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("host"))
    base = with_base(without_boilerplate(docs, stage, limits, host="host"), "text", limits)
    kept = ~F.col("base_failed") & (F.col("removed_share") <= limits.depleted)
    return base.withColumns({"kept": kept, "cleaned_sha256": F.sha2("cleaned", 256)}).select("doc_id", *RESULTS)
