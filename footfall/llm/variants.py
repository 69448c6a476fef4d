"""Spelling variants: words one edit apart, found by pivotal grams.

The bigrams of a word are ordered by how many words have them, rare ones first.  One edit touches two bigrams at
most, so the first three are a word's prefix.  Two of them that do not overlap are its pivots: an edit
cannot touch both, so of two words one edit apart, the one whose prefix ends first in the order has a pivot that the other
has in its prefix, at most one place away.  Pivots are looked up among prefixes by bigram, length and place, and what
they find is verified.

A prefix ends with all bigrams equal to its third, so words that repeat a bigram are found too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.sources.staging import Staging

#: Edits between near words, characters in a gram.  A prefix has ``EDITS * GRAM + 1`` grams, ``EDITS + 1`` of them are pivots.
EDITS, GRAM = 1, 2
PREFIX = EDITS * GRAM + 1
#: Shorter words may lack the grams that the search needs.
LEAST_CHARS = PREFIX + GRAM - 1
#: Fixed values of the query: what words are made of.
NO_LETTERS = r"[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(text: Column) -> Column:
    """The runs of letters of a text with A-Z in lower case, as an array; null has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NO_LETTERS), lambda w: w != "")


def word_counts(words: DataFrame, word: str = "word", least_chars: int = LEAST_CHARS, least_count: int = 1) -> DataFrame:
    """``word``, ``n`` of the words of at least so many code points and occurrences; combined before the shuffle."""
    long = words.filter(F.length(word) >= least_chars)
    return long.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def gram_order(words: DataFrame) -> dict[str, int]:
    """How many words have each bigram: bounded by the square of the alphabet, whatever the table."""
    chars = F.col("word")
    grams = words.select(F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(chars) - GRAM + 1), lambda k: F.substring(chars, k, F.lit(GRAM))))).alias("gram"))
    return {r["gram"]: r["n"] for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}


def prefix_of(word: str, order: dict[str, int]) -> list[tuple[tuple[int, str], int]]:
    """The rarest grams of a word with their places, all that equal the last of them included."""
    grams = sorted(((order.get(g, 0), g), at) for at in range(len(word) - GRAM + 1) if (g := word[at : at + GRAM]))
    if len(grams) <= PREFIX:
        return grams
    last = grams[PREFIX - 1][0]
    return [g for g in grams if g[0] <= last]


def pivots_of(prefix: Sequence[tuple[tuple[int, str], int]], wanted: int = EDITS + 1) -> list[tuple[str, int]]:
    """``wanted`` grams of the prefix that do not overlap, with the smallest sum of frequencies; by dynamic programming over places.

    ``best[k]`` is the cheapest choice of k grams among those seen so far that ends early enough.
    """
    grams = sorted((at, cost, gram) for (cost, gram), at in prefix)
    best: list[list[tuple[int, tuple[tuple[str, int], ...]] | None]] = []  # per gram, per number of choices
    for i, (at, cost, gram) in enumerate(grams):
        row = list(best[-1]) if best else [(0, ())] + [None] * wanted
        free = next((j for j in range(i - 1, -1, -1) if grams[j][0] + GRAM <= at), None)
        before = best[free] if free is not None else [(0, ())] + [None] * wanted
        for k in range(1, wanted + 1):
            if before[k - 1] is not None:
                choice = before[k - 1][0] + cost, (*before[k - 1][1], (gram, at))
                if row[k] is None or choice < row[k]:
                    row[k] = choice
        best.append(row)
    found = best[-1][wanted] if best else None
    if found is None:
        raise ValueError("too few grams that do not overlap; a word is shorter than LEAST_CHARS")
    return list(found[1])


def marks_of(word: str) -> int:
    """Parities of the counts of letters (low half) and bigrams (high half), by 32 classes each.

    An edit changes the counts of two letters at most, and takes two bigrams and brings two at most.
    """
    marks = 0
    for letter in word:
        marks ^= 1 << ord(letter) % 32
    for first, second in zip(word, word[1:], strict=False):
        marks ^= 1 << 32 + (ord(first) * 31 + ord(second)) % 32
    return marks - (1 << 64) if marks >= 1 << 63 else marks


def _grams(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """One row per pivot and per gram of a prefix of each word: ``word``, ``pivot``, ``gram``, ``at``, ``marks``."""
    shared = words.sparkSession.sparkContext.broadcast(order)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for word in batch["word"]:
                prefix, marks = prefix_of(word, shared.value), marks_of(word)
                found += [(word, True, gram, at, marks) for gram, at in pivots_of(prefix)]
                found += [(word, False, gram, at, marks) for (_, gram), at in prefix]
            yield pd.DataFrame(found, columns=["word", "pivot", "gram", "at", "marks"])

    return words.select("word").mapInPandas(rows, "word string, pivot boolean, gram string, at int, marks bigint")


#: How much longer a near word is, and how much further on a gram may stand there that the edit leaves alone.
STEPS = ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))


def near_words(words: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """All pairs ``a``, ``b`` of distinct words of ``words`` (``word``) exactly one edit apart, each in both directions.

    One edit is an inserted, deleted or replaced code point.  Words must have at least ``LEAST_CHARS`` code points and
    come once.  Every pivot asks for prefixes with its gram at the five (length, place) pairs that one edit
    allows, so a frequent gram is spread over as many keys as words have lengths and places.  Parities of letters and bigrams
    spare most words that are found the whole comparison.
    """
    grams = stage(_grams(words, gram_order(words)).withColumn("size", F.length("word")), "grams")
    step = F.explode(F.array(*[F.struct(F.lit(size).alias("size"), F.lit(at).alias("at")) for size, at in STEPS]))
    pivots = grams.filter("pivot").withColumn("_step", step)
    pivots = pivots.select(F.col("word").alias("a"), F.col("marks").alias("a_marks"), "gram", (F.col("size") + F.col("_step.size")).alias("size"), (F.col("at") + F.col("_step.at")).alias("at"))
    prefixes = grams.filter("not pivot").select(F.col("word").alias("b"), F.col("marks").alias("b_marks"), "gram", "size", "at")
    low = F.lit(0xFFFFFFFF)
    differ = F.col("a_marks").bitwiseXOR(F.col("b_marks"))
    alike = (F.bit_count(differ.bitwiseAND(low)) <= 2 * EDITS) & (F.bit_count(F.shiftrightunsigned(differ, 32)) <= 2 * GRAM * EDITS)
    found = pivots.join(prefixes, ["gram", "size", "at"]).filter(alike & (F.col("a") != F.col("b")) & (F.levenshtein("a", "b", EDITS) == EDITS)).select("a", "b")
    return found.union(found.select("b", "a")).distinct()


def variant_forms(words: DataFrame, stage: Callable[[DataFrame, str], DataFrame], factor: int = 5) -> DataFrame:
    """``words`` (``word``, ``n``) with ``form``, ``root``, ``n_near`` and ``form_n``.

    The form is the near word of largest ``n``, of equal ones the smallest in code-point order, if its ``n`` is at
    least ``factor`` times the word's own; else null.  Following forms, ``n`` grows by that factor each time, so
    chains are as long as the logarithm of the largest ``n`` at most; the root is where they end.
    """
    if factor < 2:
        raise ValueError("forms may go in circles below a factor of 2")
    words = stage(words.select("word", "n"), "words")
    near = near_words(words, stage)
    seen = near.join(words.select(F.col("word").alias("b"), "n"), "b")
    best = seen.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), F.col("b").alias("form"))).alias("_best"))
    known = words.join(best, "word", "left")
    large = -F.col("_best.minus") >= factor * F.col("n")
    formed = stage(
        known.select(
            "word", "n", F.when(large, F.col("_best.form")).alias("form"), F.when(large, -F.col("_best.minus")).alias("form_n"),
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        ),
        "formed",
    )
    ends = formed.filter("form is not null").select("word", F.col("form").alias("end"))
    step = 0
    while True:
        # Pointers double, so rounds grow with the logarithm of the longest chain.
        ends = stage(ends, f"ends-{step}")
        further = ends.join(ends.select(F.col("word").alias("end"), F.col("end").alias("next")), "end")
        if further.isEmpty():
            break
        after = ends.select(F.col("word").alias("end"), F.col("end").alias("next"))
        ends = ends.join(after, "end", "left").select("word", F.coalesce("next", "end").alias("end"))
        step += 1
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")


def group_variants(words: DataFrame, stage: Staging, word: str = "word", least_chars: int = 6, least_count: int = 5, factor: int = 5) -> DataFrame:
    """The words of at least so many code points and occurrences with their forms, from one row per occurrence: see :func:`variant_forms`.

    A null word counts nowhere, a repeated row counts again, and no words give no rows.  Other columns are not carried along.
    """
    return variant_forms(word_counts(words, word, max(least_chars, LEAST_CHARS), least_count), stage, factor)


def words_with_slips(docs: DataFrame, every: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``, one row per run of letters of each whole text; a run loses one code point where ``every`` divides the checksum of id and run.

    The checksum also names the code point.  A null id is written as nothing, a null text has no runs.
    """
    run = docs.select(F.col(doc_id).alias("_id"), F.explode(runs(F.col(text))).alias("_run"))
    checksum = F.crc32(F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit(":"), F.col("_run")))
    summed = run.select("_run", checksum.alias("_sum"))
    at = F.pmod(F.col("_sum"), F.length("_run")).cast("int")
    slipped = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    return summed.select(F.when(F.col("_sum") % every == 0, slipped).otherwise(F.col("_run")).alias("word"))
