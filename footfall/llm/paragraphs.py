"""Merkle fingerprints of texts over leaves, paragraphs and sections.

Paragraphs are lines, cut into leaves at places that the text itself names: at some blanks, after some
letters of other scripts, after some runs of three; at the latest after ``LONGEST`` characters.  So texts of any
script, tables and lists have leaves of some twenty characters, and an edit moves no cut but those next to it.  The first
``FINE`` characters of a line are cut at blanks into leaves of ``WORD`` characters at most, so that short lines have several.  No character is lost.  A paragraph's digest is that of its leaves' digests; a section ends after a paragraph whose digest starts
with one of four of the sixteen digits; the root is the digest of the sections'.

Equal roots mean equal texts.  Where roots differ, the sections that both texts begin or end with are left out, then the
paragraphs that what remains begins or ends with, then the leaves; only what is left between is compared, each
repeat for itself.  Everything is a Spark expression.

A fingerprint is the root, the sections (digest, dot, paragraphs in it), the paragraphs (digest, dot, leaves in it) and the
leaves, parted by ``|`` and ``,``; below the root, digests are cut to ``SHORT`` digits, of leaves to ``LEAF`` ones.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.exprs import let

#: Characters of a leaf at most; characters of a line that are cut finely, and then of a leaf at most.
LONGEST, FINE, WORD = 64, 96, 12
#: Of the scripts beyond Latin, the characters after which a leaf ends: one run of 32 code points in 512.
_BLOCKS = "".join(f"{chr(k)}-{chr(k + 31)}" for k in range(0x400, 0xD800, 512))
_EVEN = "bdfhjlnprtvxzBDFHJLNPRTVXZ02468"
#: Where a leaf ends: at a blank between letters or digits of even code, or after a mark; after a character of ``_BLOCKS``; after three of certain kinds.
_ENDS = rf"(?<= )(?:(?<=[{_EVEN}] )(?=[{_EVEN}])|(?<=[.;:!?] ))|(?<=[a-dA-D0-3][i-lI-L6-9][q-tQ-T024])|(?<=[\u0400-\ud7ff])(?<=[{_BLOCKS}])"
LEAF_PATTERN = rf"(?s).{{1,{LONGEST}}}?(?:{_ENDS})|.{{1,{LONGEST}}}"
FINE_PATTERN = rf"(?s).{{{WORD // 2},{WORD}}}?(?<= )|.{{1,{WORD}}}"
SHORT, LEAF = 10, 6
#: Documents in a range of ids that is put in order in one task, and ranges at most.
RANGE_DOCS = 256
RANGES = 10_000


def _digest(parts: Column) -> Column:
    return F.md5(F.array_join(parts, ""))


def _counted(found: Column, digest: str, count: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat(F.left(x[digest], F.lit(SHORT)), F.lit("."), count(x).cast("string"))), ",")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a whole text; null counts as empty, which is one paragraph without a leaf."""

    def paragraph(line: Column) -> Column:
        start = F.regexp_extract_all(F.left(line, F.lit(FINE)), F.lit(FINE_PATTERN), F.lit(0))
        rest = F.regexp_extract_all(F.substring(line, FINE + 1, 2**31 - 1), F.lit(LEAF_PATTERN), F.lit(0))
        leaves = F.transform(F.concat(start, rest), lambda s: F.md5(s))
        return let(leaves, lambda x: F.struct(_digest(x).alias("digest"), x.alias("leaves")))

    def sections(digests: Column) -> Column:
        last = F.size(digests)
        ends = F.filter(F.sequence(F.lit(1), last), lambda i: (i == last) | F.left(F.get(digests, i - 1), F.lit(1)).isin("0", "1", "2", "3"))

        def cut(at: Column) -> Column:
            def section(end: Column, k: Column) -> Column:
                before = F.when(k > 0, F.get(at, F.greatest(k - 1, F.lit(0)))).otherwise(0)
                return F.struct(_digest(F.slice(digests, before + 1, end - before)).alias("digest"), (end - before).alias("size"))

            return F.transform(at, section)

        return let(ends, cut)

    def whole(found: Column) -> Column:
        def built(digests: Column) -> Column:
            leaves = F.flatten(F.transform(found, lambda p: p["leaves"]))
            short = F.array_join(F.transform(leaves, lambda d: F.left(d, F.lit(LEAF))), ",")
            paragraphs = _counted(found, "digest", lambda p: F.size(p["leaves"]))
            return let(
                sections(digests), lambda s: F.concat_ws("|", _digest(F.transform(s, lambda x: x["digest"])), _counted(s, "digest", lambda x: x["size"]), paragraphs, short)
            )

        return let(F.transform(found, lambda p: p["digest"]), built)

    return let(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), paragraph), whole)


def _level(fingerprint: Column, level: int) -> Column:
    part = F.split_part(fingerprint, F.lit("|"), F.lit(level))
    return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ","))


def _sum(entries: Column) -> Column:
    """The sum of the numbers after the dots."""
    return F.aggregate(entries, F.lit(0), lambda n, x: n + F.split_part(x, F.lit("."), F.lit(2)).cast("int"))


def _between(one: Column, two: Column, then: Callable[[Column, Column], Column]) -> Column:
    """``then(front, back)``: how many entries both lists begin with, and how many of the others both end with."""

    def alike(a: Column, b: Column, most: Column) -> Column:
        first = F.array_position(F.zip_with(F.slice(a, F.lit(1), most), F.slice(b, F.lit(1), most), lambda x, y: x == y), F.lit(False))
        return F.when(first == 0, most).otherwise((first - 1).cast("int"))

    def from_behind(front: Column) -> Column:
        back = alike(F.reverse(one), F.reverse(two), F.least(F.size(one), F.size(two)) - front)
        return let(back, lambda g: then(front, g))

    return let(alike(one, two, F.least(F.size(one), F.size(two))), from_behind)


def _middle(entries: Column, front: Column, back: Column) -> Column:
    return F.slice(entries, front + 1, F.size(entries) - front - back)


def _below(entries: Column, parts: Column, front: Column, back: Column) -> Column:
    """The ``parts`` that belong to the entries between ``front`` and ``back``."""
    before = _sum(F.slice(entries, F.lit(1), front))
    return F.slice(parts, before + 1, _sum(_middle(entries, front, back)))


def _told_apart(entries: Column, digits: int) -> Column:
    """The entries, each with a number that tells its repeats apart; in sorted order."""
    joined = F.array_join(F.array_sort(entries), "")
    runs = F.regexp_extract_all(joined, F.lit(rf"(?s)((.{{{digits}}})\2*)"), F.lit(1))
    return F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), (F.length(r) / digits).cast("int")), lambda k: F.concat(F.left(r, F.lit(digits)), k.cast("string")))))


def _root(fingerprint: Column) -> Column:
    return F.split_part(fingerprint, F.lit("|"), F.lit(1))


def _differing_paragraphs(one: Column, two: Column, then: Callable[..., Column]) -> Column:
    """``then`` of both texts' paragraphs in differing sections, and how many paragraphs of each lie before them."""

    def descend(s1: Column, s2: Column, p1: Column, p2: Column) -> Column:
        def inside(front: Column, back: Column) -> Column:
            first, second = _below(s1, p1, front, back), _below(s2, p2, front, back)
            before = _sum(F.slice(s1, F.lit(1), front))  # the same in both
            return let(F.struct(first.alias("a"), second.alias("b"), before.alias("n")), lambda m: then(m["a"], m["b"], m["n"], p1, p2))

        return _between(s1, s2, inside)

    levels = F.struct(*[_level(f, k).alias(f"{n}{k}") for n, f in (("a", one), ("b", two)) for k in (2, 3)])
    return let(levels, lambda v: descend(v["a2"], v["b2"], v["a3"], v["b3"]))


def likeness(one: Column, two: Column) -> Column:
    """1 if the roots are equal, else twice the number of leaves that the descent finds in both over the sum of those in each; 0 without leaves."""

    def of_paragraphs(m1: Column, m2: Column, before: Column, p1: Column, p2: Column) -> Column:
        def inside(front: Column, back: Column) -> Column:
            skipped = before + front

            def leaves(of: Column, paragraphs: Column, middle: Column) -> Column:
                start = _sum(F.slice(paragraphs, F.lit(1), skipped))
                return F.slice(_level(of, 4), start + 1, _sum(_middle(middle, front, back)))

            both = F.struct(leaves(one, p1, m1).alias("a"), leaves(two, p2, m2).alias("b"), _sum(p1).alias("n1"), _sum(p2).alias("n2"))
            return let(both, of_leaves)

        return _between(m1, m2, inside)

    def of_leaves(v: Column) -> Column:
        def counted(front: Column, back: Column) -> Column:
            rest = F.struct(_middle(v["a"], front, back).alias("a"), _middle(v["b"], front, back).alias("b"))
            shared = let(rest, lambda r: F.size(F.array_intersect(_told_apart(r["a"], LEAF), _told_apart(r["b"], LEAF))))
            # What is not between the differing ends is in both.
            matched = v["n1"] - F.size(v["a"]) + front + back + shared
            total = v["n1"] + v["n2"]
            return F.when(total > 0, 2.0 * matched / total).otherwise(F.lit(0.0))

        return _between(v["a"], v["b"], counted)

    return F.when(_root(one) == _root(two), 1.0).otherwise(_differing_paragraphs(one, two, of_paragraphs))


def changed_paragraphs(one: Column, two: Column) -> Column:
    """A struct ``one``, ``two``: the places (from 1) of the paragraphs of each text that the other lacks; empty if the roots are equal.

    Repeats count: of a paragraph that one text has three times and the other once, two places differ, the last ones.
    Paragraphs that only lie in another order inside the differing part are in both.
    """
    width = SHORT

    def of_paragraphs(m1: Column, m2: Column, before: Column, p1: Column, p2: Column) -> Column:
        def inside(front: Column, back: Column) -> Column:
            rest = F.struct(*[F.transform(_middle(m, front, back), lambda x: F.left(x, F.lit(width))).alias(n) for n, m in (("a", m1), ("b", m2))])

            def places(mine: Column, other: Column) -> Column:
                # Each place with which repeat of its digest it is.
                numbered = F.transform(mine, lambda x, i: F.concat(x, F.size(F.filter(F.slice(mine, F.lit(1), i + 1), lambda y: y == x)).cast("string")))

                def lacking(tags: Column) -> Column:
                    gone = F.array_except(tags, _told_apart(other, width))
                    return F.transform(gone, lambda t: (before + front + F.array_position(tags, t)).cast("int"))

                return let(numbered, lacking)

            return let(rest, lambda r: F.struct(places(r["a"], r["b"]).alias("one"), places(r["b"], r["a"]).alias("two")))

        return _between(m1, m2, inside)

    none = F.array().cast("array<int>")
    nothing = F.struct(none.alias("one"), none.alias("two"))
    return F.when(_root(one) == _root(two), nothing).otherwise(_differing_paragraphs(one, two, of_paragraphs))


def with_next(docs: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``next_<column>`` of the document with the next id; after the last comes the first.

    Null ids come first, rows with equal ids in order of a digest of their text.  Ids are cut into ranges at some of
    their quantiles, and each range is put in order by one task; the first document of a range, one whose id
    is a quantile, is also sent to the range before it, so documents move once and none waits for another task.
    """
    seen = docs.agg(F.count("*").alias("n"), F.min(doc_id).alias("low"), F.count_if(F.col(doc_id).isNull()).alias("nulls")).first()
    many = min(RANGES, max(1, seen["n"] // RANGE_DOCS))
    shares = [k / many for k in range(1, many)] or [0.5]
    cuts = docs.agg(F.percentile_approx(doc_id, shares, 50_000).alias("cuts")).first()["cuts"] or []
    cuts = sorted(set(cuts))
    width = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[k : k + width] for k in range(0, len(cuts), width)]

    def constant(values: list, kind: str) -> Column:
        return F.from_json(F.lit(json.dumps(values)), kind)

    key, first = F.col(doc_id), constant([b[0] for b in blocks], "array<bigint>")
    # Ranges are found in two steps, by the first cut of each block and then within the block.
    block = F.size(F.filter(first, lambda c: c <= key)) if blocks else F.lit(0)
    inner = F.get(constant(blocks, "array<array<bigint>>"), F.col("_block") - 1)
    rank = F.when(F.col("_block") > 0, (F.col("_block") - 1) * width + F.size(F.filter(inner, lambda c: c <= key))).otherwise(0)
    at_cut = F.when(F.col("_block") > 0, F.array_contains(inner, key)).otherwise(False) if blocks else F.lit(False)
    start = key.isNull() if seen["nulls"] else key.eqNullSafe(F.lit(seen["low"]))
    placed = docs.withColumn("_block", F.when(key.isNull(), 0).otherwise(block)).withColumns({"_range": rank.cast("int"), "_at_cut": at_cut, "_start": start})
    turn = F.array_compact(
        F.array(
            F.struct(F.col("_range").alias("range"), F.lit(0).alias("turn")),
            F.when(F.col("_at_cut") & (F.col("_range") > 0), F.struct((F.col("_range") - 1).alias("range"), F.lit(1).alias("turn"))),
            F.when(F.col("_start"), F.struct(F.lit(len(cuts)).alias("range"), F.lit(2).alias("turn"))),
        )
    )
    spread = placed.withColumn("_turn", F.explode(turn)).withColumns({"_range": F.col("_turn.range"), "_turn": F.col("_turn.turn")})
    order = W.partitionBy("_range").orderBy("_turn", F.col(doc_id).asc_nulls_first(), F.xxhash64(text))
    following = spread.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return following.filter("_turn = 0").drop("_range", "_turn", "_block", "_at_cut", "_start")


def edited(text: Column, following: Column) -> Column:
    """The text whose last half (rounded down) gives way to as many code points of the start of the other, or all it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))
