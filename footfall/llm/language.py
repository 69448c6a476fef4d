"""Language by cross-parsing entropy.

For each language a suffix automaton of labelled text is learned.  A text is parsed into phrases, each the
longest match that the automaton still reads; the fewer phrases a language needs, normalised by the size of
its automaton's text and the length of the text, the better it explains the text.  The lowest cost wins.

Text is lower-cased and everything but letters becomes one space; what is parsed are its UTF-8 bytes, in
blocks of ``BLOCK`` bytes, at whose ends a phrase ends.  So one very long text is many short rows of work,
and all blocks of a batch and all languages step through one table together.  The table holds the moves of all
automata in rows that are laid over each other, about 20 bytes a state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from footfall.llm.tables import fields, without

#: Of each language: documents that training may take text from, characters of each in so many spans, and bytes in all.
TRAIN_DOCS = 200
TRAIN_CHARS_A_DOC, TRAIN_SPANS = 200, 4
TRAIN_BYTES = 40_000
BLOCK = 1_024
#: Blocks that step together.
LANES = 4_096
#: Shifts at which a row of moves is tried at a time.
LOOK = 256
UNDETERMINED = "und"


def letters(text: Column) -> Column:
    """Lower-case letters with single spaces between, spaces at both ends; no letters: one space."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), r"[^\p{L}]+", " ")


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the states of the suffix automaton of ``text``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for byte in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and byte not in moves[at]:
            moves[at][byte] = new
            at = link[at]
        if at >= 0:
            old = moves[at][byte]
            if length[old] == length[at] + 1:
                link[new] = old
            else:
                twin = len(moves)
                moves.append(dict(moves[old]))
                length.append(length[at] + 1)
                link.append(link[old])
                while at >= 0 and moves[at].get(byte) == old:
                    moves[at][byte] = twin
                    at = link[at]
                link[old] = link[new] = twin
        last = new
    return moves


def laid_over(rows: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base``, ``owner``, ``to``: the move of row r by code c is ``to[base[r] + c]`` if ``owner[base[r] + c]`` is r, else there is none.

    Rows share one array, each shifted to where its moves meet free places: the longest rows first, at the first
    shift that fits; a row of one move takes the next free place.
    """
    owner = np.full(2 * (sum(map(len, rows)) + width) + LOOK, -1, np.int32)
    to = np.zeros(len(owner), np.int32)
    base = np.zeros(len(rows), np.int32)

    def longer(places: int) -> tuple[np.ndarray, np.ndarray]:
        return np.append(owner, np.full(places, -1, np.int32)), np.append(to, np.zeros(places, np.int32))

    at, moves = 0, 0
    for r in sorted((r for r, row in enumerate(rows) if len(row) > 1), key=lambda r: (-len(rows[r]), r)):
        codes = np.array(sorted(rows[r]))
        if len(codes) != moves:  # rows of one length are laid from left to right
            at, moves = 0, len(codes)
        while True:
            if at + LOOK + width >= len(owner):
                owner, to = longer(len(owner))
            fits = (owner[at + np.arange(LOOK)[:, None] + codes] < 0).all(axis=1)
            if fits.any():
                break
            at += LOOK
        at += int(np.argmax(fits))
        base[r], owner[at + codes], to[at + codes] = at, r, [rows[r][c] for c in codes.tolist()]
    single = [(r, *next(iter(row.items()))) for r, row in enumerate(rows) if len(row) == 1]
    owner, to = longer(len(single) + width)
    free = (np.flatnonzero(owner[width:] < 0) + width)[: len(single)]
    state, code, target = np.array(single, np.int32).reshape(-1, 3).T
    base[state], owner[free], to[free] = free - code, state, target
    end = int(base.max(initial=0)) + width + 1
    return base, owner[:end], to[:end]


class Parser:
    """The automata of all languages as one table; ``phrases`` counts the phrases of many texts at once."""

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts)
        known = sorted({b for t in texts.values() for b in t})
        self.code = np.zeros(256, np.int32)
        self.code[known] = np.arange(1, len(known) + 1)
        width, rows, self.roots = len(known) + 1, [], []
        # Where a phrase that a byte opens goes on: the root's move, or the root itself.
        self.opened = np.zeros((len(texts), width), np.int32)
        for k, name in enumerate(self.languages):
            moves, start = suffix_automaton(texts[name]), len(rows)
            self.roots.append(start)
            rows += [{int(self.code[byte]): start + to for byte, to in row.items()} for row in moves]
            self.opened[k] = start
            for code, to in rows[start].items():
                self.opened[k, code] = to
        self.base, self.owner, self.to = laid_over(rows, width)
        self.bits = np.log2([max(len(texts[n]), 2) for n in self.languages])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text by each language, shape (texts, languages)."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        pieces = [(len(t) - at, k, at) for k, t in enumerate(texts) for at in range(0, len(t), BLOCK)]
        pieces = sorted(((min(n, BLOCK), k, at) for n, k, at in pieces), reverse=True)
        for first in range(0, len(pieces), LANES):
            lanes = pieces[first : first + LANES]
            size = np.array([p[0] for p in lanes])
            padded = b"".join(texts[k][at : at + BLOCK].ljust(size[0], b"\0") for _, k, at in lanes)
            codes = self.code[np.frombuffer(padded, np.uint8).reshape(len(lanes), size[0]).T]  # a row per step
            still = np.searchsorted(-size, -np.arange(size[0]), side="left")  # lanes longer than the step
            state = np.repeat(np.array(self.roots, np.int32)[:, None], len(lanes), axis=1)
            ended = np.ones(state.shape, np.int64)  # the last phrase ends with the block
            for step in range(size[0]):
                n = still[step]
                now, code = state[:, :n], codes[step, :n]
                at = self.base[now] + code
                goes_on = self.owner[at] == now
                ended[:, :n] += ~goes_on
                # No move: the phrase ends, and the byte opens the next one.
                state[:, :n] = np.where(goes_on, self.to[at], self.opened[:, code])
            np.add.at(total, [k for _, k, _ in lanes], ended.T)
        return total

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of prepared texts: the score is how much cheaper the winner is than the next, 0 to 1."""
        size = np.array([len(t) for t in texts])
        cost = self.phrases(texts) * self.bits
        cost = np.where(size[:, None] > 1, cost / np.maximum(size, 1)[:, None], np.inf)
        best = np.argmin(cost, axis=1)  # the first of equal languages, in alphabetical order
        order = np.sort(cost, axis=1)
        second = order[:, 1] if cost.shape[1] > 1 else np.full(len(texts), np.inf)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isfinite(second), 1 - order[:, 0] / second, 1.0)
        none = size <= 1
        return [UNDETERMINED if n else self.languages[b] for n, b in zip(none, best, strict=True)], np.where(none, 0.0, score)


def spans(text: Column, digest: Column, chars: int = TRAIN_CHARS_A_DOC, parts: int = TRAIN_SPANS) -> Column:
    """So many characters of a text, whole if it is no longer: one span in each of ``parts`` equal stretches, at a place that the digest names."""
    room = F.floor(F.length(text) / parts)
    each = chars // parts
    starts = [F.lit(k) * room + F.pmod(F.xxhash64(digest, F.lit(k)), room - each + 1) for k in range(parts)]
    return F.when(F.length(text) <= chars, text).otherwise(F.concat_ws(" ", *[F.substring(text, (at + 1).cast("int"), F.lit(each)) for at in starts]))


def training_texts(
    labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", docs: int = TRAIN_DOCS, chars: int = TRAIN_CHARS_A_DOC, all_bytes: int = TRAIN_BYTES
) -> dict[str, bytes]:
    """A bounded sample for each language: ``docs`` documents in order of a digest, spans of ``chars`` characters of each, ``all_bytes`` in all.

    The digest is of text and id, so copies of a text are in the sample in proportion only.  Rows without language, text or letters teach
    nothing.  Rows are thinned by their digest to about four times ``docs`` a language before any are put in order.
    """
    order = F.xxhash64(doc_id, text)
    named = labelled.filter(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(lang).alias("lang"), F.col(text).alias("text"), order.alias("_order"))
    # One row a language; the automata of all of them are held together anyway.
    sizes = named.groupBy("lang").agg(F.count("*").alias("_rows"))
    drawn = F.shiftrightunsigned("_order", 11) * F.lit(2.0**-53) < 4.0 * docs / F.col("_rows")
    thin = named.join(F.broadcast(sizes), "lang").filter(drawn | (F.col("_rows") <= 100 * docs))
    ranked = thin.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy("_order", F.xxhash64("text")))).filter(F.col("_rank") <= docs)
    plain = ranked.select("lang", "_rank", "_order", letters(F.col("text")).alias("text"))
    cut = plain.select("lang", "_rank", spans(F.col("text"), F.col("_order"), chars).cast("binary").alias("text"))
    found: dict[str, bytes] = {}
    for row in cut.orderBy("lang", "_rank").toLocalIterator():
        if len(found.get(row["lang"], b"")) < all_bytes:
            found[row["lang"]] = found.get(row["lang"], b"") + bytes(row["text"])
    return {k: v[:all_bytes].decode(errors="ignore").encode() for k, v in found.items()}


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Parser | None:
    """The parser of all languages of ``labelled``; None if nothing there has a language and letters."""
    texts = training_texts(labelled, text, lang, doc_id)
    return Parser(texts) if texts else None


def identify(docs: DataFrame, parser: Parser | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    A text that is null or has no letters is ``und`` with score 0, and so is every text if nothing was
    learned.  Equal costs go to the language first in the alphabet, with score 0.  A text in several languages is in the one
    that explains it cheapest.  Very long texts are parsed whole, block by block; repeated rows get equal results.  All columns
    are carried along but those of these two names.
    """
    docs = without(docs, ["lang_pred", "score"])
    if parser is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(parser)

    @F.pandas_udf("lang_pred string, score double")
    def predictions(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lines = [t.encode() for t in batch]
            sizes, at, names, scores = [len(t) for t in lines], 0, [], []
            while at < len(lines):  # some megabytes of text at a time
                end, room = at + 1, LANES * BLOCK
                room -= sizes[at]
                while end < len(lines) and room >= sizes[end]:
                    room -= sizes[end]
                    end += 1
                one, two = shared.value.predict(lines[at:end])
                names += one
                scores.append(two)
                at = end
            yield pd.DataFrame({"lang_pred": names, "score": np.concatenate(scores) if scores else np.empty(0)})

    kept = [F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn("_found", predictions(letters(F.col(text)))).select(*kept, *fields("_found", ["lang_pred", "score"]))
