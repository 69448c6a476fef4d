"""Quality classifier: a generalised additive model with pairwise interactions.

A text is described by a dozen measures of its characters, words and lines.  Each measure is cut into bins;
boosting goes round the measures, and each time fits a shallow tree to what is still unexplained along that
one measure and adds it to the measure's lookup table.  Then the pairs whose joint table would explain most
are found and boosted in the same way.  A score is a sum of table cells, one per measure and pair.

Training takes a bounded sample of labelled rows.  Several models are fitted to overlapping parts of the
sample, one Spark task each, and their tables averaged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import fields, without

#: Labelled rows that training takes at most.
TRAIN_ROWS = 20_000
BAGS = 6
BAG_SHARE = 0.8
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS, PAIR_ROUNDS = 150, 80
RATE = 0.1
#: Weight that pulls a leaf to zero, and the least weight of a leaf.
SHRINK, LEAST = 1.0, 5.0

MEASURES = (
    "chars", "words", "word_length", "longest_word", "symbols", "digits", "capitals", "points", "beyond_ascii",
    "distinct_words", "commonest_word", "distinct_pairs", "repeated_lines", "line_words", "ended_lines",
)
SYMBOLS = b"#*$%&|<>{}[]\\^~=_@+/"


def _of_bytes() -> np.ndarray:
    """For every byte: whether it is a symbol, a digit, a capital, a point or beyond ASCII, as a number of one bit each."""
    kind = np.zeros(256, np.uint8)
    kind[list(SYMBOLS)] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[ord("A") : ord("Z") + 1] = 3
    kind[list(b".,;:!?")] = 4
    kind[128:] = 5
    return kind


def measures_of(text: str, kind: np.ndarray) -> list[float]:
    """The ``MEASURES`` of a whole text; shares of nothing are zero."""
    data, words, lines = text.encode(), text.split(), [x for x in text.split("\n") if x.strip()]
    share = np.bincount(kind[np.frombuffer(data, np.uint8)], minlength=6)[1:] / max(len(data), 1)
    n, count = len(words), Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(len(text)),
        np.log1p(n),
        sum(map(len, words)) / max(n, 1),
        np.log1p(max(map(len, words), default=0)),
        *share.tolist(),
        len(count) / max(n, 1),
        max(count.values(), default=0) / max(n, 1),
        pairs / max(n - 1, 1),
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        sum(x.rstrip()[-1] in ".!?" for x in lines) / max(len(lines), 1),
    ]


def measures(texts: list[str]) -> np.ndarray:
    kind = _of_bytes()
    return np.array([measures_of(t, kind) for t in texts], float).reshape(len(texts), len(MEASURES))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + SHRINK)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return np.where(h >= LEAST, g * g / (h + SHRINK), -np.inf)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The value of each bin by the best tree of so many levels of cuts along the bins."""
    gs, hs = np.cumsum(g), np.cumsum(h)
    if depth and len(g) > 1:
        gain = _gain(gs[:-1], hs[:-1]) + _gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1])
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > gs[-1] ** 2 / (hs[-1] + SHRINK) + 1e-9:
            return np.concatenate([shallow_tree(g[:cut], h[:cut], depth - 1), shallow_tree(g[cut:], h[cut:], depth - 1)])
    return np.full(len(g), _leaf(gs[-1], hs[-1]) if len(g) else 0.0)


def crossed_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The value of each cell by the best cut along the rows with one cut along the columns on either side; its gain."""
    best, found = np.full(g.shape, _leaf(g.sum(), h.sum())), 0.0
    plain = g.sum() ** 2 / (h.sum() + SHRINK)
    upper_g, upper_h = np.cumsum(g, axis=0), np.cumsum(h, axis=0)
    for cut in range(1, g.shape[0]):
        sides, total = [], 0.0
        for gg, hh in ((upper_g[cut - 1], upper_h[cut - 1]), (upper_g[-1] - upper_g[cut - 1], upper_h[-1] - upper_h[cut - 1])):
            row = shallow_tree(gg, hh, 1)
            sides.append(row)
            total += float((2 * row * gg - row * row * (hh + SHRINK / len(row))).sum())
        if total - plain > found:
            found = total - plain
            best = np.concatenate([np.tile(sides[0], (cut, 1)), np.tile(sides[1], (g.shape[0] - cut, 1))])
    return best, found


@dataclass
class Model:
    """Cuts and lookup tables; ``score`` adds table cells up."""

    cuts: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    start: float
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for k, cuts in enumerate(self.cuts):
            total += self.tables[k][np.searchsorted(cuts, x[:, k], side="right")]
        coarse = [np.searchsorted(cuts, x[:, k], side="right") for k, cuts in enumerate(self.pair_cuts)]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def cuts_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each measure up to ``bins - 1`` cuts at its quantiles."""
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins)) if len(c) else np.empty(0) for c in x.T]


def boost(fine: np.ndarray, coarse: np.ndarray, y: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """Tables of all measures, then of all pairs (zero but for the chosen ones), boosted in turn."""
    n, tables, margin = fine.shape[1], np.zeros((fine.shape[1], BINS)), np.full(len(y), start)

    def rest() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for k in range(n):
            g, h = rest()
            step = RATE * shallow_tree(np.bincount(fine[:, k], g, BINS), np.bincount(fine[:, k], h, BINS))
            tables[k] += step
            margin = margin + step[fine[:, k]]
    pairs, cells = list(combinations(range(n), 2)), PAIR_BINS * PAIR_BINS

    def crossed(i: int, j: int) -> tuple[np.ndarray, float]:
        at = coarse[:, i] * PAIR_BINS + coarse[:, j]
        return crossed_tree(*(np.bincount(at, w, cells).reshape(PAIR_BINS, PAIR_BINS) for w in rest()))

    gains = [crossed(i, j)[1] for i, j in pairs]
    chosen = np.argsort(-np.array(gains), kind="stable")[:PAIRS]
    pair_tables = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for c in chosen:
            i, j = pairs[c]
            step = RATE * crossed(i, j)[0]
            pair_tables[c] += step
            margin = margin + step[coarse[:, i], coarse[:, j]]
    return tables, pair_tables


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS) -> Model | None:
    """Fit to at most ``rows`` of the labelled documents, in order of a digest of the id.

    Rows without id or label are left out; a document labelled more than once has its lowest label; a null text
    is empty.  None if there is no labelled row.  With one label only, every score is near that label.
    """
    spark = docs.sparkSession
    order = F.xxhash64("_id")
    picked = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label")).dropna()
        .groupBy("_id").agg(F.min("_label").alias("_label")).orderBy(order, "_id").limit(rows)
    )
    known = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")).join(F.broadcast(picked), "_id")

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series(list(measures(texts.tolist())), dtype=object)

    sample = known.select("_id", F.xxhash64("_text").alias("_digest"), "_label", described("_text").alias("x"))
    local = sample.orderBy(order, "_id", "_digest").limit(rows).toPandas()
    if local.empty:
        return None
    x, y = np.array(local["x"].tolist()), (local["_label"].to_numpy() > 0).astype(float)
    cuts, pair_cuts = cuts_of(x, BINS), cuts_of(x, PAIR_BINS)
    fine, coarse = (np.stack([np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cs)], axis=1) for cs in (cuts, pair_cuts))
    base = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(base / (1 - base)))
    shared = spark.sparkContext.broadcast((fine, coarse, y))

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bag in batch["id"]:
                fine, coarse, y = shared.value
                own = np.random.default_rng(int(bag)).random(len(y)) < BAG_SHARE
                one, two = boost(fine[own], coarse[own], y[own], start)
                yield pd.DataFrame({"bag": [bag], "tables": [one.ravel()], "pair_tables": [two.ravel()]})

    fitted = spark.range(0, BAGS, 1, BAGS).mapInPandas(fit, "bag bigint, tables array<double>, pair_tables array<double>").orderBy("bag").toPandas()
    n = x.shape[1]
    tables = np.mean([np.array(t).reshape(n, BINS) for t in fitted["tables"]], axis=0)
    pair_tables = np.mean([np.array(t).reshape(-1, PAIR_BINS, PAIR_BINS) for t in fitted["pair_tables"]], axis=0)
    used = np.flatnonzero(np.abs(pair_tables).sum(axis=(1, 2)))
    pairs = list(combinations(range(n), 2))
    return Model(cuts, pair_cuts, start, tables, [pairs[k] for k in used], pair_tables[used])


def score(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, and ``predicted``, 1 from 0.5 on.

    A null text is an empty one.  Very long texts are measured whole; repeated rows get equal scores.  Without a model every score
    is 0.5.  All columns are carried along but those
    of these two names.
    """
    docs = without(docs, ["score", "predicted"])
    if model is None:
        return docs.withColumns({"score": F.lit(0.5), "predicted": F.lit(1)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, predicted int")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = shared.value.score(measures(batch.tolist()))
            yield pd.DataFrame({"score": found, "predicted": (found >= 0.5).astype("int32")})

    kept = [F.col(f"`{c}`") for c in docs.columns]
    scored = docs.withColumn("_found", scores(F.coalesce(F.col(text), F.lit(""))))
    return scored.select(*kept, *fields("_found", ["score", "predicted"]))
