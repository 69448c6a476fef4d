"""Byte-level BPE in two tiers.

Text is cut into pre-tokens by the rules of the tokenizer's split pattern, over arrays of code points.  Tier one looks the pre-tokens of many texts up at once in
a minimal perfect hash of the vocabulary: one displacement, one slot, one comparison of bytes.  Only what is
not a token as a whole reaches tier two, which merges its bytes in a linked list, the lowest rank first from a
heap, in n log n steps however long the pre-token is.

The rank file is read by the driver (a vocabulary has a bounded size) and broadcast with its hash.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import without

#: Pre-tokens that a worker keeps between texts, and characters worked off together.
KEPT = 250_000
SLAB = 1 << 20
#: Ids, or bytes, that a worker hands back at a time.
HANDED = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(hashes: np.ndarray, salt: np.ndarray) -> np.ndarray:
    x = hashes ^ (salt.astype(np.uint64) * _MIX)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class MinimalHash:
    """A minimal perfect hash: ``n`` distinct keys onto ``0..n-1``, by hash and displace.

    Keys share a bucket by their hash.  From the largest bucket on, each takes the first displacement that
    sends its keys to free slots.  A bucket of one key names its slot itself, as a negative displacement.
    """

    def __init__(self, keys: list[bytes]):
        self.keys = keys
        n = max(len(keys), 1)
        self.buckets = n // 3 + 1
        self.seed = 0
        while True:  # another seed in the unlikely case of two equal 64-bit hashes
            hashes = self.hashed(keys)
            if len(np.unique(hashes)) == len(keys):
                break
            self.seed += 1
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        starts = np.cumsum(sizes) - sizes
        self.displacement = np.zeros(self.buckets, np.int64)
        slots = np.full(n, -1, np.int64)
        tried = np.arange(64)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            members = order[starts[b] : starts[b] + sizes[b]]
            first = 0
            while True:
                to = (_mixed(hashes[members][None, :], (first + tried)[:, None]) % np.uint64(n)).astype(np.int64)
                spread = np.sort(to, axis=1)
                fits = (slots[to] < 0).all(axis=1) & (spread[:, 1:] != spread[:, :-1]).all(axis=1)
                if fits.any():
                    at = int(np.argmax(fits))
                    self.displacement[b] = first + at
                    slots[to[at]] = members
                    break
                first += len(tried)
        free = iter(np.flatnonzero(slots < 0).tolist())
        for b in np.flatnonzero(sizes == 1):
            slot = next(free)
            self.displacement[b] = -slot - 1
            slots[slot] = order[starts[b]]
        self.key_at = slots

    def hashed(self, keys: Iterable[bytes]) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(k, self.seed) for k in keys), np.uint64)

    def find(self, keys: list[bytes]) -> list[int]:
        """Index of each key, -1 for what is not a key."""
        if not self.keys or not keys:
            return [-1] * len(keys)
        hashes = self.hashed(keys)
        moved = self.displacement[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        slot = (_mixed(hashes, np.maximum(moved, 0)) % np.uint64(len(self.keys))).astype(np.int64)
        index = self.key_at[np.where(moved < 0, -moved - 1, slot)].tolist()
        return [i if self.keys[i] == k else -1 for i, k in zip(index, keys, strict=True)]


#: Of a code point: other, letter, number, white space, or the mark that stands between two texts.
OTHER, LETTER, NUMBER, SPACE, MARK = range(5)
BETWEEN = "\ud800"  # no text of Spark holds half a surrogate pair
#: Fixed values of the split pattern: what may follow an apostrophe that starts a pre-token.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: The code points with the White_Space property.
WHITE_SPACE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def classes() -> np.ndarray:
    """The class of every code point."""
    first = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    first[list(WHITE_SPACE)] = SPACE
    first[ord(BETWEEN)] = MARK
    return first


def starts_of(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points of class ``kind``, by the rules of the public split pattern.

    A run of one class is one pre-token; a space just before letters, numbers or other signs belongs to them; of
    a longer run of white space before such, the last one stands alone or belongs to them; an apostrophe
    that starts a pre-token takes one of the ``ENDINGS`` with it.
    """
    n = len(points)
    start = np.ones(n, bool)
    if n < 2:
        return start
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == MARK)
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] < SPACE))
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & start)
    padded = np.concatenate([points, np.zeros(3, points.dtype)])
    for ending in ENDINGS:
        here = quote
        for k, letter in enumerate(ending, 1):
            here = here[padded[here + k] == ord(letter)]
        start[here + 1] = False
        after = here + 1 + len(ending)
        start[after[after < n]] = True
    return start


def pieces_of(text: str, size: int) -> Iterator[str]:
    """Parts of at most ``size`` characters, if there is a single space between words to cut before."""
    at = 0
    while len(text) - at > size:
        cut = text.rfind(" ", at + 2, at + size)
        while cut > 0 and (ord(text[cut - 1]) in WHITE_SPACE or ord(text[cut + 1]) in WHITE_SPACE):
            cut = text.rfind(" ", at + 2, cut)
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


class Decoder:
    """The bytes of each id, and nothing else that encoding needs."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values(), default=-1) + 1
        words = [b""] * size
        for word, at in ranks.items():
            words[at] = word
        self.known = np.zeros(size, bool)
        self.known[list(ranks.values())] = True
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(words), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids; raises for an id that is not in the vocabulary."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all():
            raise ValueError("an id is not in the vocabulary")
        size = self.lengths[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - size), size)
        return self.bytes[at].tobytes()


class Bpe:
    """A vocabulary of ranks (bytes to id) for the public split pattern."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.hash = MinimalHash(list(ranks))
        self._prepare()

    def _prepare(self) -> None:
        """What is cheaper to build than to send."""
        ranks, self.ids = self.ranks, list(self.ranks.values())
        self.kept: dict[bytes, bytes] = {}
        self.classes = classes()
    def merged(self, piece: bytes) -> list[int]:
        """Tier two: ids of a pre-token that is no token as a whole."""
        n, rank = len(piece), self.ranks.get
        m = n + 1
        end, before = list(range(1, m)), list(range(-1, n - 1))  # links between parts; end 0: no part starts here
        heap = [(r * m + i) * m + i + 2 for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            at, stop = divmod(heappop(heap), m)
            left = at % m
            middle = end[left]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[left], end[middle] = stop, 0
            if stop < n:
                before[stop] = left
                if (r := rank(piece[left : end[stop]])) is not None:
                    heappush(heap, (r * m + left) * m + end[stop])
            if (first := before[left]) >= 0 and (r := rank(piece[first:stop])) is not None:
                heappush(heap, (r * m + first) * m + stop)
        ids, at = [], 0
        while at < n:
            ids.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def looked_up(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of distinct pre-tokens, each as the bytes of 32-bit numbers."""
        if len(self.kept) + len(pieces) > KEPT:
            self.kept.clear()
        found = list(map(self.kept.get, pieces))
        new = [k for k, ids in enumerate(found) if ids is None]
        for k, at in zip(new, self.hash.find([pieces[k] for k in new]), strict=True):
            ids = [self.ids[at]] if at >= 0 else self.merged(pieces[k])
            found[k] = self.kept[pieces[k]] = pack(f"={len(ids)}i", *ids)
        return found

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each of some texts."""
        mark = BETWEEN.encode("utf-8", "surrogatepass")
        joined = BETWEEN.join(texts) + BETWEEN
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.classes[points]
        first = np.flatnonzero(starts_of(points, kind))
        width = np.ones(len(points), np.uint8)
        for bound in (0x80, 0x800, 0x10000):
            width += points >= bound
        data = joined.encode("utf-8", "surrogatepass")
        offsets = np.append((np.cumsum(width, dtype=np.int64) - width)[first], len(data))
        cut = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = cut.dictionary_encode()
        code = coded.indices.to_numpy()
        pieces = coded.dictionary.to_pylist()
        end = pieces.index(mark)
        pieces[end] = b"a"
        ids = self.looked_up(pieces)
        ids[end] = b""
        flat = np.frombuffer(b"".join(ids), np.int32)
        size = np.array([len(i) // 4 for i in ids], np.int64)
        begin = np.cumsum(size) - size
        count = size[code]
        ends = np.cumsum(count)
        all_ids = flat[np.arange(ends[-1]) + np.repeat(begin[code] - (ends - count), count)]
        return np.split(all_ids, ends[np.flatnonzero(code == end)])[:-1]

    def encode_many(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text of any length; about ``SLAB`` characters are worked off together."""
        slab: list[str] = []
        room = SLAB
        for text in texts:
            if len(text) > SLAB:
                yield from self.encode_all(slab) if slab else ()
                yield np.concatenate([self.encode_all([p])[0] for p in pieces_of(text, SLAB)])
                slab, room = [], SLAB
                continue
            if slab and room < len(text):
                yield from self.encode_all(slab)
                slab, room = [], SLAB
            slab.append(text)
            room -= len(text)
        if slab:
            yield from self.encode_all(slab)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_many([text]))

    def decoder(self) -> Decoder:
        return Decoder(self.ranks)

    def __getstate__(self) -> dict:
        return {"ranks": self.ranks, "hash": self.hash}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._prepare()


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token in base 64 and its id."""
    with open(path, "rb") as file:
        return {base64.b64decode(word): int(at) for word, at in map(bytes.split, file)}


def in_parts(values: Iterable) -> Iterator[pd.Series]:
    """The values in series of bounded size, so a worker holds little of a batch's result."""
    part, size = [], 0
    for value in values:
        part.append(value)
        size += 0 if value is None else len(value)
        if size >= HANDED:
            yield pd.Series(part, dtype=object)
            part, size = [], 0
    if part:
        yield pd.Series(part, dtype=object)


def encode(docs: DataFrame, bpe: Bpe, text: str = "text", out: str = "token_ids") -> DataFrame:
    """``docs`` with ``out``, the array of ids of each whole text; null counts as empty and gives no ids.

    Texts longer than ``SLAB`` are worked off in pieces that end where pre-tokens do; repeated rows get equal ids.
    """
    docs = without(docs, [out])
    shared = docs.sparkSession.sparkContext.broadcast(bpe)

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield from in_parts(shared.value.encode_many(batch))

    return docs.withColumn(out, ids(F.coalesce(F.col(text), F.lit(""))))


def decode(docs: DataFrame, bpe: Bpe, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``, the bytes that the ids stand for; null for null."""
    docs = without(docs, [out])
    shared = docs.sparkSession.sparkContext.broadcast(bpe.decoder())

    @F.pandas_udf("binary")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield from in_parts(None if b is None else shared.value.decode(b) for b in batch)

    return docs.withColumn(out, texts(F.col(ids)))
