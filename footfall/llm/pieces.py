"""Sentence pieces with their places in the text.

A text is first normalised: at every place the longest prefix that the model's compiled character map knows is
replaced, what the map does not know stays, and blanks become the model's space sign.  Each normalised
character keeps the byte of the text it comes from, so every piece is projected back to the bytes it stands for.

Normalised text is cut between every two characters that stand side by side in no piece.  So merges stay inside a cut,
and a worker merges each distinct one once while it remembers it.

The model file is read by the driver (a vocabulary has a bounded size) and broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from struct import pack, unpack

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import without

SPACE = "▁"
REPLACEMENT = "�"
#: The kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
#: Cuts in each of the two generations that a worker remembers, and the longest of them in characters.
KEPT, KEPT_CHARS = 125_000, 64
#: Ids a worker hands back at a time.
HANDED = 1 << 20
NEVER = float("inf")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a serialised message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class CharacterMap:
    """The compiled character map: a double-array trie from byte strings to their replacements."""

    def __init__(self, blob: bytes):
        size = unpack("<I", blob[:4])[0] if blob else 0
        self.units = unpack(f"<{size // 4}I", blob[4 : 4 + size])
        self.replacements = blob[4 + size :]

    def _child(self, base: int, byte: int) -> int | None:
        """The unit that ``byte`` leads to from a node whose children start at ``base``."""
        at = base ^ byte
        return at if at < len(self.units) and self.units[at] & 0x800000FF == byte else None

    def _base(self, at: int) -> int:
        unit = self.units[at]
        return at ^ ((unit >> 10) << ((unit & 512) >> 6))

    def longest(self, data: bytes, at: int) -> tuple[int, str] | None:
        """Length in bytes of the longest key that ``data`` has at ``at``, and its replacement."""
        found, base = None, self._base(0)
        for end in range(at, len(data)):
            node = self._child(base, data[end])
            if node is None:
                break
            base = self._base(node)
            if self.units[node] >> 8 & 1:
                found = end + 1 - at, self.units[base] & 0x7FFFFFFF
        if found is None:
            return None
        size, start = found
        return size, self.replacements[start : self.replacements.index(b"\0", start)].decode()

    @cached_property
    def openers(self) -> re.Pattern | None:
        """Matches one character whose first byte opens a key; None for a map without keys."""
        if not self.units:
            return None
        base = self._base(0)
        first = [b for b in range(1, 256) if self._child(base, b) is not None]
        low = "".join(re.escape(chr(b)) for b in first if b < 128)
        high = [re.escape(b) + "-" + re.escape(e) for b, e in map(_led_by, [b for b in first if b >= 0xC2])]
        return re.compile(f"[{low}{''.join(high)}]") if low or high else None


def _led_by(byte: int) -> tuple[str, str]:
    """The first and the last code point whose UTF-8 starts with a byte from C2 to F4."""
    if byte < 0xE0:
        return chr((byte & 31) << 6), chr((byte & 31) << 6 | 63)
    if byte < 0xF0:
        return chr(max((byte & 15) << 12, 0x800)), chr((byte & 15) << 12 | 0xFFF)
    return chr(max((byte & 7) << 18, 0x10000)), chr(min((byte & 7) << 18 | 0x3FFFF, 0x10FFFF))


class Model:
    """Pieces, scores and normalisation of a model file of merged pieces."""

    def __init__(self, data: bytes):
        self.data = data
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict = {}
        normaliser: dict = {}
        for number, value in message_fields(data):
            if number == 1:
                piece = dict(message_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(unpack("<f", piece.get(2, bytes(4)))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(message_fields(value))
            elif number == 3:
                normaliser = dict(message_fields(value))
        # The numbers of the fields, and what holds where a file leaves one out.
        if trainer.get(3, 1) != 2:
            raise ValueError("not a model of merged pieces")
        if USER_DEFINED in self.kinds or UNUSED in self.kinds:
            raise ValueError("user-defined and unused pieces are not supported")
        self.space_last = bool(trainer.get(24, 0))
        self.byte_fallback = bool(trainer.get(35, 0))
        self.unknown_surface = trainer.get(44, " ⁇ ".encode()).decode()
        self.map = CharacterMap(normaliser.get(2, b""))
        self.dummy = bool(normaliser.get(3, 1))
        self.trim = bool(normaliser.get(4, 1))
        self.escape = bool(normaliser.get(5, 1))
        self.ids = {p: k for k, (p, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)) if kind == NORMAL}
        self.cost = {p: -self.scores[k] for p, k in self.ids.items()}
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): k for k, (p, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)) if kind == BYTE}
        self.controls = {k for k, kind in enumerate(self.kinds) if kind == CONTROL}
        self.bos, self.eos = (next((k for k, p in enumerate(self.pieces) if p == name), -1) for name in ("<s>", "</s>"))
        self.kept: dict[str, bytes] = {}
        self.kept_before: dict[str, bytes] = {}
        longer = [p for p in self.ids if len(p) > 1]
        signs = sorted({c for p in longer for c in p})
        #: A number for each character of the longer pieces, 0 for others, and whether two of them ever stand side by side.
        self.numbers = np.zeros(0x110000, np.int32)
        self.numbers[[ord(c) for c in signs]] = np.arange(1, len(signs) + 1)
        self.width = len(signs) + 1
        side = np.zeros((self.width, self.width), bool)
        for piece in longer:
            at = self.numbers[[ord(c) for c in piece]]
            side[at[:-1], at[1:]] = True
        self.side_by_side = side.ravel()

    def __reduce__(self):
        return Model, (self.data,)

    # --- normalisation ------------------------------------------------------------------------------

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and the byte of ``text`` that each of its characters starts at, with the end of the last one."""
        if not text:
            return "", np.zeros(1, np.int64)
        if self.map.openers is None and not self.trim:
            sign = SPACE if self.escape else " "
            plain = text.replace(" ", sign)
            at = np.empty(len(text) + 1, np.int64)
            at[0] = 0
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64), out=at[1:])
            if self.dummy and not self.space_last:
                return sign + plain, np.concatenate([at[:1], at])
            if self.dummy:
                return plain + sign, np.append(at, at[-1])
            return plain, at
        return self._mapped(text)

    def _replaced(self, text: str) -> Iterator[tuple[str, int, int]]:
        """What each stretch of the text becomes, with its first byte and its size in bytes."""
        data, openers = text.encode(), self.map.openers
        at = byte = 0
        while at < len(text):
            opener = openers.search(text, at) if openers else None
            stop = opener.start() if opener else len(text)
            for char in text[at:stop]:
                size = len(char.encode())
                yield char, byte, size
                byte += size
            at = stop
            if opener:
                size, to = self.map.longest(data, byte) or (len(text[at].encode()), text[at])
                yield to, byte, size
                at += len(data[byte : byte + size].decode())
                byte += size

    def _mapped(self, text: str) -> tuple[str, np.ndarray]:
        sign = SPACE if self.escape else " "
        chars: list[str] = []
        starts: list[int] = []
        after_space, end, begun = self.trim, 0, False
        for to, byte, size in self._replaced(text):
            if not begun and self.trim and to == " ":
                continue
            if not begun and self.dummy and not self.space_last:
                chars.append(sign)
                starts.append(byte)
            begun = True
            if after_space:
                to = to.lstrip(" ")
            if to:
                chars += to.replace(" ", sign)
                starts += [byte] * len(to)
                after_space = self.trim and to.endswith(" ")
            end = byte + size
        if not begun:
            return "", np.zeros(1, np.int64)
        if self.trim:
            while chars and chars[-1] == sign:
                end = starts.pop()
                chars.pop()
        if self.dummy and self.space_last:
            chars.append(sign)
            starts.append(end)
        return "".join(chars), np.array([*starts, end], np.int64)

    # --- encoding -----------------------------------------------------------------------------------

    def merged(self, cut: str) -> list[str]:
        """The parts of a cut after all merges, the best score first, of equal ones the leftmost."""
        return self._merged_short(cut) if len(cut) <= KEPT_CHARS else self._merged_long(cut)

    def _merged_short(self, cut: str) -> list[str]:
        """By looking all pairs over each time, which is faster for a few."""
        parts, cost = list(cut), self.cost.get
        costs = [cost(cut[k : k + 2], NEVER) for k in range(len(cut) - 1)]
        while costs and (low := min(costs)) < NEVER:
            k = costs.index(low)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del costs[k]
            if k < len(costs):
                costs[k] = cost(parts[k] + parts[k + 1], NEVER)
            if k:
                costs[k - 1] = cost(parts[k - 1] + parts[k], NEVER)
        return parts

    def _merged_long(self, cut: str) -> list[str]:
        """By a heap over linked parts, in n log n steps."""
        n, cost = len(cut), self.cost.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # links between parts; end 0: no part starts here
        heap = [(c, i, i + 2) for i in range(n - 1) if (c := cost(cut[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, left, stop = heappop(heap)
            middle = end[left]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two parts has changed since
            end[left], end[middle] = stop, 0
            if stop < n:
                before[stop] = left
                if (c := cost(cut[left : end[stop]])) is not None:
                    heappush(heap, (c, left, end[stop]))
            if (first := before[left]) >= 0 and (c := cost(cut[first:stop])) is not None:
                heappush(heap, (c, first, stop))
        parts, at = [], 0
        while at < n:
            parts.append(cut[at : end[at]])
            at = end[at]
        return parts

    def coded(self, cut: str) -> bytes:
        """Ids of a cut, and how many of its characters each one ends: pairs of 32-bit numbers."""
        pairs: list[int] = []
        for part in self.merged(cut):
            known = self.ids.get(part)
            if known is not None:
                pairs += known, len(part)
            elif self.byte_fallback:
                # The last byte stands for the character, the others for nothing.
                raw = part.encode()
                for k, byte in enumerate(raw, 1):
                    pairs += self.bytes[byte], len(part) if k == len(raw) else 0
            elif len(pairs) > 1 and pairs[-2] == self.unknown:
                pairs[-1] += len(part)  # unknown neighbours are one piece
            else:
                pairs += self.unknown, len(part)
        return pack(f"={len(pairs)}i", *pairs)

    def _remembered(self, cut: str) -> bytes:
        """:meth:`coded`, from one of two generations of cuts; the older one goes when the newer one is full."""
        found = self.kept_before.get(cut) or self.coded(cut)
        if len(cut) <= KEPT_CHARS:
            if len(self.kept) >= KEPT:
                self.kept_before, self.kept = self.kept, {}
            self.kept[cut] = found
        return found

    def cuts(self, plain: str) -> list[str]:
        """Normalised text in parts that no merge crosses."""
        if not plain:
            return []
        number = self.numbers[np.frombuffer(plain.encode("utf-32-le"), np.uint32)]
        borders = (np.flatnonzero(~self.side_by_side[number[:-1] * self.width + number[1:]]) + 1).tolist()
        return [plain[a:b] for a, b in zip([0, *borders], [*borders, len(plain)], strict=True)]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces of a text, and the first and last (exclusive) byte of the text each one stands for."""
        plain, at = self.normalised(text)
        cuts = self.cuts(plain)
        found = list(map(self.kept.get, cuts))
        if None in found:
            found = [known or self.kept.get(cut) or self._remembered(cut) for known, cut in zip(found, cuts, strict=True)]
        pairs = np.frombuffer(b"".join(found), np.int32).reshape(-1, 2)
        if not self.byte_fallback and len(cuts) > 1:
            pairs = self._joined_unknown(pairs)
        ends = np.cumsum(pairs[:, 1], dtype=np.int64)
        return pairs[:, 0], at[ends - pairs[:, 1]], at[ends]

    def _joined_unknown(self, pairs: np.ndarray) -> np.ndarray:
        same = (pairs[1:, 0] == self.unknown) & (pairs[:-1, 0] == self.unknown)
        if not same.any():
            return pairs
        first = np.flatnonzero(np.append(True, ~same))
        return np.stack([pairs[first, 0], np.add.reduceat(pairs[:, 1], first)], axis=1)

    # --- decoding -----------------------------------------------------------------------------------

    @cached_property
    def surfaces(self) -> list[bytes]:
        """The bytes of each id: none for a control piece, one for a byte piece, else the text with blanks."""

        def surface(piece: str, kind: int) -> bytes:
            if kind == CONTROL:
                return b""
            if kind == BYTE:
                return bytes([int(piece[3:5], 16)])
            return self.unknown_surface.encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()

        return [surface(p, k) for p, k in zip(self.pieces, self.kinds, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; raises for an id that is not in the vocabulary.

        A blank that opens the first piece goes where encoding puts one there.  Bytes that are no UTF-8 become
        one replacement character each.
        """
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.pieces):
            raise ValueError("an id is not in the vocabulary")
        ids = ids.tolist()
        parts = list(map(self.surfaces.__getitem__, ids))
        if self.dummy or self.trim:
            for k, at in enumerate(ids):
                if self.kinds[at] == NORMAL and self.pieces[at].startswith(SPACE):
                    parts[k] = parts[k][1:]
                    if parts[k] or not self.trim:
                        break
                elif parts[k]:
                    break
        if self.controls.isdisjoint(ids[1:-1]):  # else one may part bytes that would go together
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._patched(ids, parts)

    def _patched(self, ids: list[int], parts: list[bytes]) -> str:
        text, run = [], b""
        for k, part in [*zip(ids, parts, strict=True), (None, b"")]:
            if k is not None and self.kinds[k] == BYTE:
                run += part
                continue
            while run:
                size = next((n for n in (1, 2, 3, 4) if _is_character(run[:n])), 0)
                text.append(run[:size].decode() if size else REPLACEMENT)
                run = run[size or 1 :]
            text.append(part.decode())
        return "".join(text)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


def read_model(path: str) -> Model:
    with open(path, "rb") as file:
        return Model(file.read())


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.empty(0, np.int32)))


def in_bounds(values: Iterable[tuple], size) -> Iterator[list[tuple]]:
    """The values in lists of bounded size in all."""
    part, room = [], HANDED
    for value in values:
        part.append(value)
        room -= size(value)
        if room <= 0:
            yield part
            part, room = [], HANDED
    if part:
        yield part


def encode(docs: DataFrame, model: Model, text: str = "text", bos: bool = False, eos: bool = True) -> DataFrame:
    """``docs`` with ``token_ids``, ``starts`` and ``ends``: ids of each whole text and the bytes of the text each one stands for.

    A null text counts as empty.  Marks of the begin and the end stand for no bytes.  A piece that is only
    the space sign put before the text stands for none either, and of a character in byte pieces the last
    one stands for it.  Repeated rows stay; other columns are carried along, but for those of the three names.
    A worker holds one Arrow batch of texts and the ids of about ``HANDED`` pieces, or of one text if it has more.
    """
    docs = without(docs, ["token_ids", "starts", "ends", "_pieces"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def of_one(line: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = shared.value
        ids, starts, ends = own.encode(line)
        last = ends[-1:] if len(ends) else np.zeros(1, np.int64)
        first = [own.bos] * bos
        mark = [own.eos] * eos
        return (
            np.concatenate([first, ids, mark]).astype(np.int32),
            np.concatenate([[0] * bos, starts, last[: len(mark)]]).astype(np.int32),
            np.concatenate([[0] * bos, ends, last[: len(mark)]]).astype(np.int32),
        )

    @F.arrow_udf("struct<token_ids: array<int>, starts: array<int>, ends: array<int>>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in in_bounds((of_one(line.as_py()) for line in batch), lambda v: len(v[0])):
                yield pa.StructArray.from_arrays([_lists(list(v)) for v in zip(*part, strict=True)], ["token_ids", "starts", "ends"])

    found = docs.withColumn("_pieces", coded(F.coalesce(F.col(text), F.lit(""))))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return found.select(*kept, *[F.col(f"_pieces.{n}").alias(n) for n in ("token_ids", "starts", "ends")])


def decode(docs: DataFrame, model: Model, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with ``out``, the text that the ids stand for; null for null, an error for an id outside the vocabulary."""
    docs = without(docs, [out])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            read = ((None if b is None else shared.value.decode(np.asarray(b, np.int64)),) for b in batch)
            for part in in_bounds(read, lambda v: len(v[0] or "")):
                yield pd.Series([v[0] for v in part], dtype=object)

    return docs.withColumn(out, texts(F.col(ids)))
