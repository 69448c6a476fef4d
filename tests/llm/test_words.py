"""Sentence pieces against the public library; spelling variants against all pairs."""

import random
from collections import defaultdict
from struct import pack

import numpy as np
import pytest

from footfall.llm import pieces, variants
from footfall.sources.staging import Staging


@pytest.fixture(scope="module")
def public():
    pytest.importorskip("sentencepiece")
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def double_array(keys):
    """A character map: the trie of ``keys`` (bytes to replacement) in the format of the public library, by first fit."""
    places, texts = {}, b""
    for key, to in keys.items():
        places[key] = len(texts)
        texts += to.encode() + b"\0"
    units, used = {0: 0}, {0}

    def place(at, prefix):
        below = sorted({k[len(prefix)] for k in keys if k.startswith(prefix) and len(k) > len(prefix)})
        labels = ([0] if prefix in keys else []) + below
        base = next(b for b in range(1, 1 << 20) if not {b ^ c for c in labels} & used and b ^ at < 1 << 21)
        used.update(b for b in (base ^ c for c in labels))
        units[at] = units.get(at, 0) | (base ^ at) << 10 | (256 if prefix in keys else 0)
        if prefix in keys:
            units[base] = 1 << 31 | places[prefix]
        for c in below:
            units[base ^ c] = c
            place(base ^ c, prefix + bytes([c]))

    place(0, b"")
    size = (max(units) // 256 + 2) * 256
    array = pack(f"<{size}I", *[units.get(k, 0x80000000) for k in range(size)])
    return pack("<I", len(array)) + array + texts


def varint(n):
    return bytes([n]) if n < 128 else bytes([n & 127 | 128]) + varint(n >> 7)


def field(number, value):
    return varint(number << 3) + varint(value) if isinstance(value, int) else varint(number << 3 | 2) + varint(len(value)) + value


def remade(path, normaliser, trainer=()):
    """The public model with other rules of normalisation, and some fields of its trainer replaced."""
    out = b""
    with open(path, "rb") as file:
        for number, value in pieces.message_fields(file.read()):
            if number == 1:
                out += field(1, value)
            elif number == 2:
                kept = b"".join(_raw(value, {n for n, _ in trainer}))
                out += field(2, kept + b"".join(field(n, v) for n, v in trainer))
    return out + field(3, b"".join(field(n, v) for n, v in normaliser))


def _raw(data, without):
    at = 0
    while at < len(data):
        start = at
        key, at = pieces._varint(data, at)
        if key & 7 == 0:
            _, at = pieces._varint(data, at)
        elif key & 7 == 2:
            size, at = pieces._varint(data, at)
            at += size
        else:
            at += {1: 8, 5: 4}[key & 7]
        if key >> 3 not in without:
            yield data[start:at]


SIGNS = ["a", "b", "the ", " ", "  ", "▁", "\n", "\t", "é", "é", "ﬁ", "Ａ", "漢字", "の", "😀", "\0", "<s>", "0x41", ".", "ing"]


def made_up(seed, n=400):
    rng = random.Random(seed)
    return ["", " ", "   ", "▁", "word " * 3000, "x" * 5000, "漢" * 700, *["".join(rng.choice(SIGNS) for _ in range(rng.randrange(25))) for _ in range(n)]]


MAP = {"é".encode(): "e", "é".encode(): "E!", "ﬁ".encode(): "fi", "Ａ".encode(): "A", b"\t": " ", b"\n": " ", "の".encode(): "", b"ab": "ba", b"abb": " ", "字".encode(): " x "}


@pytest.mark.parametrize("kind", ["public", "mapped", "trimmed", "no sign before", "no bytes"])
def test_ids_spans_and_texts_equal_the_library(public, kind):
    import sentencepiece

    map_ = double_array(MAP)
    data = {
        "public": lambda: open(public, "rb").read(),
        "mapped": lambda: remade(public, [(2, map_), (3, 1), (4, 0), (5, 1)]),
        "trimmed": lambda: remade(public, [(2, map_), (3, 1), (4, 1), (5, 1)]),
        "no sign before": lambda: remade(public, [(2, map_), (3, 0), (4, 0), (5, 1)]),
        "no bytes": lambda: remade(public, [(3, 1), (4, 0), (5, 1)], [(35, 0)]),
    }[kind]()
    if kind == "no bytes":
        # Without the fallback the library wants no byte pieces either.
        data = b"".join(field(n, v if n != 1 or dict(pieces.message_fields(v)).get(3) != pieces.BYTE else _without_kind(v)) for n, v in pieces.message_fields(data))
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Model(data)
    for text in made_up(1):
        ids, starts, ends = own.encode(text)
        assert ids.tolist() == library.encode(text), text
        assert own.decode(ids.astype(np.int64)) == library.decode(ids.tolist()), text
        if kind != "no bytes":
            found = library.encode(text, return_type="proto").pieces
            assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in found], text


def _without_kind(piece):
    return b"".join(_raw(piece, {3}))


def test_decoding_of_any_ids(public):
    import sentencepiece

    library, own, rng = sentencepiece.SentencePieceProcessor(model_file=public), pieces.read_model(public), random.Random(2)
    for _ in range(1500):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), rng.randrange(32000), 259, 29871]) for _ in range(rng.randrange(8))]
        assert own.decode(np.array(ids, np.int64)) == library.decode(ids), ids
    for bad in (-1, 32000):
        with pytest.raises(ValueError, match="vocabulary"):
            own.decode(np.array([bad]))


def test_pieces_of_a_table(spark, public, monkeypatch):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=public), pieces.read_model(public)
    texts = [None, "", "same", "same", "é " * 40_000, *made_up(3, 50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'taken' as Token_IDS", "1 as more")
    monkeypatch.setattr(pieces, "HANDED", 50)
    rows = pieces.decode(pieces.encode(docs, own, bos=True), own).collect()
    assert len(rows) == len(texts) and rows[0].asDict().keys() == {"doc_id", "text", "more", "token_ids", "starts", "ends", "decoded"}
    for r in rows:
        text = r["text"] or ""
        assert r["token_ids"] == library.encode(text, add_bos=True, add_eos=True)
        assert r["decoded"] == library.decode(r["token_ids"])
        raw = text.encode()
        # Together the pieces are the text, in order.
        assert b"".join(raw[a:b] for a, b in zip(r["starts"], r["ends"], strict=True)) == raw
    assert pieces.encode(docs.limit(0), own).collect() == []


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[at:] == b[at + 1 :] if len(a) < len(b) else a[at + 1 :] == b[at + 1 :]


def by_hand(counts, factor=5):
    words = sorted(counts)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    best = {w: min(near[w], key=lambda x: (-counts[x], x), default=None) for w in words}
    form = {w: b if b is not None and counts[b] >= factor * counts[w] else None for w, b in best.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in words)


@pytest.mark.parametrize(("signs", "n"), [("ab", 250), ("abcé", 400), ("abcdefghijklmnop", 300)])
def test_variants_equal_all_pairs(spark, signs, n):
    """Few letters make many repeated grams and long chains of neighbours."""
    rng = random.Random(len(signs))
    words = {"".join(rng.choice(signs) for _ in range(rng.randrange(6, 10))) for _ in range(n)}
    for w in list(words)[: n // 3]:
        k = rng.randrange(len(w))
        words |= {w[:k] + rng.choice(signs) + w[k + 1 :], w[:k] + rng.choice(signs) + w[k:], w[:k] + w[k + 1 :]}
    counts = {w: rng.choice([5, 6, 30, 200, 5000]) for w in words if len(w) >= 6}
    table = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = variants.variant_forms(table, Staging(spark)).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(tuple(r) for r in found.collect()) == by_hand(counts)


def test_words_of_texts(spark):
    texts = ["Gardens garden, GARDEN gardén? " * 5 + "x" * 100_000, None, "", "gardens " * 30, "1 2 3"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "gardens")], "doc_id bigint, text string").selectExpr("*", "'taken' as word", "1 as n")
    words = variants.words_with_slips(docs, every=10**10)
    rows = {r["word"]: r for r in variants.group_variants(words, Staging(spark)).collect()}
    assert {w: (r["n"], r["form"], r["root"]) for w, r in rows.items()} == {
        "gardens": (36, None, "gardens"), "garden": (10, None, "garden"), "gardén": (5, None, "gardén"),
    }
    assert [rows[w]["n_near"] for w in ("gardens", "garden", "gardén")] == [1, 2, 1]
    slipped = variants.words_with_slips(docs, every=1)
    assert {len(r["word"]) for r in slipped.filter("word not like '%xx%'").collect()} == {6, 5}
    assert variants.group_variants(words.limit(0), Staging(spark)).collect() == []


def test_pivots_are_the_cheapest_that_do_not_overlap():
    rng = random.Random(6)
    order = defaultdict(int, {a + b: rng.randrange(9) for a in "abc" for b in "abc"})
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randrange(variants.LEAST_CHARS, 12)))
        prefix = variants.prefix_of(word, order)
        (g, i), (h, j) = variants.pivots_of(prefix)
        assert abs(i - j) >= 2 and {(g, i), (h, j)} <= {(gram, at) for (_, gram), at in prefix}
        cheapest = min(p[0][0] + q[0][0] for p in prefix for q in prefix if q[1] - p[1] >= 2)
        assert order[g] + order[h] == cheapest
    with pytest.raises(ValueError):
        variants.pivots_of(variants.prefix_of("abc", order))
