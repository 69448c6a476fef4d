"""Near-duplicates, Merkle trees, line rules, urls and chats against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from footfall.llm import chat, components, lines, paragraphs, simhash, urls, warc
from footfall.sources.staging import Staging


@pytest.fixture
def stage(spark):
    return Staging(spark)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if w]
    spans = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(prints, ids, radius):
    low = list(range(len(prints)))

    def top(k):
        while low[k] != k:
            k = low[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = sorted((top(a), top(b)))
                low[y] = x
    found = {}
    for k in range(len(prints)):
        found.setdefault(top(k), []).append(ids[k])
    return {i: min(group) for group in found.values() for i in group}


def test_fingerprints_and_classes(spark, stage):
    chance = random.Random(2)
    base = [" ".join(chance.choice("abcdefgh") * 2 for _ in range(120)) for _ in range(12)]
    texts = [None, "", " \n", "One", "one", "A b c", "Ünï CODE ÄÖ wörter hier", *base]
    for text in base:  # near copies, chains of them, and copies
        for _ in range(6):
            words = text.split()
            words[chance.randrange(120)] = "new"
            texts += [" ".join(words), text.upper()]
    rows = simhash.near_duplicates(frame(spark, texts).withColumn("fp", F.lit("taken")), stage).collect()
    expected = [plain_fingerprint(t) for t in texts]
    assert {r["doc_id"]: r["fp"] % 2**64 for r in rows} == dict(enumerate(expected))
    assert {r["doc_id"]: r["component_id"] for r in rows} == plain_classes(expected, range(len(texts)), simhash.RADIUS)
    assert frame(spark, [""]).select(simhash.hexadecimal(F.lit(10).cast("bigint"))).first()[0] == "000000000000000a"


@pytest.mark.parametrize("tile", [1, 3, 4096])
def test_tiles_lose_no_link(spark, stage, tile):
    chance = np.random.default_rng(tile)
    centres = chance.integers(-(2**63), 2**63 - 1, 30)
    prints = {int(c) for c in centres} | {0, -1}
    for c in centres:
        for _ in range(20):
            flips = chance.choice(64, chance.integers(1, 7), replace=False)
            prints.add(int(np.int64(c) ^ np.bitwise_or.reduce(np.int64(1) << flips.astype(np.int64))))
    prints = sorted(prints)
    found = components.components(simhash.near_links(spark.createDataFrame([(p,) for p in prints], "fp bigint"), tile=tile), stage)
    roots = {r["key"]: r["root"] for r in found.collect()}
    unsigned = [p % 2**64 for p in prints]
    expected = plain_classes(unsigned, list(range(len(prints))), simhash.RADIUS)
    mine = [roots.get(p, p) for p in prints]
    assert all((mine[a] == mine[b]) == (expected[a] == expected[b]) for a in range(len(prints)) for b in range(a))


def test_components_of_chains_and_stars(spark, stage):
    links = [(k, k + 1) for k in range(100)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    roots = {r["key"]: r["root"] for r in components.components(spark.createDataFrame(links, "a bigint, b bigint"), stage).collect()}
    assert {roots[k] for k in range(101)} == {0} and {roots[k] for k in range(500, 560)} == {500} and roots[901] == 900 and len(roots) == 163
    assert components.components(spark.createDataFrame([], "a bigint, b bigint"), stage).count() == 0


def test_one_of_each(spark, stage):
    same = "a b c d e f g h"
    rows = [(4, same), (2, same), (2, same), (None, same), (None, "alone here"), (9, None), (8, "")]
    kept = simhash.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("own")), stage)
    assert kept.columns == ["doc_id", "text", "fp"]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(2, same), (None, "alone here"), (8, "")], key=str)
    assert simhash.one_of_each(kept.limit(0), stage).count() == 0


def tree_of(text):
    """Root, sections, paragraphs and leaves by hand: lists of digests, and how many of the next level each has."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    n = paragraphs.FINE
    pieces = [re.findall(paragraphs.FINE_PATTERN, line[:n]) + re.findall(paragraphs.LEAF_PATTERN, line[n:]) for line in text.split("\n")]
    assert ["".join(p) for p in pieces] == text.split("\n")
    leaves = [[md5(leaf) for leaf in p] for p in pieces]
    lines = [md5("".join(p)) for p in leaves]
    sections, start = [], 0
    for k, digest in enumerate(lines):
        if digest[0] in "0123" or k + 1 == len(lines):
            sections.append((md5("".join(lines[start : k + 1])), k + 1 - start))
            start = k + 1
    root = md5("".join(d for d, _ in sections))
    return root, [(d[:10], n) for d, n in sections], [(d[:10], len(p)) for d, p in zip(lines, leaves, strict=True)], [d[:6] for p in leaves for d in p]


def without_ends(one, two):
    front = next((k for k, (a, b) in enumerate(zip(one, two, strict=False)) if a != b), min(len(one), len(two)))
    back = 0
    while back < min(len(one), len(two)) - front and one[-1 - back] == two[-1 - back]:
        back += 1
    return front, back


def descended(one, two):
    """Likeness and the places of changed paragraphs, level by level."""
    (r1, s1, p1, l1), (r2, s2, p2, l2) = one, two
    if r1 == r2:
        return 1.0, ([], [])
    front, back = without_ends(s1, s2)
    before = sum(n for _, n in s1[:front])
    m1, m2 = (p[before : len(p) - sum(n for _, n in s[len(s) - back :])] for s, p in ((s1, p1), (s2, p2)))
    front, back = without_ends(m1, m2)
    skipped = before + front
    rest = [m[front : len(m) - back] for m in (m1, m2)]
    starts = [sum(n for _, n in p[:skipped]) for p in (p1, p2)]
    c1, c2 = (leaves[at : at + sum(n for _, n in r)] for leaves, at, r in zip((l1, l2), starts, rest, strict=True))
    front, back = without_ends(c1, c2)
    shared = sum((Counter(c1[front : len(c1) - back]) & Counter(c2[front : len(c2) - back])).values())
    total = len(l1) + len(l2)
    near = 2 * (len(l1) - len(c1) + front + back + shared) / total if total else 0.0
    places = []
    for mine, other in (rest, rest[::-1]):
        left, found = Counter(d for d, _ in other), []
        for k, (d, _) in enumerate(mine):
            left[d] -= 1
            if left[d] < 0:
                found.append(skipped + k + 1)
        places.append(found)
    return near, (places[0], places[1])


def made_up_texts():
    rng = random.Random(8)
    words = ["river", "old", "mill", "the", "ran", "quiet,", "years.", "a", "Gärten", "0x3f9c20a1", "12;34;56", "漢字の混じった文章、", "한국어", "\u2028", "🙂"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(40)]
    texts = ["", "one line", "x" * 3000, "漢字かな交じり文" * 90, "deadbeef0192" * 200, "\n\n\n"]
    for _ in range(10):
        own = [rng.choice(lines) for _ in range(rng.randrange(1, 60))]
        moved = own[:]
        rng.shuffle(moved)
        k = rng.randrange(len(own))
        texts += ["\n".join(t) for t in (own, moved, own + own[:3], own[:k] + own[k + 1 :], own[:k] + [own[k] + " more"] + own[k + 1 :], own[: k + 1] + [own[k]] + own[k + 1 :])]
    return texts


def test_fingerprints_and_descent_equal_those_by_hand(spark):
    """Texts of several scripts; lines moved, repeated, dropped and changed; each against the six before and after it."""
    texts = made_up_texts()
    trees = [tree_of(t) for t in texts]
    rows = frame(spark, texts).withColumn("fp", paragraphs.fingerprint(F.col("text")))
    for r in rows.collect():
        root, sections, lines, leaves = trees[r["doc_id"]]
        told = "|".join([root, *(",".join(f"{d}.{n}" for d, n in level) for level in (sections, lines)), ",".join(leaves)])
        assert r["fp"] == told
    other = rows.select(F.col("doc_id").alias("other"), F.col("fp").alias("fp2"))
    pairs = rows.join(other, F.abs(F.col("doc_id") - F.col("other")) <= 6)
    found = pairs.select("doc_id", "other", paragraphs.likeness(F.col("fp"), F.col("fp2")).alias("near"), paragraphs.changed_paragraphs(F.col("fp"), F.col("fp2")).alias("c"))
    for r in found.collect():
        near, (one, two) = descended(trees[r["doc_id"]], trees[r["other"]])
        assert abs(r["near"] - near) < 1e-12 and (sorted(r["c"]["one"]), sorted(r["c"]["two"])) == (one, two), (r, texts[r["doc_id"]], texts[r["other"]])


def test_half_a_text_is_never_unlike(spark):
    """Scripts with and without blanks, tables and digits: half of each text is left as it is."""
    kept = ["The river ran past the old mill and on", "漢字かな交じりの文章が続く。" * 5, "8f3a91bc" * 12, "1;22;333\n4;55;666\n7;88;999\n", "한국어 문장이 여기에 있습니다 " * 4, "поля и леса за рекой " * 4]
    rows = spark.createDataFrame([(k, t + t, t + "#" * len(t)) for k, t in enumerate(kept)], "doc_id bigint, a string, b string")
    near = rows.select("doc_id", paragraphs.likeness(paragraphs.fingerprint(F.col("a")), paragraphs.fingerprint(F.col("b"))).alias("near"))
    assert all(r["near"] > 0.2 for r in near.collect())


def test_changed_places(spark):
    texts = ["One.\nTwo.\nTwo.\n\nFive!", "One.\nTwo.\n\nFive!", "One.\nOther.\nTwo.\n\nFive!", None, ""]
    rows = frame(spark, texts).withColumn("fp", paragraphs.fingerprint(F.col("text")))
    pairs = rows.crossJoin(rows.select(F.col("doc_id").alias("other"), F.col("fp").alias("fp2")))
    found = {
        (r["doc_id"], r["other"]): r
        for r in pairs.select("doc_id", "other", paragraphs.likeness(F.col("fp"), F.col("fp2")).alias("near"), paragraphs.changed_paragraphs(F.col("fp"), F.col("fp2")).alias("c")).collect()
    }
    assert (found[0, 1]["c"]["one"], found[0, 1]["c"]["two"]) == ([3], []) and 0.5 < found[0, 1]["near"] < 1
    assert (found[0, 2]["c"]["one"], found[0, 2]["c"]["two"]) == ([2], [2])
    assert found[3, 4]["near"] == found[0, 0]["near"] == 1.0 and found[0, 0]["c"]["one"] == [] and found[0, 4]["near"] == 0.0


@pytest.mark.parametrize("ids", [[5], [3, 1, 2], [None, 7, None, 3], [4] * 9, [k * k * 1_000_003 % 99_991 for k in range(3000)]])
def test_next_document(spark, ids):
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id bigint, text string")
    found = paragraphs.with_next(docs, ["doc_id", "text"]).collect()
    digests = {r["text"]: r["d"] for r in docs.select("text", F.xxhash64("text").alias("d")).collect()}
    order = sorted(((i is not None, i or 0, digests[f"t{k}"]), f"t{k}") for k, i in enumerate(ids))
    expected = {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}
    assert {r["text"]: r["next_text"] for r in found} == expected and len(found) == len(ids)
    assert paragraphs.with_next(docs.limit(0), ["text"]).count() == 0


def test_edited_text(spark):
    pairs = spark.createDataFrame([("abcde", "XYZ", "abcXY"), ("ab🙂d", "Q", "abQ"), ("", "x", ""), ("a", "x", "a")], "a string, b string, e string")
    assert pairs.filter(~paragraphs.edited(F.col("a"), F.col("b")).eqNullSafe(F.col("e"))).count() == 0


def test_line_rules(spark, stage):
    chance = random.Random(4)
    shared, rows = "All rights reserved by us", []
    for k in range(60):
        own = "\n".join(" ".join(f"w{chance.randrange(10**6)}" for _ in range(12)) for _ in range(5))
        rows.append((k, own + ("\n" + "  ALL rights\treserved by us" if k % 2 else ""), "a"))
    rows += [(100 + k, "\n".join([shared] * 12 + [f"own{k} x"]), "a") for k in range(30)]
    rows += [(200, None, None), (201, "", None), (202, "x " * 300, None), (203, "long" * 50_000, "a"), (203, "long" * 50_000, "a")]
    rows += [(300 + k, "same text " + " ".join(map(str, range(60))), "b") for k in range(200)]  # copies are one document
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("Kept", F.lit("taken"))
    found = {r["doc_id"]: r for r in lines.judge(docs, stage).collect()}
    assert all(found[k]["kept"] and (found[k]["removed_share"] > 0) == bool(k % 2) for k in range(60))
    # 30 texts that repeat one line fail the base rule; the rest of the rules still sees what they lose.
    assert all(found[100 + k]["removed_share"] > 0.9 and not found[100 + k]["kept"] and found[100 + k]["n_dup_lines"] == 11 for k in range(30))
    assert all(found[300 + k]["kept"] for k in range(200))
    assert found[202]["base_failed"] and found[202]["n_repeat_words"] == 300 and not found[200]["kept"] and found[200]["n_words"] == 0
    assert lines.judge(docs.limit(0), stage).count() == 0
    texts = {r["doc_id"]: r for r in lines.without_boilerplate(docs, stage).collect()}
    assert all(texts[k]["cleaned"] == texts[k]["text"].split("\n  ALL")[0] for k in range(60))
    assert texts[100]["cleaned"] == "own0 x" and texts[200]["cleaned"] == "" and texts[203]["cleaned"] == texts[203]["text"]
    assert set(texts[0].asDict()) == {"doc_id", "text", "source", "Kept", "cleaned", "removed_share"}


def lines_by_hand(rows, limits):
    """Cleaned texts, from counts over distinct (host, text)."""
    def norm(line):
        return " ".join(re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).split(" ")).strip(" ")

    distinct = {(h, t or "") for _, t, h in rows}
    counts = Counter((h, x) for h, t in distinct for x in {norm(v) for v in t.split("\n")} if x)
    sizes = Counter(h for h, _ in distinct)
    long = lambda x, n: limits.most is not None and n > limits.most and len(x) >= limits.long_chars
    common = {(h, x) for (h, x), n in counts.items() if n > limits.documents and (n > limits.share * sizes[h] or long(x, n))}
    return sorted((d, "\n".join(v for v in (t or "").split("\n") if (h, norm(v)) not in common)) for d, t, h in rows)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("most", [None, 30])
def test_cleaned_texts_equal_those_by_hand(spark, stage, monkeypatch, broadcast, most):
    if not broadcast:
        monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    chance = random.Random(6)
    shared = ["Read more", " read\tMORE ", "", "  ", "share   this", "a long line " * 20, "rare " + "x" * 300]
    rows = []
    for k in range(400):
        own = [f"own {chance.randrange(300)} words" for _ in range(chance.randrange(3))]
        text = own + [chance.choice(shared[:6]) for _ in range(chance.randrange(5))] + ([shared[6]] if k % 8 == 0 else [])
        chance.shuffle(text)
        rows.append((k, None if k % 97 == 0 else "\n".join(text), None if k % 5 == 0 else "ab"[k % 7 == 0]))
    rows += rows[:30] * 3
    limits = lines.Limits(documents=12, share=0.2, most=most)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = lines.without_boilerplate(docs, stage, limits).select("doc_id", "cleaned").collect()
    assert sorted(tuple(r) for r in found) == lines_by_hand(rows, limits)


def test_repeated_words(spark):
    chance = random.Random(6)
    texts = [" ".join(chance.choice("abc") for _ in range(chance.randrange(40))) for _ in range(60)]
    expected = []
    for text in texts:
        w = text.split()
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        n = Counter(windows)
        expected.append(len({k + j for k, x in enumerate(windows) if n[x] > 1 for j in range(3)}))
    measured = lines.with_base(frame(spark, texts), "text", lines.Limits()).orderBy("doc_id").select("n_repeat_words").collect()
    assert [r[0] for r in measured] == expected


def test_audit_finds_exactly_the_damage(spark, stage):
    records = spark.range(3000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"), (F.col("id") % 50 + 100).alias("length"), "id")
    archive = stage(warc.lay_out(records, file_bytes=100_000), "archive")
    local = sorted((r["file"], r["offset"], r["length"], r["digest"]) for r in archive.collect())
    ends = {}
    for file, offset, length, _ in local:
        assert offset == ends.get(file, 0)
        ends[file] = offset + length
    one = archive.select("file", "offset", "length", "digest")
    two = one.filter("offset % 41 <> 5").withColumn("digest", F.expr("if(offset % 37 = 3, 'bad', digest)"))
    two = two.union(spark.createDataFrame([(0, 10**6, 5, "extra"), (0, 10**6, 5, "extra"), (None, 1, 1, "x")], one.schema))
    found = {(r["file"], r["offset"]): r["status"] for r in warc.audit(one, two, stage, leaf_bytes=1000, fan_out=4).collect()}
    expected = {(f, o): "missing" if o % 41 == 5 else "changed" for f, o, _, _ in local if o % 41 == 5 or o % 37 == 3}
    assert found == {**expected, (0, 10**6): "extra"}
    assert warc.audit(one, one, stage).count() == 0 and warc.audit(one.limit(0), one.limit(0), stage).count() == 0


def test_record_is_well_formed(spark):
    made = spark.range(1).select(warc.record(F.lit(7), F.lit("http://x/\r\ny"), F.lit("hé")).alias("r"), warc.record(F.lit(None).cast("int"), F.lit(None), F.lit(None)).alias("n")).first()
    head, body = bytes(made["r"]).split(b"\r\n\r\n", 1)
    assert head.startswith(b"WARC/1.1\r\n") and b"Content-Length: 3" in head and b"WARC-Target-URI: http://x/y" in head
    assert body == "hé".encode() + b"\r\n\r\n" and b"Content-Length: 0" in bytes(made["n"])


def test_url_index_equals_all_rules():
    chance = random.Random(8)
    patterns = ["||ads.", "/ads/", "-win.", "*casino*", "|http://b", "end|", "^x^", "@@/ads/ok", "a*b/c/", "||b.^/d"]
    index = urls.Index(patterns, {"ads": 9, "c": 1})
    rules = [(re.compile(urls.expression(p)), p.startswith("@@")) for p in patterns]
    pieces = ["http://", "ads", ".", "/", "b", "-win", "casino", "x", "?", "c", "ok", "end", "D", "d", "a", "é"]
    for _ in range(5000):
        url = "".join(chance.choice(pieces) for _ in range(chance.randrange(1, 9)))
        hits = [allowed for rule, allowed in rules if rule.search(url.translate(urls.LOWER))]
        assert index.verdict(url) == ("block" if hits and not any(hits) else "allow"), url


class Counted:
    """A compiled rule that counts how often it runs."""

    def __init__(self, rule, runs):
        self.rule, self.runs = rule, runs

    def search(self, text):
        self.runs[0] += 1
        return self.rule.search(text)


def test_of_thousands_of_rules_few_run_on_a_url():
    """Rules share frequent words; only those filed under a word of the url run, and the verdicts are those of all rules."""
    patterns = [f"||ads{k}.example." for k in range(2000)] + [f"/shop/{k}/banner/" for k in range(2000)] + [f"@@/shop/{k}/help/" for k in range(0, 2000, 9)]
    patterns += [f"?campaign=c{k}&" for k in range(1500)] + [f"/img/a{k}/*.gif|" for k in range(500)]
    chance = random.Random(9)
    made = [
        lambda k: f"http://ads{k}.example.org/x", lambda k: f"https://a.org/shop/{k}/banner/1", lambda k: f"https://a.org/shop/{k}/banner/x/shop/{k}/help/",
        lambda k: f"http://b.net/?campaign=c{k}&x=1", lambda k: f"http://b.net/img/a{k}/zz.gif", lambda k: f"http://c.net/shop/{k}/toys/",
    ]
    found = [chance.choice(made)(chance.randrange(2500)) for _ in range(800)]
    counts = Counter(w for u in found for w in set(urls.WORD.findall(u)))
    index, runs = urls.Index(patterns, counts), [0]
    whole = list(index.rules)
    index.rules = [(Counted(rule, runs), verdict) for rule, verdict in whole]
    verdicts = [index.verdict(u) for u in found]
    always = len(index.always)
    hits = [{v for rule, v in whole if rule.search(u)} for u in found]
    assert verdicts == ["block" if h == {"block"} else "allow" for h in hits] and {"block", "allow"} == set(verdicts)
    assert always == 0 and runs[0] < 4 * len(found) < len(whole) * len(found) / 100


def test_urls_of_all_kinds(spark):
    rules = [urls.HostRule("block", "net", "/"), urls.HostRule("allow", "example.net", "/en/")]
    cases = {
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/casino/": ("", "", None, "block"),
        "http://A.Example.NET/en/x?y": ("a.example.net", "/en/x", "example.net/en/", "allow"), "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "http://net": ("net", "", None, "allow"), "http://xnet/": ("xnet", "/", None, "allow"), "x://net/?a://b/casino/": ("net", "/", "net/", "block"),
        "http://h#/casino/": ("h", "", None, "block"),
    }
    pages = spark.createDataFrame([(u, "taken") for u in cases], "url string, Verdict string")
    found = {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules, ["/casino/"]).collect()}
    assert found == cases and urls.judge(pages.limit(0), rules, []).count() == 0


def tree(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, message_id bigint, parent_id bigint, role string, text string, score double")


def test_reply_trees(spark, stage):
    chance, rows, parents = random.Random(9), [], {}
    for conv in range(6):
        for k in range(1, 60):
            parent = None if k == 1 else k - 1 if chance.random() < 0.7 else chance.randrange(1, k)
            parents[conv, k] = parent
            rows.append((conv, k, parent, "user", f"m{k}", chance.random()))
    scores = {(r[0], r[1]): r[5] for r in rows}
    expected = {}
    for conv in range(6):
        inner, found = {p for (c, _), p in parents.items() if c == conv}, []
        for k in range(1, 60):
            if k not in inner:
                path = [k]
                while parents[conv, path[-1]]:
                    path.append(parents[conv, path[-1]])
                found.append((-sum(scores[conv, m] for m in path), k, path[::-1]))
        expected[conv] = [[f"m{m}" for m in p] for _, _, p in sorted(found)[:2]]
    # A circle, an answer to itself, and one to nothing.
    rows += [(7, 1, 2, "user", "a", 1.0), (7, 2, 1, "user", "b", 1.0), (7, 3, 3, "user", "c", 1.0), (8, 5, 99, "user", "lost", None), (8, None, 5, "user", "no id", 1.0)]
    rows += [(None, 1, None, "user", "null", 0.0), (None, 1, None, "user", "null", 0.0)]
    result = {}
    for r in chat.conversations(tree(spark, rows), stage, best=2).collect():
        result.setdefault((r["conv_id"], r["path"]), {})[r["at"]] = r["text"]
    told = {key: [turns[k] for k in sorted(turns)] for key, turns in result.items()}
    assert told == {**{(c, n + 1): p for c, ps in expected.items() for n, p in enumerate(ps)}, (8, 1): ["lost"], (None, 1): ["null"]}


def test_format_reads_back(spark, stage):
    odd = ["", None, r"\### Assistant: </turn> ok", "</turn>\n<turn assistant>x", "\\", "<", "\\\\<turn", "🙂\n\n", "x" * 100_000]
    turns = [(c, t, "assistant" if (c + t) % 2 else "us<er>\\", text) for c in range(3) for t, text in enumerate(odd)]
    turns += [(5, 1, "user", "twice"), (5, 1, "user", "twice"), (None, 0, None, "alone")]
    turns += [(6, k * 3, "assistant", f"deep {k}") for k in range(300)]
    said = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("path", F.lit("own"))
    done = chat.formatted(chat.conversations(chat.thread(said), stage))
    rows = done.select("conv_id", chat.read_back(F.col("formatted")).alias("turns"), chat.under_mask(F.col("formatted"), F.col("mask")).alias("learned")).collect()
    assert len(rows) == 6
    for row in rows:
        mine = [(r or "", t or "") for c, _, r, t in turns if c == row["conv_id"]]
        assert [(t["role"], t["text"]) for t in row["turns"]] == mine
        assert row["learned"] == "".join(t for r, t in mine if r == "assistant")
    assert chat.formatted(chat.conversations(chat.thread(said.limit(0)), stage)).count() == 0
