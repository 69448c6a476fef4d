"""URL filter: host rules, and pattern rules that are found by their rarest literal token.

Patterns are written as in public filter lists: ``||`` the start of a host or of one of its parents, ``|`` the
start or end of the url, ``*`` anything, ``^`` one sign that is no letter, digit or ``_-.%``, or the end; a leading
``@@`` allows.  Patterns look at the url in lower case (A-Z).

A whole word of a pattern (letters and digits with other signs around) must be a word of every url it matches.  Each rule is
filed under the one of its words that is rarest among the urls at hand; the words of a url fetch the rules filed under them, and
only those run their regular expression.  Rules without a whole word run on every url.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.tables import fields, without

WORD = re.compile(r"[a-z0-9]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RESULTS = ("host", "path", "rule", "verdict")


@dataclass(frozen=True)
class HostRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def expression(pattern: str) -> str:
    """The regular expression of a pattern, without ``@@``; simple enough for any engine."""
    body, head, tail = pattern.removeprefix("@@"), "", ""
    if body.startswith("||"):
        body, head = body[2:], r"^[a-z][a-z0-9+.-]*://([^/?#]*\.)?"
    elif body.startswith("|"):
        body, head = body[1:], "^"
    if body.endswith("|"):
        body, tail = body[:-1], "$"
    signs = {"*": r"[\s\S]*", "^": r"([^a-z0-9_.%-]|$)"}
    return head + "".join(signs.get(c) or re.escape(c) for c in body) + tail


def whole_words(pattern: str) -> list[str]:
    """Words that every url the pattern matches has as a whole word."""
    body = pattern.removeprefix("@@")
    opened, closed = body.startswith("|"), body.endswith("|")
    body = body.strip("|")
    found = []
    for m in WORD.finditer(body):
        before = body[m.start() - 1] if m.start() else "|" if opened else "*"
        after = body[m.end()] if m.end() < len(body) else "|" if closed else "*"
        if before != "*" and after != "*":
            found.append(m.group())
    return found


class Index:
    """Pattern rules by their rarest word."""

    def __init__(self, patterns: Iterable[str], counts: dict[str, int]):
        self.rules: list[tuple[re.Pattern, str]] = []
        self.by_word: dict[str, list[int]] = {}
        self.always: list[int] = []
        for pattern in dict.fromkeys(patterns):
            at = len(self.rules)
            self.rules.append((re.compile(expression(pattern)), "allow" if pattern.startswith("@@") else "block"))
            words = whole_words(pattern)
            if words:
                self.by_word.setdefault(min(words, key=lambda w: (counts.get(w, 0), w)), []).append(at)
            else:
                self.always.append(at)

    def verdict(self, url: str) -> str:
        """``allow`` if an allowing rule matches or no rule does, else ``block``."""
        url = url.translate(LOWER)
        at = [*self.always, *(r for w in set(WORD.findall(url)) for r in self.by_word.get(w, ()))]
        found = {verdict for rule, verdict in map(self.rules.__getitem__, at) if rule.search(url)}
        return "block" if found == {"block"} else "allow"


class Hosts:
    """Host rules by host; the longest that fits wins."""

    def __init__(self, rules: Iterable[HostRule]):
        self.by_host: dict[str, list[HostRule]] = {}
        for rule in rules:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.labels = max((h.count(".") + 1 for h in self.by_host), default=0)

    def find(self, host: str, path: str) -> HostRule | None:
        # Only parents with as many labels as some rule has are looked up, however long the host is.
        labels = host.rsplit(".", self.labels)
        labels = labels[1:] if len(labels) > self.labels else labels
        found = []
        for parent in (".".join(labels[k:]) for k in range(len(labels))):
            found += [r for r in self.by_host.get(parent, ()) if path.startswith(r.path)]
        return max(found, key=lambda r: (len(r.name), r.name), default=None)


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z in lower case) and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :]).group()


def word_counts(pages: DataFrame, words: Sequence[str], url: str = "url") -> dict[str, int]:
    """How many urls have each of the rules' words: as many numbers as the rules have words, whatever the table."""
    wanted = pages.sparkSession.createDataFrame([(w,) for w in sorted(set(words))], "word string")
    lower = F.translate(F.coalesce(F.col(url), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = pages.select(F.explode(F.array_distinct(F.split(lower, "[^a-z0-9]+"))).alias("word"))
    # The words of the rules are a parameter and small.
    return {r["word"]: r["n"] for r in found.join(F.broadcast(wanted), "word").groupBy("word").agg(F.count("*").alias("n")).collect()}


def judge(pages: DataFrame, hosts: Sequence[HostRule], patterns: Sequence[str], url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A host rule decides if one fits, else the patterns do; without any match the verdict is ``allow``.  A null url or one
    without ``://`` has an empty host and path and fits no host rule, but patterns see it.  Very long urls cost as much as they
    are long, however many labels their host has; repeated urls get equal verdicts.  All columns are carried along but those of
    these names.
    """
    index = Index(patterns, word_counts(pages, [w for p in patterns for w in whole_words(p)], url))
    shared = pages.sparkSession.sparkContext.broadcast((Hosts(hosts), index))

    @F.pandas_udf("host string, path string, rule string, verdict string")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known, index = shared.value
        for batch in batches:
            rows = []
            for u in batch:
                host, path = parts(u)
                rule = known.find(host, path)
                rows.append((host, path, rule and rule.name, rule.verdict if rule else index.verdict(u or "")))
            yield pd.DataFrame(rows, columns=list(RESULTS))

    # The address is read before columns of the same names make room.
    found = pages.withColumn("_found", judged(F.col(url)))
    return without(found, RESULTS).select("*", *fields("_found", RESULTS)).drop("_found")
