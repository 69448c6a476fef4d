import random
from collections import defaultdict

import pytest

from footfall.operators.attribution import MODEL, STRATEGY, event_lists, event_segments, linear_weights, ordered_events
from helpers import ordered, plan, rows

SCHEMA = "guid bigint, timeStamp bigint, eventId string"
USERS = {1: "abbTacTc", 2: "aTT", 3: "a", 4: "T"}


def events_of(spark, users):
    data = [(guid, ts, event) for guid, text in users.items() for ts, event in enumerate(text)]
    return spark.createDataFrame(data, SCHEMA)


def weights(spark, users, **options):
    segments = event_segments(events_of(spark, users), "T", ("a", "b", "c"))
    got = linear_weights(segments, "T", **options)
    return ordered((r["guid"], r["attr_event"], round(r["weight"], 6)) for r in got.collect())


THIRD = round(100 / 3, 6)


def test_segments_and_weights(spark):
    converted = [(1, "a", THIRD), (1, "b", THIRD), (1, "b", THIRD), (1, "a", 50.0), (1, "c", 50.0), (2, "a", 100.0)]
    assert weights(spark, USERS) == ordered([*converted, (1, "c", 100.0), (3, "a", 100.0)])
    assert weights(spark, USERS, converted_only=True) == ordered(converted)


def test_labels_and_untracked_events(spark):
    segments = event_segments(events_of(spark, {5: "x"}).union(spark.createDataFrame(
        [(6, 1, "goodsView"), (6, 2, "other"), (6, 3, "fetchCoupon"), (None, 4, "adShow")], SCHEMA)))
    assert rows(linear_weights(segments)) == [(MODEL, STRATEGY, 6, "fetchCoupon", "goodsView", 100.0)]


def walked(users_events):
    """Walk over each user's events and close a segment at every target and at the end."""
    out = []
    for guid, events in users_events.items():
        touched = []
        for _, name in [*sorted(events), (None, "T")]:
            if name != "T":
                touched.append(name)
                continue
            out += [(guid, n, round(100 / len(touched), 6)) for n in touched]
            touched = []
    return ordered(out)


@pytest.mark.parametrize("seed, span", [(0, 200_000), (1, 200_000), (2, 20_000_000), (3, 900)])
def test_equals_a_walk_with_one_hot_user(spark, sketched, seed, span):
    """Over minutes, hours, and in a burst shorter than a cell."""
    rng = random.Random(seed)
    users = defaultdict(list)
    for _ in range(800):
        users[0 if rng.random() < 0.4 else rng.randrange(1, 20)].append((rng.randrange(-span // 2, span), rng.choice("aabbcT")))
    data = [(guid, ts, name) for guid, events in users.items() for ts, name in events]
    segments = event_segments(spark.createDataFrame(data, SCHEMA), "T", ("a", "b", "c"))
    got = [(r["guid"], r["attr_event"], round(r["weight"], 6)) for r in linear_weights(segments, "T").collect()]
    assert ordered(got) == walked(users)


def test_lists_come_in_order_and_whole(spark):
    rng = random.Random(1)
    data = [(g, rng.randrange(500, 40_000), rng.choice(["a_1", "b"])) for g in (1, 1, 1, 1, 2) for _ in range(50)]
    got = defaultdict(list)
    for row in sorted(event_lists(spark.createDataFrame(data, SCHEMA), part_size=30).collect(), key=lambda r: (r["guid"], r["part"])):
        assert len(row["events"]) <= 30
        got[row["guid"]] += row["events"]
    for guid in (1, 2):
        assert got[guid] == [f"{ts}_{e}" for g, ts, e in sorted(data) if g == guid]


def test_positions(spark):
    df = spark.createDataFrame([(1, 1000, "b"), (1, 999, "z"), (1, 1000, "a"), (2, 5, "q")], SCHEMA)
    assert rows(ordered_events(df), "guid", "position", "eventId") == [(1, 1, "z"), (1, 2, "a"), (1, 3, "b"), (2, 1, "q")]


def test_a_hot_segment_is_split_by_the_plan(spark):
    data = spark.createDataFrame([(1, 5, "a"), (1, 6, "T")], SCHEMA)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(linear_weights(event_segments(data, "T", ("a",)), "T"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = [part for part in text.split("\n\n") if ") SortMergeJoin" in part and "segment" in part]
    assert joins and all("_cell" in line for part in joins for line in part.split("\n") if " keys [" in line)
    # What meets in a window of a whole segment or user is one summary row per cell or block.
    for part in text.split("\n\n"):
        if ") Window" in part and "_cell" not in part.split("Arguments")[1].split("],")[1]:
            assert "eventId" not in part
