"""Manifests, the store in buckets, and the two outputs of the detail job that become visible together."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from footfall.plans import event_detail
from footfall.sources import KeyedStore, Ledger, overwrite_days, read_table, replace_table
from helpers import rows
from test_jobs import LOG_SCHEMA, log_rows

SCHEMA = "kind string, k string, guid bigint"


def made(spark, *data):
    return spark.createDataFrame([(*r, False) if len(r) == 3 else r for r in data], f"{SCHEMA}, _removed boolean")


def store_at(spark, folder, buckets=8):
    return KeyedStore(spark, f"{folder}/store", SCHEMA, ["kind", "k"], buckets)


def test_readers_see_the_newest_manifest_only(spark, folder):
    ledger = Ledger(spark, f"{folder}/ledger")
    assert (ledger.newest(), ledger.read()) == (0, {})
    assert ledger.publish({"a": 1}, 0) == 1 and ledger.read() == {"a": 1}
    assert ledger.publish({"a": 2}, 1) == 2 and (ledger.read(), ledger.read(1), ledger.read(0)) == ({"a": 2}, {"a": 1}, {})
    with pytest.raises(RuntimeError):
        ledger.publish({"a": 3}, 1)
    assert ledger.read() == {"a": 2} and ledger.newest() == 2
    assert sorted(p.name for p in Path(f"{folder}/ledger/_manifests").glob("[!.]*")) == ["000000001.json", "000000002.json"]


def test_store_merges_days_and_a_rerun_changes_nothing(spark, folder):
    store = store_at(spark, folder)
    assert store.read().collect() == []
    store.replace(spark.createDataFrame([("A", "u", 1), ("D", "d", 2), ("D", None, 3), ("D", "e", 4)], SCHEMA))
    store.write_day("2024-01-01", made(spark, ("A", "v", 5), ("D", "d", None, True), ("D", None, 6)))
    after = [("A", "u", 1), ("A", "v", 5), ("D", "e", 4), ("D", None, 6)]
    assert rows(store.read()) == after
    store.write_day("2024-01-01", made(spark, ("A", "v", 5), ("D", "d", None, True), ("D", None, 6)))
    assert rows(store.read()) == after
    store.write_day("2024-01-02", made(spark, ("D", "d", 7), ("A", "u", None, True)))
    last = [("A", "v", 5), ("D", "d", 7), ("D", "e", 4), ("D", None, 6)]
    assert rows(store.read()) == last and rows(store.read(before="2024-01-02")) == after
    with pytest.raises(ValueError):
        store.write_day("2024-01-01", made(spark, ("A", "w", 9)))
    store.compact()
    assert rows(store.read()) == last and store.parts()["deltas"] == []
    with pytest.raises(ValueError):
        store.read(before="2024-01-02")
    store.write_day("2024-01-03", made(spark).limit(0))
    assert rows(store.read()) == last


def test_a_day_that_touches_one_bucket_rewrites_one(spark, folder):
    store = store_at(spark, folder)
    store.replace(spark.range(500).selectExpr("'A' as kind", "concat('u', id) as k", "id as guid"))
    before = store.parts()["base"]
    assert len(before) == 8
    store.write_day("2024-01-01", made(spark, ("A", "u7", 1007)))
    (delta,) = store.parts()["deltas"]
    assert len(delta["buckets"]) == 1 and store.parts()["base"] == before
    store.compact()
    after = store.parts()["base"]
    assert [b for b in before if after[b] != before[b]] == [str(b) for b in delta["buckets"]]
    expected = [("A", f"u{i}", 1007 if i == 7 else i) for i in range(500)]
    assert rows(store.read()) == sorted(expected, key=lambda r: tuple(str(v) for v in r))
    assert spark.read.parquet(after[str(delta["buckets"][0])]).count() < 200


def test_a_bucket_may_become_empty(spark, folder):
    store = store_at(spark, folder)
    store.replace(made(spark, ("A", "u", 1)).drop("_removed"))
    store.write_day("2024-01-01", made(spark, ("A", "u", None, True)))
    store.compact()
    assert store.read().collect() == [] and store.parts()["base"] == {}


@pytest.fixture
def tables(spark, folder):
    overwrite_days(spark.createDataFrame(list(log_rows(5)), LOG_SCHEMA), f"{folder}/log")
    replace_table(spark.createDataFrame([("s00000", "P", "C", "R")], "geohash string, province string, city string, region string"), f"{folder}/dictionary")
    replace_table(spark.createDataFrame([(2**24, 2**25 - 1, "X|0|IP|IC|isp")], "lo bigint, hi bigint, region string"), f"{folder}/ranges")
    scores = spark.createDataFrame([("d1", "u0", 100, 1, "2021-02-02")], "deviceid string, account string, score bigint, last_login bigint, dt string")
    overwrite_days(scores.withColumn("score", F.col("score").cast("decimal(22,1)")), f"{folder}/scores")
    return folder


def publish(spark, root, day):
    event_detail.run_published(
        spark, f"{root}/log", f"{root}/dictionary", f"{root}/ranges", f"{root}/scores", f"{root}/out", day, zone="UTC", row_id="event_id"
    )


def test_published_days_equal_plain_runs(spark, tables):
    plain = dict(log=f"{tables}/log", dictionary=f"{tables}/dictionary", ip_ranges=f"{tables}/ranges", scores=f"{tables}/scores", detail=f"{tables}/detail", zone="UTC", row_id="event_id")
    event_detail.run(spark, **plain, store=f"{tables}/none", next_store=f"{tables}/store-1", log_day="2021-02-01", first_run=True)
    event_detail.run(spark, **plain, store=f"{tables}/store-1", next_store=f"{tables}/store-2", log_day="2021-02-02")
    for day in ("2021-02-01", "2021-02-02", "2021-02-02"):
        publish(spark, tables, day)
    detail, store = event_detail.read_published(spark, f"{tables}/out")
    expected = read_table(spark, f"{tables}/detail").withColumn("dt", F.col("dt").cast("string"))
    shown = [c if c != "properties" else "to_json(properties) as properties" for c in expected.columns]
    assert rows(detail.select(expected.columns).selectExpr(*shown)) == rows(expected.selectExpr(*shown))
    assert rows(store) == rows(read_table(spark, f"{tables}/store-2"))
    with pytest.raises(ValueError):
        publish(spark, tables, "2021-02-01")


def test_a_failure_between_the_two_outputs_leaves_the_old_pair(spark, tables, monkeypatch):
    publish(spark, tables, "2021-02-01")

    def seen():
        detail, store = event_detail.read_published(spark, f"{tables}/out")
        return rows(detail.drop("properties")), rows(store)

    old = seen()
    write_day, published = KeyedStore.write_day, Ledger.publish
    for broken in ("before the store", "after the store"):

        def fails(self, day, changes, at=None, broken=broken):
            if broken == "after the store":
                write_day(self, day, changes, at)
            raise OSError(broken)

        monkeypatch.setattr(KeyedStore, "write_day", fails)
        with pytest.raises(OSError):
            publish(spark, tables, "2021-02-02")
        assert seen() == old
    monkeypatch.setattr(KeyedStore, "write_day", write_day)
    publish(spark, tables, "2021-02-02")
    new = seen()
    assert len(new[0]) > len(old[0]) and published is Ledger.publish
    # The failed runs have left no trace in the ids: one more run of the day gives the same.
    publish(spark, tables, "2021-02-02")
    assert seen() == new
    manifest = json.loads(sorted(Path(f"{tables}/out/_manifests").glob("0*.json"))[-1].read_text())
    assert set(manifest["detail"]) == {"2021-02-01", "2021-02-02"}
