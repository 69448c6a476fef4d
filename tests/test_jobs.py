"""The jobs over tables, from the area tree to attribution."""

import os
import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import area
from footfall.operators.detail import DETAIL_COLUMNS
from footfall.operators.identity import STORE_SCHEMA
from footfall.plans import area_dictionary, coupon_attribution, device_binding, event_detail
from footfall.operators.clean import day_window, required_fields
from footfall.operators.detail import to_detail
from footfall.sources import overwrite_day, overwrite_days, read_table, replace_table
from helpers import rows

DAY = 1612137600000  # 2021-02-01 00:00 UTC
LOG_SCHEMA = (
    "account string, appId string, appVersion string, carrier string, deviceId string, eventId string, ip string, "
    "latitude double, longitude double, netType string, osName string, osVersion string, "
    "properties map<string,string>, resolution string, sessionId string, timeStamp bigint, dt string, event_id bigint"
)
EVENTS = ("fetchCoupon", "goodsView", "addCart", "adShow", "start")


def log_rows(seed=1, n=400):
    """Two days of log, one device and one session in a third of all rows."""
    rng = random.Random(seed)
    for i in range(n):
        hot = rng.random() < 0.34
        device = "hot" if hot else f"d{rng.randrange(9)}"
        day = rng.randrange(2)
        ts = DAY + day * 86_400_000 + rng.randrange(-600_000, 86_400_000)
        yield (
            rng.choice(["", None, f"u{rng.randrange(7)}"]), "app", "1", "c", device if i % 50 else " ",
            rng.choice(EVENTS), rng.choice(["1.2.3.4", "9.9.9.9", "bad", None]),
            rng.choice([0.0, 50.0, None]), 0.0, "wifi", "os", "1", {"k": "v"} if i % 40 else None, "1x1",
            "hot-session" if hot else f"s{rng.randrange(20)}", ts, f"2021-02-0{day + 1}", i,
        )


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    overwrite_days(spark.createDataFrame(list(log_rows()), LOG_SCHEMA), f"{root}/log")
    areas = [
        (1, None, 1, "P", None, None), (2, 1, 2, "C", None, None), (3, 2, 3, "R", None, None), (4, 3, 4, "x", 0.0, 0.0),
    ]
    replace_table(
        spark.createDataFrame(areas, "id bigint, parentid bigint, level int, areaname string, bd09_lat double, bd09_lng double"),
        f"{root}/areas",
    )
    area_dictionary.run(spark, f"{root}/areas", f"{root}/dictionary")
    replace_table(spark.createDataFrame([(2**24, 2**25 - 1, "X|0|IP|IC|isp")], "lo bigint, hi bigint, region string"), f"{root}/ranges")
    replace_table(spark.createDataFrame([("C", "guid_cnt", 100), ("A", "u0", 7), ("D", "d1", 8)], STORE_SCHEMA), f"{root}/store-0")
    scores = spark.createDataFrame([("d1", "u0", 100, 1, "2021-01-31"), ("gone", "u9", 50, 1, "2021-01-31")],
                                   "deviceid string, account string, score bigint, last_login bigint, dt string")
    overwrite_days(scores.withColumn("score", F.col("score").cast("decimal(22,1)")), f"{root}/scores")
    return root


def run_detail(spark, root, day, store, following, out="detail", **options):
    event_detail.run(
        spark, log=f"{root}/log", dictionary=f"{root}/dictionary", ip_ranges=f"{root}/ranges", scores=f"{root}/scores",
        store=f"{root}/{store}", next_store=f"{root}/{following}", detail=f"{root}/{out}", log_day=day, **{"zone": "UTC", **options},
    )
    return read_table(spark, f"{root}/{out}").where(F.col("dt").cast("string") == options.get("out_day", day))


def comparable(df):
    return rows(df.withColumn("properties", F.col("properties")["k"]), *DETAIL_COLUMNS)


def test_days_of_jobs(spark, warehouse):
    root = warehouse
    for before, day in (("2021-01-31", "2021-02-01"), ("2021-02-01", "2021-02-02")):
        device_binding.run(spark, f"{root}/log", f"{root}/scores", before, day)
    gone = read_table(spark, f"{root}/scores").where("deviceid = 'gone'").orderBy("dt")
    assert [str(r["score"]) for r in gone.collect()] == ["50.0", "30.0", "18.0"]

    once = comparable(run_detail(spark, root, "2021-02-01", "store-0", "store-1", row_id="event_id"))
    run_detail(spark, root, "2021-02-01", "store-0", "store-1", row_id="event_id")
    second = run_detail(spark, root, "2021-02-02", "store-1", "store-2", row_id="event_id")
    first = read_table(spark, f"{root}/detail").where("cast(dt as string) = '2021-02-01'")
    assert comparable(first) == once and len(once) > 100
    assert set(first.columns) == {*DETAIL_COLUMNS, "dt"}

    log = {r[-1]: r for r in log_rows()}
    expected = {
        d: sum(
            r[16] == d and r[4].strip() != "" and r[12] is not None and start <= r[15] < start + 86_400_000
            for r in log.values()
        )
        for d, start in (("2021-02-01", DAY), ("2021-02-02", DAY + 86_400_000))
    }
    assert {"2021-02-01": first.count(), "2021-02-02": second.count()} == expected

    both = first.unionByName(second)
    assert both.where("guid < 0 or guid is null or splitedSessionId is null").count() == 0
    per_account = both.where("filledAccount is not null").groupBy("filledAccount").agg(F.count_distinct("guid").alias("n"))
    assert per_account.where("n <> 1").count() == 0
    assert first.where("isnew = 1 and guid <= 100 or isnew = 0 and guid > 100").count() == 0
    counter = spark.read.parquet(f"{root}/store-1").where("kind = 'C'").first()["guid"]
    assert second.where(f"isnew <> cast(guid > {counter} as int)").count() == 0
    assert both.where("latitude = 0.0 and (province <> 'P' or region is null)").count() == 0
    by_ip = both.where("latitude is null and ip = '1.2.3.4'").select("province", "city", "region").distinct()
    assert rows(by_ip) == [("IP", "IC", None)]
    assert both.where("latitude = 50.0 and ip <> '1.2.3.4' and province is not null").count() == 0

    coupon_attribution.run(spark, f"{root}/detail", f"{root}/weights", "2021-02-01")
    found = read_table(spark, f"{root}/weights")
    touches = first.where("eventId in ('goodsView', 'addCart', 'adShow')").count()
    assert found.count() == touches
    segments = found.groupBy("guid").agg((F.sum("weight") / 100).alias("n")).collect()
    assert all(abs(r["n"] - round(r["n"])) < 1e-9 for r in segments)


def test_log_without_row_id_and_other_days(spark, warehouse):
    root = warehouse
    options = {"bind_day": "2021-01-31", "out_day": "2021-02-03"}
    mine = run_detail(spark, root, "2021-02-01", "store-0", "store-x", out="other", row_id="event_id", **options)
    expected = mine.drop("guid", "isnew").withColumn("properties", F.col("properties")["k"])
    without = run_detail(spark, root, "2021-02-01", "store-0", "store-y", out="without", **options)
    got = without.drop("guid", "isnew").withColumn("properties", F.col("properties")["k"])
    assert rows(got, *expected.columns) == rows(expected)
    # The same rows in other files, in another order, get the same guids.
    read_table(spark, f"{root}/log").repartition(5, "eventId").write.partitionBy("dt").parquet(f"{root}/log-again/log")
    for name in ("dictionary", "ranges", "scores", "store-0"):
        read = read_table(spark, f"{root}/{name}")
        (read.write.partitionBy("dt") if "dt" in read.columns else read.write).parquet(f"{root}/log-again/{name}")
    again = run_detail(spark, f"{root}/log-again", "2021-02-01", "store-0", "store-y", out="without", **options)
    assert comparable(again) == comparable(without)
    with pytest.raises(ValueError, match="next store"):
        run_detail(spark, root, "2021-02-01", "store-0", "store-0")


def test_large_lookup_tables_give_the_same_rows(spark, warehouse, monkeypatch):
    options = {"row_id": "event_id", "bind_day": "2021-01-31"}
    small = comparable(run_detail(spark, warehouse, "2021-02-01", "store-0", "store-l", out="small", **options))
    monkeypatch.setattr(area, "MAX_BROADCAST_ROWS", 0)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = comparable(run_detail(spark, warehouse, "2021-02-01", "store-0", "store-l", out="large", **options))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert small == large and len(small) > 100


@pytest.mark.parametrize("most", [0, 2_000_000])
def test_rows_that_come_twice_stay_two(spark, warehouse, folder, monkeypatch, most):
    log = read_table(spark, f"{warehouse}/log")
    log.unionByName(log.where("event_id % 10 = 0")).write.partitionBy("dt").parquet(f"{folder}/log")
    for name in ("dictionary", "ranges", "scores", "store-0"):
        read = read_table(spark, f"{warehouse}/{name}")
        (read.write.partitionBy("dt") if "dt" in read.columns else read.write).parquet(f"{folder}/{name}")
    monkeypatch.setattr(area, "MAX_BROADCAST_ROWS", most)
    options = {"row_id": "event_id", "bind_day": "2021-01-31"}
    plain = run_detail(spark, warehouse, "2021-02-01", "store-0", "store-p", out="plain", **options).count()
    extra = to_detail(day_window(required_fields(log.where("event_id % 10 = 0")), "2021-02-01", zone="UTC")).count()
    assert run_detail(spark, folder, "2021-02-01", "store-0", "store-p", out="twice", **options).count() == plain + extra > plain


def test_a_day_without_rows_is_emptied(spark, folder):
    weights = f"{folder}/weights"
    schema = "guid bigint, timeStamp bigint, eventId string"
    for day, events in (("d1", [(1, 1, "adShow"), (1, 2, "fetchCoupon")]), ("d2", [(2, 1, "adShow"), (2, 2, "fetchCoupon")]), ("d1", [])):
        overwrite_day(spark.createDataFrame(events, schema), f"{folder}/detail", day)
        coupon_attribution.run(spark, f"{folder}/detail", weights, day)
    assert rows(read_table(spark, weights), "dt") == [("d2",)]
    for day, ids in (("d1", [1]), ("d2", [2]), ("d1", [])):
        overwrite_day(spark.createDataFrame([(i, "x") for i in ids], "id bigint, name string"), "emptied_days", day)
    assert rows(spark.table("emptied_days"), "id", "dt") == [(2, "d2")]


def test_runs_of_one_day_stage_apart_and_clean_up(spark, warehouse, monkeypatch):
    """A second run of the day, into other tables, comes in while the first has staged and not yet written."""
    root, written, removed = warehouse, event_detail.replace_table, []
    remove = event_detail.Staging.remove

    def other_run_first(store, location):
        if location.endswith("store-first"):
            run_detail(spark, root, "2021-02-02", "store-0", "store-second", out="detail-second")
        written(store, location)

    def noted(stage):
        assert os.path.exists(stage.location("keys"))
        remove(stage)
        removed.append(stage.path)

    monkeypatch.setattr(event_detail, "replace_table", other_run_first)
    monkeypatch.setattr(event_detail.Staging, "remove", noted)
    first = run_detail(spark, root, "2021-02-02", "store-0", "store-first", out="detail-first")
    assert comparable(first) == comparable(read_table(spark, f"{root}/detail-second").where("dt = '2021-02-02'"))
    assert len(set(removed)) == 2 and not any(map(os.path.exists, removed))


def test_append_adds_a_second_copy(spark, warehouse):
    root = warehouse
    for _ in range(2):
        copies = run_detail(spark, root, "2021-02-01", "store-0", "store-z", out="appended", row_id="event_id",
                            bind_day="2021-01-31", append=True)
    assert copies.count() == 2 * run_detail(
        spark, root, "2021-02-01", "store-0", "store-z", out="single", row_id="event_id", bind_day="2021-01-31"
    ).count()


def test_first_day_needs_no_tables_before(spark, folder, warehouse):
    log = read_table(spark, f"{warehouse}/log")
    text = log.withColumn("properties", F.to_json(F.map_concat("properties", F.create_map(F.lit("old"), F.lit("x")))))
    overwrite_days(text.withColumn("dt", F.col("dt").cast("string")), f"{folder}/log")
    device_binding.run(spark, f"{folder}/log", f"{folder}/scores", "2021-01-31", "2021-02-01", first_run=True)
    assert read_table(spark, f"{folder}/scores").count() > 0
    replace_table(read_table(spark, f"{warehouse}/dictionary"), f"{folder}/dictionary")
    replace_table(read_table(spark, f"{warehouse}/ranges"), f"{folder}/ranges")
    options = {"first_run": True, "json_properties": True, "obsolete": ["old"]}
    got = run_detail(spark, folder, "2021-02-01", "no-store", "store-1", **options)
    assert rows(got.select(F.map_keys("properties")).distinct()) == [(["k"],)]
    assert got.where("guid < 1 or isnew <> 1").count() == 0 and got.agg(F.min("guid")).first()[0] == 1
    assert spark.read.parquet(f"{folder}/store-1").where("kind = 'C'").first()["guid"] == got.agg(F.max("guid")).first()[0]


def test_days_are_those_of_the_session_unless_named(spark, warehouse):
    mine = run_detail(spark, warehouse, "2021-02-01", "store-0", "store-n", out="zoned", bind_day="2021-01-31", zone=None)
    start = DAY + 5 * 3_600_000  # New York
    assert mine.count() > 0 and mine.where(f"timeStamp < {start} or timeStamp >= {start + 86_400_000}").count() == 0


def test_area_job_reads_a_database_when_one_is_named(spark, folder, warehouse, monkeypatch):
    asked = {}

    def read(spark, url, table, properties, partitions):
        asked.update(url=url, table=table, properties=properties, partitions=partitions)
        return read_table(spark, f"{warehouse}/areas")

    monkeypatch.setattr(area_dictionary, "read_areas_jdbc", read)
    with open(f"{folder}/connection", "w") as file:
        file.write("user = reader\npassword=a=b\n\n")
    area_dictionary.run(spark, "areas", f"{folder}/dictionary", url="jdbc:x:y", properties_file=f"{folder}/connection", read_partitions="2")
    assert asked == {"url": "jdbc:x:y", "table": "areas", "properties": {"user": "reader", "password": "a=b"}, "partitions": 2}
    assert rows(read_table(spark, f"{folder}/dictionary")) == [("s00000", "P", "C", "R")]
