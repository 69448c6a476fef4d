"""Lookups on hot keys: right results, and split at run time."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from footfall.operators.area import locate_events, locate_by_position
from footfall.operators.binding import fill_accounts
from footfall.operators.lookup import HOT_SHARE, hot_keys, look_up, look_up_hot
from footfall.functions import geohash6
from helpers import plan, rows

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def small_pieces(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_look_up(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (9, "z", 4)], "k int, t string, v int")
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, t string, w string")
    assert rows(look_up(left, table, ["k", "t"]), "v", "w") == [(1, "x"), (2, "x"), (3, None), (4, None)]
    assert rows(look_up(left, table, ["k", "t"], "inner"), "v", "w") == [(1, "x"), (2, "x")]
    assert look_up(left, table, ["k", "t"]).columns == ["k", "t", "v", "w"]


def test_a_hot_device_is_split_at_run_time(spark, small_pieces):
    log = spark.range(0, 120_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('d', id % 5000)) as deviceId", "cast(null as string) as account",
        "sha2(cast(id as string), 256) as payload",
    )
    scores = spark.range(5000).selectExpr(
        "if(id = 0, 'hot', concat('d', id)) as deviceid", "concat('u', id) as account", "1 as score", "1 as last_login"
    )
    filled = look_up(log, scores.select("deviceid", F.col("account").alias("filledAccount")), ["deviceid"])
    found = filled.toPandas()
    assert len(found) == 120_000 and (found[found.deviceId == "hot"].filledAccount == "u0").all()
    assert re.search(r"SortMergeJoin\(skew=true\)", plan(filled))


def test_look_up_hot_is_look_up(spark, sketched):
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (2, None, 3), (9, "z", 4), (None, None, 5)], "k int, t string, v int")
    table = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, None, "n")], "K int, t string, w string")
    assert rows(look_up_hot(left, table, ["k", "t"]), "v", "w") == [(1, "x"), (2, "x"), (3, None), (4, None), (5, None)]
    assert rows(look_up_hot(left, table, ["k", "t"], "inner"), "v", "w") == [(1, "x"), (2, "x")]
    assert look_up_hot(left, table, ["k", "t"]).columns == ["k", "t", "v", "w"]
    assert rows(look_up_hot(left.where("false"), table, ["k", "t"])) == []
    with pytest.raises(ValueError):
        look_up_hot(left, table.withColumn("K", F.col("K").cast("bigint")), ["k", "t"])


def test_look_up_hot_carries_maps_and_null_values(spark, sketched):
    left = spark.range(2000).selectExpr("if(id % 2 = 0, 7, id) as k", "map('a', id) as m", "id")
    table = spark.createDataFrame([(7, None), (9, "y")], "k bigint, w string")
    got = {r["id"]: r["w"] for r in look_up_hot(left, table, ["k"]).collect()}
    assert len(got) == 2000 and {k: v for k, v in got.items() if v} == {9: "y"}
    assert look_up_hot(left, table, ["k"], "inner").count() == 1002


def test_hot_keys_misses_none(spark):
    n = 400_000
    keys = spark.range(0, n, 1, 16).selectExpr("case when id % 3 = 0 then 1 when id % 250 = 1 then 2 when id % 400 = 2 then 3 when id % 7 = 0 then null else id + 10 end as k")
    found = {r["item"] for r in hot_keys(keys, F.col("k")).collect()}
    assert {1, 2, 3} <= found and len(found) < HOT_SHARE and None not in found
    assert hot_keys(keys.where("k is null"), F.col("k")).collect() == []


@pytest.mark.parametrize("lookup", ["accounts", "positions"])
def test_hot_keys_leave_partitions_even_without_adaptive_execution(spark, sketched, lookup):
    """A third of the rows has one key and a third none; the most rows of a partition stay near the mean."""
    log = spark.range(0, 96_000, 1, 8).selectExpr(
        "case when id % 3 = 0 then 'hot' when id % 3 = 1 then null else concat('d', id % 5000) end as deviceId", "cast(null as string) as account", "id",
        "case when id % 3 = 0 then 10D when id % 3 = 1 then null else cast(id % 90 as double) end as latitude", "cast(id % 3 as double) as longitude",
    )
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        if lookup == "accounts":
            scores = spark.range(5000).selectExpr("if(id = 0, 'hot', concat('d', id)) as deviceid", "concat('u', id) as account", "1 as score", "1 as last_login")
            found = fill_accounts(log, scores)
            right = "filledAccount <=> case when deviceId = 'hot' then 'u0' when deviceId = 'd0' then null when deviceId is null then null else replace(deviceId, 'd', 'u') end"
        else:
            cells = log.select("latitude", "longitude").where("latitude is not null").distinct()
            found = locate_by_position(log, dictionary_of(cells), small=False)
            right = "(gps_area is null) = (latitude is null)"
        counted = found.withColumn("ok", F.expr(right)).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count_if("ok").alias("ok")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r["n"] for r in counted]
    assert sum(sizes) == 96_000 == sum(r["ok"] for r in counted)
    assert len(sizes) == 16 and max(sizes) < 2 * 96_000 / 16


def dictionary_of(cells):
    return cells.select(geohash6("latitude", "longitude").alias("geohash"), F.lit("p").alias("province"), F.lit("c").alias("city"), F.lit("r").alias("region"))


def test_generated_code_stays_compilable(spark, folder):
    """The JVM leaves methods of 8,000 bytes and more to its interpreter."""
    spark.range(5).selectExpr(
        "id", "id * 1D as latitude", "id * 2D as longitude", "concat('1.1.1.', id) as ip", "concat('g', id) as geohash",
        "'p' as province", "'c' as city", "'X|0|p|c|i' as region", "id * 256 as lo", "id * 256 + 255 as hi",
    ).write.parquet(f"{folder}/all")
    table = spark.read.parquet(f"{folder}/all")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            locate_events(table.select("id", "latitude", "longitude", "ip"), table, table, small=True).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
