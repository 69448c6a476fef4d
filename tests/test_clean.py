from pyspark.sql import functions as F

from footfall.operators.clean import blank_account_to_null, day_window, parse_properties, required_fields, strip_properties
from footfall.operators.detail import DETAIL_COLUMNS, LOG_COLUMNS, to_detail
from helpers import plan, rows

DAY = 1612137600000  # 2021-02-01 00:00 UTC


def test_required_fields(spark):
    data = [
        ("ok", "d", "e", "s", {"a": "b"}),
        ("empty map is fine", "d", "e", "s", {}),
        ("no device", " ", "e", "s", {}),
        ("null device", None, "e", "s", {}),
        ("no event", "d", "　", "s", {}),
        ("no session", "d", "e", "\t", {}),
        ("no properties", "d", "e", "s", None),
    ]
    log = spark.createDataFrame(data, "note string, deviceid string, eventid string, sessionid string, properties map<string,string>")
    assert rows(required_fields(log), "note") == [("empty map is fine",), ("ok",)]


def test_parse_properties_drops_malformed_and_strips_obsolete(spark):
    log = spark.createDataFrame([('{"a": 1, "old": 2}',), ('{"a": 1',), ("",), (None,), ("{}",)], "properties string")
    got = [r[0] for r in strip_properties(parse_properties(log), ["old"]).collect()]
    assert got == [{"a": "1"}, None, None, None, {}]


def test_day_window_is_half_open(spark):
    times = [DAY - 1, DAY, DAY + 86_400_000 - 1, DAY + 86_400_000, None]
    log = spark.createDataFrame([(t,) for t in times], "timestamp bigint")
    assert rows(day_window(log, "2021-02-01")) == [(DAY,), (DAY + 86_400_000 - 1,)]
    assert rows(day_window(log, "2021-02-01", "2021-02-03")) == [(t,) for t in times[1:4]]
    shanghai = day_window(log, "2021-02-01", zone="Asia/Shanghai")
    assert rows(shanghai) == [(DAY - 1,), (DAY,)]


def test_day_window_over_a_day_column(spark):
    log = spark.createDataFrame([(DAY, "2021-02-01"), (DAY, "2021-02-02")], "timeStamp bigint, dt string")
    assert rows(day_window(log, F.col("dt"))) == [(DAY, "2021-02-01")]


def test_filters_reach_the_scan(spark, folder):
    data = [("d", "e", "s", DAY, {"a": "b"}, "x", "2021-02-01")]
    schema = "deviceId string, eventId string, sessionId string, timeStamp bigint, properties map<string,string>, other string, dt string"
    spark.createDataFrame(data, schema).write.partitionBy("dt").parquet(f"{folder}/log")
    from footfall.sources import read_days

    log = read_days(spark, f"{folder}/log", "2021-02-01")
    text = plan(day_window(required_fields(log), "2021-02-01").select("deviceId"))
    scan = text[text.index("Scan parquet") :]
    assert f"GreaterThanOrEqual(timeStamp,{DAY})" in scan and f"LessThan(timeStamp,{DAY + 86_400_000})" in scan
    assert "PartitionFilters: [isnotnull(dt" in scan and "other" not in scan


def test_blank_account(spark):
    log = spark.createDataFrame([("",), (" ",), ("u",), (None,)], "account string")
    assert [r[0] for r in blank_account_to_null(log).collect()] == [None, " ", "u", None]


def test_detail_contract(spark):
    log = spark.createDataFrame(
        [("", 1.0, None, 5, {"a": "b"}, 7)],
        "account string, latitude double, longitude double, timestamp bigint, properties map<string,string>, row int",
    )
    for name in LOG_COLUMNS:
        if name.lower() not in {c.lower() for c in log.columns}:
            log = log.withColumn(name.lower(), F.lit(name))
    got = to_detail(log, keep=("row",))
    assert got.columns == [*DETAIL_COLUMNS, "row"]
    types = dict(got.dtypes)
    assert (types["guid"], types["isnew"], types["province"], types["timeStamp"]) == ("bigint", "int", "string", "bigint")
    row = got.first()
    assert (row["account"], row["deviceId"], row["longitude"], row["guid"], row["isnew"], row["region"]) == (
        None, "deviceId", None, -1, 0, None,
    )
    filled = to_detail(log.withColumn("province", F.lit("p")))
    assert filled.first()["province"] == "p"
