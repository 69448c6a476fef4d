from decimal import Decimal

from footfall.operators.binding import best_accounts, binding_events, daily_scores, fill_accounts, merge_bucketed, merge_scores, with_account_key
from footfall.plans import device_binding
from footfall.sources import write_bucketed
from helpers import ordered, plan, rows

SCORES = "deviceid string, account string, score {}, last_login bigint"
TODAY = [("d1", "u1", 100, 10), ("d1", None, 200, 11), ("d3", "u3", 100, 12)]
BEFORE = [("d1", "u1", Decimal(300), 1), ("d1", None, Decimal(50), 2), ("d2", "u2", Decimal(100), 3)]


def tables(spark):
    return (
        spark.createDataFrame(TODAY, SCORES.format("bigint")),
        spark.createDataFrame(BEFORE, SCORES.format("decimal(22,1)")),
    )


def test_daily_scores(spark):
    log = spark.createDataFrame(
        [
            ("d1", "u1", "s1", 1, "e"), ("d1", "u1", "s1", 9, "e"), ("d1", "u1", "s2", 5, "e"),
            ("d1", "", "s3", 3, "e"), ("d1", None, "s4", 4, "e"), ("d1", "u1", "s9", 99, None),
        ],
        "deviceId string, account string, sessionId string, timeStamp bigint, eventId string",
    )
    assert rows(daily_scores(binding_events(log))) == ordered([("d1", "u1", 200, 9), ("d1", None, 200, 4)])
    assert rows(daily_scores(binding_events(log, literal=True))) == ordered(
        [("d1", "u1", 200, 9), ("d1", "null", 100, 3), ("d1", None, 100, 4)]
    )


def test_merge(spark):
    today, before = tables(spark)
    merged = merge_scores(today, before)
    assert dict(merged.dtypes)["score"] == "decimal(22,1)"
    assert rows(merged) == ordered(
        [
            ("d1", None, Decimal("250.0"), 11), ("d1", "u1", Decimal("400.0"), 10),
            ("d2", "u2", Decimal("60.0"), 3), ("d3", "u3", Decimal("100.0"), 12),
        ]
    )


def test_merge_literal(spark):
    today, before = tables(spark)
    assert rows(merge_scores(today, before, literal=True)) == ordered(
        [
            ("d1", None, None, 2), ("d1", None, Decimal("200.0"), 11), ("d1", "u1", Decimal("400.0"), 10),
            ("d2", "u2", None, 3), ("d3", "u3", Decimal("100.0"), 12),
        ]
    )


def test_score_decays_day_by_day(spark):
    nothing, scores = spark.createDataFrame([], SCORES.format("bigint")), tables(spark)[1]
    seen = []
    for _ in range(3):
        scores = merge_scores(nothing, scores)
        seen.append(scores.where("deviceid = 'd2'").first()["score"])
    assert seen == [Decimal("60.0"), Decimal("36.0"), Decimal("21.6")]


def test_best_account(spark):
    data = [
        ("d1", "u1", 100, 5), ("d1", "u2", 100, 7), ("d1", None, 900, 9),
        ("d2", "b", 100, 5), ("d2", "a", 100, 5), ("d3", None, 100, 1), ("d4", "x", None, 9), ("d4", "y", 1, 1),
    ]
    scores = spark.createDataFrame(data, SCORES.format("bigint"))
    assert rows(best_accounts(scores)) == [("d1", "u2"), ("d2", "a"), ("d4", "y")]
    assert "WindowGroupLimit" in plan(best_accounts(scores))


def test_fill_accounts_keeps_every_row(spark, sketched):
    log = spark.createDataFrame(
        [("d1", None, 1), ("d1", "own", 2), ("d9", None, 3), (None, None, 4)], "deviceId string, account string, i int"
    )
    scores = spark.createDataFrame([("d1", "best", 100, 1)], SCORES.format("bigint"))
    assert rows(fill_accounts(log, scores), "i", "account", "filledAccount") == ordered(
        [(1, None, "best"), (2, "own", "own"), (3, None, None), (4, None, None)]
    )


def test_bucketed_merge_moves_nothing_and_equals_the_plain_one(spark, folder):
    schema = "deviceid string, account string, score decimal(22,1), last_login bigint"
    make = lambda salt: spark.range(400).selectExpr(
        f"case when id % 50 = 1 then null else concat('d', id % 90 + {salt}) end as deviceid", "case when id % 7 = 0 then null else concat('u', id) end as account",
        "cast(id as decimal(22,1)) as score", f"id + {salt} as last_login",
    ).dropDuplicates(["deviceid", "account"])
    today, before = make(0), make(3)
    assert today.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
    expected = rows(merge_scores(today, before))
    tables = [write_bucketed(with_account_key(df), f"scores_{name}", ["deviceid", "account_key"], 4, f"{folder}/{name}") for name, df in (("today", today), ("before", before))]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = merge_bucketed(*tables)
        assert "SortMergeJoin FullOuter" in plan(merged) and "Exchange" not in plan(merged)
        assert rows(merged.drop("account_key")) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in ("today", "before"):
            spark.sql(f"drop table scores_{name}")


def test_bucketed_job_over_two_days(spark, folder):
    log = [("d1", "u1", "s1", "click", 5, "2024-01-01"), ("d1", "", "s2", "click", 6, "2024-01-01"), ("d1", "u1", "s3", "click", 7, "2024-01-02"), ("d2", "u2", "s4", "view", 8, "2024-01-02")]
    days = spark.createDataFrame(log, "deviceId string, account string, sessionId string, eventId string, timeStamp bigint, dt string")
    days.write.partitionBy("dt").parquet(f"{folder}/log")
    names = dict(buckets=4, path=f"{folder}/tables")
    tables = ["b_day1", "b_none", "b_merged1", "b_day2", "b_merged2"]
    try:
        device_binding.run_bucketed(spark, f"{folder}/log", "b_day1", "b_none", "b_merged1", "2024-01-01", first_run=True, **names)
        for _ in range(2):
            device_binding.run_bucketed(spark, f"{folder}/log", "b_day2", "b_merged1", "b_merged2", "2024-01-02", **names)
        found = rows(spark.table("b_merged2").selectExpr("deviceid", "account", "cast(score as double)", "last_login"))
    finally:
        for name in tables:
            spark.sql(f"drop table if exists {name}")
    assert found == [("d1", "u1", 200.0, 7), ("d1", None, 60.0, 6), ("d2", "u2", 100.0, 8)]
