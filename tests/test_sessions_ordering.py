import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.operators.ordering import crowded_cells, dense_numbers, row_positions, running_count, with_cell
from footfall.operators.sessions import split_sessions
from helpers import plan, rows

HALF_HOUR = 30 * 60 * 1000


def test_exact_gap_stays_together(spark):
    log = spark.createDataFrame(
        [("s", 0), ("s", HALF_HOUR), ("s", 2 * HALF_HOUR + 1), (None, 5)], "sessionId string, timeStamp bigint"
    )
    assert rows(split_sessions(log)) == [
        ("s", 0, "s_0"), ("s", HALF_HOUR, "s_0"), ("s", 2 * HALF_HOUR + 1, f"s_{2 * HALF_HOUR + 1}"), (None, 5, None),
    ]


def sequential_split(events, gap):
    found, seen = {}, {}
    for session, ts, key in sorted(events):
        last, start = seen.get(session, (ts, ts))
        start = ts if ts - last > gap else start
        seen[session] = (ts, start)
        found[key] = f"{session}_{start}"
    return found


def test_around_the_epoch_and_over_batches(spark):
    schema = "sessionId string, timeStamp bigint, key int"
    early = [("s", -1_700_000, 1), ("s", 1_700_000, 2), ("t", -5, 3), ("t", 5, 4)]
    got = {r["key"]: r["splitedSessionId"] for r in split_sessions(spark.createDataFrame(early, schema)).collect()}
    assert got == sequential_split([(s, t, k) for s, t, k in early], HALF_HOUR) and got[1] != got[2] and got[3] == got[4]
    days = [spark.createDataFrame([("s", day * 86_400_000, day)], schema) for day in (1, 2)]
    assert split_sessions(days[0]).union(split_sessions(days[1])).select("splitedSessionId").distinct().count() == 2


def test_split_equals_the_sequential_rule_with_one_hot_session(spark):
    for seed in range(4):
        rng = random.Random(seed)
        events = [("hot", rng.randrange(0, 40_000), i) for i in range(300)]
        events += [(f"s{rng.randrange(40)}", rng.randrange(0, 20_000), 300 + i) for i in range(600)]
        log = spark.createDataFrame(events, "sessionId string, timeStamp bigint, key int")
        got = {r["key"]: r["splitedSessionId"] for r in split_sessions(log, gap_ms=150).collect()}
        assert got == sequential_split(events, 150)


def test_splitting_never_windows_over_the_rows(spark):
    log = spark.range(10).selectExpr("cast(id as string) as sessionId", "id as timeStamp", "id as payload")
    text = plan(split_sessions(log))
    windows = [part for part in text.split("\n\n") if ") Window" in part]
    assert windows and all("payload" not in w for w in windows)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def events_with_hot_key(seed, n=900):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.4 else f"k{rng.randrange(30)}", rng.randrange(0, 3_000), i, rng.random() < 0.3)
        for i in range(n)
    ]


def test_running_count_equals_a_plain_scan(spark, sketched):
    for seed in range(3):
        events = events_with_hot_key(seed)
        before, upto, place, counts = {}, {}, {}, {}
        for key, _ts, i, flag in sorted(events):
            count, position = counts.get(key, (0, 0))
            before[i], place[i] = count, position + 1
            counts[key] = (count + flag, position + 1)
            upto[i] = count + flag
        df = spark.createDataFrame(events, "key string, ts bigint, i int, flag boolean")
        df = running_count(df, ["key"], ["ts", "i"], F.col("flag"), "before", cell_ms=100)
        df = running_count(df, ["key"], ["ts", "i"], F.col("flag"), "upto", inclusive=True, cell_ms=70, cells_per_block=6)
        df = row_positions(df, ["key"], ["ts", "i"], "place", cell_ms=300)
        got = {r["i"]: (r["before"], r["upto"], r["place"]) for r in df.collect()}
        assert got == {i: (before[i], upto[i], place[i]) for i in before}


def test_hot_key_is_windowed_in_pieces(spark):
    df = spark.range(10).selectExpr("'hot' as key", "id as ts", "id as payload")
    text = plan(running_count(df, ["key"], ["ts"], F.lit(True), "n"))
    row_windows = [p for p in text.split("\n\n") if ") Window" in p and "payload" in p]
    assert row_windows and all("_cell" in w.split("Arguments")[1].split("],")[1] for w in row_windows)


def test_dense_numbers(spark):
    events = events_with_hot_key(9)
    df = spark.createDataFrame(events, "key string, ts bigint, i int, flag boolean").repartition(4)
    numbered = dense_numbers(df, ["ts", "i"], "n", base=50, flag=F.col("flag"), cell_ms=10, cells_per_block=7)
    got = {r["i"]: r["n"] for r in numbered.collect()}
    expected, last = {}, 50
    for _key, _ts, i, flag in sorted(events, key=lambda e: (e[1], e[2])):
        last += flag
        expected[i] = last
    assert got == expected
    all_rows = [r["n"] for r in dense_numbers(df, ["ts", "i"], "n").collect()]
    assert sorted(all_rows) == list(range(1, len(events) + 1))


def burst(spark, n=96_000):
    """A third of the rows is one key's, all in one millisecond, and a third of those has no tie."""
    return spark.range(0, n, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 500)) as key", "if(id % 3 = 0, 77123, id * 997 % 9000000) as ts",
        "case when id % 9 = 0 then null else sha2(cast(id as string), 256) end as tie", "id % 5 = 0 as flagged", "id",
    )


def test_a_millisecond_with_a_third_of_all_rows_is_split(spark, sketched):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        counted = running_count(burst(spark), ["key"], ["ts", "tie", "id"], F.col("flagged"), "n")
        sizes = sorted(r["rows"] for r in counted.groupBy(F.spark_partition_id()).agg(F.count("*").alias("rows"), F.sum("n")).collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 96_000 and len(sizes) == 16 and sizes[-1] < 2 * sizes[8]


def test_a_burst_is_counted_like_a_plain_window(spark, sketched):
    log, order = burst(spark, 24_000), ["ts", "tie", "id"]
    plain = W.partitionBy("key").orderBy(*order)
    flags = F.col("flagged").cast("bigint")
    expected = log.select("id", F.coalesce(F.sum(flags).over(plain.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("n"), F.row_number().over(plain).alias("place"))
    mine = row_positions(running_count(log, ["key"], order, F.col("flagged"), "n"), ["key"], order, "place").select("id", "n", "place")
    assert mine.exceptAll(expected.selectExpr("id", "n", "cast(place as bigint)")).count() == 0 and mine.count() == 24_000
    numbered = dense_numbers(log, order, "number", cells_per_block=60)
    whole = log.select("id", F.row_number().over(W.orderBy(*order)).cast("bigint").alias("number"))
    assert numbered.select("id", "number").exceptAll(whole).count() == 0


def test_only_crowded_cells_are_cut(spark):
    cells = with_cell(burst(spark), "ts")
    (found,) = crowded_cells(cells, ["key"], ["ts", "tie", "id"]).collect()
    assert (found["key"], found["_cell"]) == ("hot", 77) and 40 < len(found["_splitters"]) < 140
    assert [s["id"] for s in found["_splitters"]] != sorted(s["id"] for s in found["_splitters"])
    assert crowded_cells(cells.where("key <> 'hot'").limit(300), ["key"], ["ts", "tie", "id"]).where("size(_splitters) > 40").count() == 0
    assert running_count(burst(spark).limit(0), ["key"], ["ts", "id"], F.lit(True), "n").count() == 0
