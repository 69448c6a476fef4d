import random

from pyspark.sql import functions as F

from footfall.functions import blank_to_null, day_start_ms, geohash6, ipv4_to_long, is_not_blank, next_day, previous_day
from footfall.functions.days import current_day
from footfall.functions.places import GEOHASH_ALPHABET
from footfall.functions.sql import register_sql_functions


def bisected(lat, lng):
    """Geohash by halving intervals."""
    spans, bits, value, word = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}, 0, 0, ""
    while len(word) < 6:
        span, point = spans[bits % 2], (lng, lat)[bits % 2]
        middle = (span[0] + span[1]) / 2
        upper = point >= middle
        span[0 if upper else 1] = middle
        value, bits = value * 2 + upper, bits + 1
        if bits % 5 == 0:
            word, value = word + GEOHASH_ALPHABET[value], 0
    return word


def test_blank(spark):
    values = [" ", "\t", "　", "", None, "a ", " \n x"]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r[0] for r in df.select(is_not_blank("s")).collect()] == [False] * 5 + [True] * 2
    assert [r[0] for r in df.select(blank_to_null("s")).collect()] == [" ", "\t", "　", None, None, "a ", " \n x"]


def test_geohash_known_points(spark):
    points = {
        (-33.25, 151.5): bisected(-33.25, 151.5),
        (61.125, -149.875): bisected(61.125, -149.875),
        (90.0, 180.0): "zzzzzz",
        (-90.0, -180.0): "000000",
        (0.0, 0.0): "s00000",
        (90.1, 0.0): None,
        (0.0, -180.5): None,
        (None, 0.0): None,
        (float("nan"), 0.0): None,
    }
    df = spark.createDataFrame([(*p, i) for i, p in enumerate(points)], "lat double, lng double, i int")
    got = {r["i"]: r["g"] for r in df.select("i", geohash6("lat", "lng").alias("g")).collect()}
    assert [got[i] for i in range(len(points))] == list(points.values())


def test_geohash_equals_bisection_also_at_cell_edges(spark):
    import math

    rng = random.Random(5)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(2000)]
    for _ in range(1000):
        lat, lng = rng.randrange(-16384, 16384) * 45 / 8192, rng.randrange(-16384, 16384) * 45 / 4096
        points += [(lat, lng), (math.nextafter(lat, -90), math.nextafter(lng, 180)), (lat, math.nextafter(lng, -180))]
    df = spark.createDataFrame(points, "lat double, lng double")
    for lat, lng, got in df.select("lat", "lng", geohash6("lat", "lng")).collect():
        assert got == bisected(lat, lng), (lat, lng)


def test_ipv4(spark):
    cases = {
        "203.0.113.77": 3405803853,
        "198.51.100.3": 3325256707,
        "192.0.2.250": 3221226234,
        "0.0.0.0": 0,
        "255.255.255.255": 2**32 - 1,
        "x": None,
        "1.2.3.999": None,
        "1.2.3": None,
        "1.2.3.4.5": None,
        " 1.2.3.4": None,
        "+1.2.3.4": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(ip, i) for i, ip in enumerate(cases)], "ip string, i int")
    got = {r[0]: r[1] for r in df.select("i", ipv4_to_long("ip")).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())


def test_days(spark):
    one = spark.range(1)
    assert tuple(one.select(previous_day("2021-02-01"), current_day("2021-02-01"), next_day("2021-02-01")).first()) == (
        "2021-01-31", "2021-02-01", "2021-02-02",
    )
    assert tuple(one.select(previous_day("2024-03-01"), next_day("2024-12-31")).first()) == ("2024-02-29", "2025-01-01")
    today = one.select(
        (F.current_date().cast("string") == current_day())
        & (F.date_add(F.current_date(), 1).cast("string") == next_day())
        & (F.date_sub(F.current_date(), 1).cast("string") == previous_day())
    )
    assert today.first()[0]


def test_day_start_does_not_depend_on_the_session_zone(spark):
    starts = spark.range(1).select(day_start_ms("2021-02-01"), day_start_ms("2021-02-01", "Asia/Shanghai")).first()
    assert tuple(starts) == (1612137600000, 1612137600000 - 8 * 3600 * 1000)


def test_sql_functions(spark):
    register_sql_functions(spark)
    got = spark.sql(
        "select geo(-33.25D, 151.5D), isNotBlank('\t'), isNotBlank(null), isNotBlank('x'),"
        " getCnt(bitmap_construct_agg(bitmap_bit_position(id))) from values 1, 2, 3, 3, null as t(id)"
    )
    assert tuple(got.first()) == ("r65dz7", False, False, True, 3)
