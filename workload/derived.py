"""An app-event log, an area tree and IP ranges derived from the given tables.

The column texts are valid in Spark SQL and in the checking engine alike; only what differs between the
two is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT = "varchar(20)"
GUID_BASE = 1_000_000
FIRST_DAY, MIDDLE_DAY, LAST_DAY, END_DAY = "2024-01-01", "2024-01-16", "2024-01-30", "2024-01-31"

# Milliseconds of the zone-less event time, floored.
SPARK_MS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz)) div 1000"
CHECK_MS = "epoch_us(ts) // 1000"

DEVICE_NO = "(user_id * 7 + event_id % 3) % 400"

LOG = {
    "event_id": "event_id",
    "user_id": "user_id",
    "value": "value",
    "account": f"case when event_id % 3 = 0 then '' when event_id % 7 = 0 then null"
    f" else concat('u', cast(user_id as {TEXT})) end",
    "appId": f"concat('app', cast(user_id % 3 as {TEXT}))",
    "appVersion": f"concat('1.', cast(event_id % 4 as {TEXT}))",
    "carrier": f"concat('carrier', cast(user_id % 4 as {TEXT}))",
    "deviceId": f"case when event_id % 11 = 0 then ' ' else concat('d', cast({DEVICE_NO} as {TEXT})) end",
    "eventId": "case when event_id % 97 = 0 then null else event_type end",
    "ip": f"concat(cast((user_id * 131) % 223 + 1 as {TEXT}), '.', cast(event_id % 256 as {TEXT}), '.',"
    f" cast((event_id * 7) % 256 as {TEXT}), '.9')",
    "latitude": "case when event_id % 13 = 0 then null else cast((event_id * 37) % 18001 as double) / 100 - 90 end",
    "longitude": "cast((event_id * 53) % 36001 as double) / 100 - 180",
    "netType": "case when event_id % 2 = 0 then 'wifi' else '4g' end",
    "osName": "case when user_id % 2 = 0 then 'android' else 'ios' end",
    "osVersion": f"concat('v', cast(user_id % 5 as {TEXT}))",
    "properties": "case when event_id % 83 = 0 then substr(props, 1, 4)"
    " when event_id % 5 = 0 then replace(props, '}', ', \"old\": 1}') else props end",
    "resolution": f"concat(cast(600 + user_id % 7 as {TEXT}), '*1080')",
    "sessionId": f"case when event_id % 89 = 0 then chr(9)"
    f" else concat('s', cast(user_id as {TEXT}), '_', cast(cast(ts as date) as {TEXT})) end",
    "timeStamp": "{ms}",
    "dt": f"cast(cast(ts as date) + cast(case when event_id % 20 = 0 then 1 else 0 end as int) as {TEXT})",
}


# The given tables' columns, so that no job is spent on reading footers for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log: blank devices and sessions, null events, broken JSON and late rows included."""
    columns = [F.expr(text.replace("{ms}", SPARK_MS)).alias(name) for name, text in LOG.items()]
    return load(spark, sf_dir, "events").select(*columns)


def attribution_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its user as guid."""
    return event_log(spark, sf_dir).withColumn("guid", F.col("user_id"))


#: A third of the rows is one user's, all in one millisecond; their order is that of the event's number.
BURST = {
    "user": "case when event_id % 3 = 1 then 7 else user_id end",
    "ts": "case when event_id % 3 = 1 then 1704067200123 else {ms} end",
}


def burst_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, a third of them of one user in one millisecond."""
    columns = {name: F.expr(text.replace("{ms}", SPARK_MS)) for name, text in BURST.items()}
    return load(spark, sf_dir, "events").select("event_id", columns["user"].alias("guid"), columns["ts"].alias("timeStamp"), F.col("event_type").alias("eventId"))


def cube_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with three dimensions and a whole-number measure."""
    return load(spark, sf_dir, "events").selectExpr(
        "event_type as devicetype",
        "user_id % 5 as province",
        "event_id % 2 as isnew",
        "user_id as guid",
        "cast(round(value * 100) as bigint) as acc_tml",
    )


def guid_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored keys: every fifth account, the devices with even numbers, and the counter."""
    events = load(spark, sf_dir, "events")
    accounts = events.where("user_id % 5 = 0").selectExpr(
        "'A' as kind", f"concat('u', cast(user_id as {TEXT})) as k", "user_id + 1 as guid"
    )
    devices = events.where(f"{DEVICE_NO} % 2 = 0").selectExpr(
        "'D' as kind", f"concat('d', cast({DEVICE_NO} as {TEXT})) as k", f"999000 + {DEVICE_NO} as guid"
    )
    counter = events.agg(F.lit("C").alias("kind"), F.lit("guid_cnt").alias("k"), F.lit(GUID_BASE).cast("bigint").alias("guid"))
    return accounts.unionByName(devices).distinct().unionByName(counter)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area tree: region, nation, supplier and customer as levels 1 to 4."""
    suppliers = load(spark, sf_dir, "supplier")
    nowhere = (F.lit(None).cast("double"), F.lit(None).cast("double"))

    def level(n: int, name: str, key: str, parent, label: str, place=nowhere) -> DataFrame:
        return load(spark, sf_dir, name).select(
            (F.lit(n * 10**9) + F.col(key)).alias("id"),
            parent.cast("bigint").alias("parentid"),
            F.lit(n).alias("level"),
            F.col(label).alias("areaname"),
            place[0].alias("bd09_lat"),
            place[1].alias("bd09_lng"),
        )

    position = (
        F.expr("cast((c_custkey * 37) % 18001 as double) / 100 - 90"),
        F.expr("cast((c_custkey * 53) % 36001 as double) / 100 - 180"),
    )
    parent_supplier = F.col("c_custkey") % suppliers.agg(F.count("*")).scalar()
    return (
        level(1, "region", "r_regionkey", F.lit(None), "r_name")
        .unionByName(level(2, "nation", "n_nationkey", F.lit(10**9) + F.col("n_regionkey"), "n_name"))
        .unionByName(level(3, "supplier", "s_suppkey", F.lit(2 * 10**9) + F.col("s_nationkey"), "s_name"))
        .unionByName(
            level(4, "customer", "c_custkey", F.lit(3 * 10**9) + parent_supplier, "c_name", position)
        )
    )


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address ranges of three widths for nine first octets per nation; every tenth octet is left out."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    octets = (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .select("n_name", "r_name", F.explode(F.sequence(F.col("n_nationkey") * 9 + 1, F.col("n_nationkey") * 9 + 9)).alias("o"))
        .where("o <= 223 and o % 10 <> 0")
    )
    shapes = octets.select(
        "o", "n_name", "r_name",
        F.explode(F.when(F.expr("o % 3 = 0"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(255)))).alias("b"),
    )
    start = "cast(o as bigint) * 16777216 + b * 65536"
    bounds = shapes.select(
        "o", "b", "n_name", "r_name",
        F.explode(
            F.expr(
                f"case when o % 3 = 0 then array(struct({start} as lo, {start} + 16777215 as hi))"
                f" when o % 3 = 1 then array(struct({start} as lo, {start} + 65535 as hi))"
                f" else array(struct({start} + 100 as lo, {start} + 99 * 256 + 50 as hi),"
                f" struct({start} + 100 * 256 as lo, {start} + 104 * 256 - 1 as hi)) end"
            )
        ).alias("r"),
    )
    text = (
        f"case when b % 7 = 5 then 'X|0| ||isp' when b % 7 = 6 then 'X|0|short'"
        f" else concat('X|0|', r_name, '|', n_name, '_', cast(b as {TEXT}), '|isp') end"
    )
    return bounds.select("r.lo", "r.hi", F.expr(text).alias("region"))


# The same tables as CTEs for the checking engine.
CHECK_CTES = {
    "event_log": "select "
    + ", ".join(f'{text.replace("{ms}", CHECK_MS)} as "{name}"' for name, text in LOG.items())
    + " from events",
    "burst": f"select event_id, {BURST['user']} guid, {BURST['ts'].replace('{ms}', CHECK_MS)} ts, event_type from events",
    "guid_store": f"""select distinct 'A' kind, concat('u', user_id) k, user_id + 1 guid from events where user_id % 5 = 0
        union all select distinct 'D', concat('d', {DEVICE_NO}), 999000 + {DEVICE_NO} from events where {DEVICE_NO} % 2 = 0""",
    "areas": """select 1000000000 + r_regionkey id, cast(null as bigint) parentid, 1 "level", r_name areaname,
            cast(null as double) lat, cast(null as double) lng from region
        union all select 2000000000 + n_nationkey, 1000000000 + n_regionkey, 2, n_name, null, null from nation
        union all select 3000000000 + s_suppkey, 2000000000 + s_nationkey, 3, s_name, null, null from supplier
        union all select 4000000000 + c_custkey, 3000000000 + c_custkey % (select count(*) from supplier), 4, c_name,
            cast((c_custkey * 37) % 18001 as double) / 100 - 90, cast((c_custkey * 53) % 36001 as double) / 100 - 180
        from customer""",
    "ip_ranges": """select o * 16777216 + b * 65536 + r.lo lo, o * 16777216 + b * 65536 + r.hi hi,
            case when b % 7 = 5 then 'X|0| ||isp' when b % 7 = 6 then 'X|0|short'
                 else concat('X|0|', r_name, '|', n_name, '_', b, '|isp') end region
        from (select o, b, n_name, r_name, unnest(case
                when o % 3 = 0 then [{'lo': 0, 'hi': 16777215}]
                when o % 3 = 1 then [{'lo': 0, 'hi': 65535}]
                else [{'lo': 100, 'hi': 99 * 256 + 50}, {'lo': 100 * 256, 'hi': 104 * 256 - 1}] end) r
              from (select o, n_name, r_name,
                        unnest(case when o % 3 = 0 then [0] else range(0, 256) end) b
                    from (select n_name, r_name, unnest(range(n_nationkey * 9 + 1, n_nationkey * 9 + 10)) o
                          from nation join region on n_regionkey = r_regionkey)
                    where o <= 223 and o % 10 <> 0))""",
}
