"""One query per operator and job, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall import functions as fn
from footfall.functions.days import current_day
from footfall.functions.sql import register_sql_functions
from footfall.operators import area, attribution, binding, clean, containers, detail, identity, ordering, protect, sessions, visitors
from footfall.operators.lattice import Lattice
from footfall.plans import area_dictionary, column_protection, coupon_attribution, device_binding, event_detail, visitor_cube
from footfall.sources import KeyedStore, Staging, append_days, overwrite_day, overwrite_days, read_days, read_table, replace_table, write_bucketed
from workload import derived as d

TARGET, TOUCHPOINTS = "purchase", ("click", "view", "signup")
CUBE_DIMS, CUBE_MEASURES = ("devicetype", "province", "isnew"), ("acc_tml",)
KEY = "sixteen-byte-key"

Query = Callable[[SparkSession, str], DataFrame]


# --- cleaning and normalization -------------------------------------------------------------------


def clean_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, complete, on-time rows."""
    parsed = clean.parse_properties(d.event_log(spark, sf_dir))
    kept = clean.day_window(clean.required_fields(parsed), F.col("dt"))
    return clean.strip_properties(kept, ["old"])


def parsed_properties(spark, sf_dir):
    log = clean.strip_properties(clean.parse_properties(d.event_log(spark, sf_dir)), ["old"])
    keys = F.array_join(F.array_sort(F.map_keys("properties")), ",")
    return log.select("event_id", keys.alias("prop_keys"), F.col("properties")["k"].alias("prop_k"))


def required_fields(spark, sf_dir):
    log = clean.required_fields(clean.parse_properties(d.event_log(spark, sf_dir)))
    return log.select("event_id", "deviceId", "eventId", "sessionId", F.col("properties")["k"].alias("prop_k"))


def day_window(spark, sf_dir):
    return clean.day_window(d.event_log(spark, sf_dir), F.col("dt")).select("event_id", "timeStamp", "dt")


def blank_account(spark, sf_dir):
    return clean.blank_account_to_null(d.event_log(spark, sf_dir)).select("event_id", "account")


def detail_projection(spark, sf_dir):
    rows = detail.to_detail(clean_log(spark, sf_dir), keep=("event_id", "dt"))
    return rows.withColumn("properties", F.col("properties")["k"])


def calendar_days(spark, sf_dir):
    days = d.event_log(spark, sf_dir).groupBy("dt").agg(F.count("*").alias("n_events"))
    return days.select(
        current_day(F.col("dt")).alias("day"),
        fn.previous_day(F.col("dt")).alias("previous_day"),
        fn.next_day(F.col("dt")).alias("next_day"),
        fn.day_start_ms(F.col("dt"), "Asia/Shanghai").alias("start_ms"),
        "n_events",
    )


# --- sessions -------------------------------------------------------------------------------------


def split_sessions(spark, sf_dir):
    return sessions.split_sessions(clean_log(spark, sf_dir)).select("event_id", "sessionId", "splitedSessionId")


def sessions_over_days(spark, sf_dir):
    """A session id without a date in it, split one day at a time: ids of parts are distinct over all days."""
    log = d.event_log(spark, sf_dir).where("deviceId is not null").select("event_id", "dt", "timeStamp", "deviceId")
    # Splitting by (day, device) is what a run per day does.
    split = sessions.split_sessions(log.withColumn("_s", F.concat("dt", F.lit("|"), "deviceId")), session="_s", out="_part")
    named = split.withColumn("part", F.concat("deviceId", F.lit("_"), F.element_at(F.split("_part", "_"), -1)))
    return named.rollup("dt").agg(F.count("*").alias("n_events"), F.count_distinct("part").alias("n_parts"))


# --- geography ------------------------------------------------------------------------------------


def geohash(spark, sf_dir):
    return d.event_log(spark, sf_dir).select("event_id", fn.geohash6("latitude", "longitude").alias("geohash"))


def ip_number(spark, sf_dir):
    return d.event_log(spark, sf_dir).select("event_id", "ip", fn.ipv4_to_long("ip").alias("ip_number"))


def area_tree(spark, sf_dir):
    return area.area_dictionary(d.areas(spark, sf_dir))


def located_by_position(spark, sf_dir):
    dictionary = area.area_dictionary(d.areas(spark, sf_dir))
    rows = area.locate_by_position(d.event_log(spark, sf_dir), dictionary)
    return rows.select("event_id", "gps_area.province", "gps_area.city", "gps_area.region")


def located_by_ip(spark, sf_dir):
    log = d.event_log(spark, sf_dir).withColumn("ip_no", fn.ipv4_to_long("ip"))
    return area.locate_by_ip(log, d.ip_ranges(spark, sf_dir), "ip_no").select("event_id", "ip", "ip_region")


def located_by_ip_overlap(spark, sf_dir):
    """Every range lies inside one that starts earlier, and within a tier ranges reach into each other."""
    log = d.event_log(spark, sf_dir).withColumn("ip_no", fn.ipv4_to_long("ip"))
    own = d.ip_ranges(spark, sf_dir)
    wider = own.select((F.col("lo") - 5000).alias("lo"), (F.col("hi") + 70_000).alias("hi"), F.concat(F.lit("around "), "region").alias("region"))
    return area.locate_by_ip(log, own.unionByName(wider), "ip_no").select("event_id", "ip", "ip_region")


def located_events(spark, sf_dir):
    dictionary = area.area_dictionary(d.areas(spark, sf_dir))
    ranges = d.ip_ranges(spark, sf_dir)
    small = area.fits_broadcast(dictionary, ranges)
    rows = area.locate_events(d.event_log(spark, sf_dir), dictionary, ranges, small=small)
    return rows.select("event_id", "province", "city", "region")


# --- binding --------------------------------------------------------------------------------------


def _scores(spark, sf_dir, when: str = "true", literal: bool = False) -> DataFrame:
    return binding.daily_scores(binding.binding_events(d.event_log(spark, sf_dir).where(when), literal))


def _merged(spark, sf_dir, literal: bool) -> DataFrame:
    today = _scores(spark, sf_dir, f"dt >= '{d.MIDDLE_DAY}'", literal)
    before = _scores(spark, sf_dir, f"dt < '{d.MIDDLE_DAY}'", literal)
    merged = binding.merge_scores(today, before, literal)
    return merged.withColumn("score", F.col("score").cast("double"))


def daily_scores(spark, sf_dir):
    return _scores(spark, sf_dir)


def merged_scores(spark, sf_dir):
    return _merged(spark, sf_dir, literal=False)


def merged_scores_literal(spark, sf_dir):
    return _merged(spark, sf_dir, literal=True)


def merged_scores_bucketed(spark, sf_dir):
    """The merge of two score tables that are stored in the same buckets, so neither moves."""
    stage, tables = Staging(spark), []
    for side, when in (("today", f"dt >= '{d.MIDDLE_DAY}'"), ("before", f"dt < '{d.MIDDLE_DAY}'")):
        name = f"scores_{side}_{uuid.uuid4().hex}"
        keyed = binding.with_account_key(_scores(spark, sf_dir, when))
        tables.append(write_bucketed(keyed, name, device_binding.BUCKET_KEYS, 8, stage.location(side)))
    merged = binding.merge_bucketed(*tables).drop("account_key")
    return merged.withColumn("score", F.col("score").cast("double"))


def best_accounts(spark, sf_dir):
    return binding.best_accounts(_scores(spark, sf_dir))


def filled_accounts(spark, sf_dir):
    log = clean.blank_account_to_null(d.event_log(spark, sf_dir))
    return binding.fill_accounts(log, _scores(spark, sf_dir)).select("event_id", "account", "filledAccount")


# --- identity -------------------------------------------------------------------------------------


def _resolved(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Complete rows whose own account is the only one known, so that a third stays anonymous."""
    stage = Staging(spark)
    log = clean.blank_account_to_null(clean_log(spark, sf_dir))
    rows = log.select("event_id", "timeStamp", "deviceId", F.col("account").alias("filledAccount"))
    return identity.resolve(stage(rows, "keys"), d.guid_store(spark, sf_dir), d.GUID_BASE, stage)


def assigned_guids(spark, sf_dir):
    return _resolved(spark, sf_dir)[0].select("event_id", "deviceId", "filledAccount", "guid")


def new_visitors(spark, sf_dir):
    return _resolved(spark, sf_dir)[0].groupBy("isnew").agg(
        F.count("*").alias("n_events"), F.count_distinct("guid").alias("n_visitors")
    )


def next_guid_store(spark, sf_dir):
    return _resolved(spark, sf_dir)[1]


def bucketed_guid_store(spark, sf_dir):
    """The next store, from a store in buckets and the delta of the batch: written, written again, folded in and read back."""
    stage = Staging(spark)
    store = KeyedStore(spark, stage.location("guids"), identity.STORE_SCHEMA, ["kind", "k"], buckets=16)
    store.replace(d.guid_store(spark, sf_dir))
    log = clean.blank_account_to_null(clean_log(spark, sf_dir))
    rows = log.select("event_id", "timeStamp", "deviceId", F.col("account").alias("filledAccount"))
    for _ in range(2):
        known = stage(store.read(before=d.LAST_DAY), "known")
        _, changes = identity.resolve(stage(rows, "keys"), known, d.GUID_BASE, stage, changes_only=True)
        store.write_day(d.LAST_DAY, changes)
    store.compact()
    return store.read()


def dense_numbers(spark, sf_dir):
    log = d.event_log(spark, sf_dir)
    return ordering.dense_numbers(log, ["timeStamp", "event_id"], "number", base=100).select("event_id", "number")


# --- attribution ----------------------------------------------------------------------------------


def _segments(spark, sf_dir) -> DataFrame:
    return attribution.event_segments(d.attribution_events(spark, sf_dir), TARGET, TOUCHPOINTS, tie=("event_id",))


def ordered_events(spark, sf_dir):
    placed = attribution.ordered_events(d.attribution_events(spark, sf_dir), tie=("event_id",))
    return placed.select("guid", "position", "timeStamp", "event_id")


def event_lists(spark, sf_dir):
    lists = attribution.event_lists(d.attribution_events(spark, sf_dir), part_size=50)
    return lists.select("guid", "part", F.array_join("events", ",").alias("events"))


def event_segments(spark, sf_dir):
    touches = _segments(spark, sf_dir).where("not is_target")
    return touches.select("guid", "segment", "timeStamp", "eventId", "event_id")


def linear_attribution(spark, sf_dir):
    return attribution.linear_weights(_segments(spark, sf_dir), TARGET)


def linear_attribution_converted(spark, sf_dir):
    return attribution.linear_weights(_segments(spark, sf_dir), TARGET, converted_only=True)


def burst_positions(spark, sf_dir):
    """Places of events of which a third are one user's in one millisecond."""
    return attribution.ordered_events(d.burst_events(spark, sf_dir), tie=("event_id",)).select("guid", "position", "event_id")


def burst_attribution(spark, sf_dir):
    """Weights of the same events: the burst is cut into segments like any other time."""
    segments = attribution.event_segments(d.burst_events(spark, sf_dir), TARGET, TOUCHPOINTS, tie=("event_id",))
    return attribution.linear_weights(segments, TARGET)


# --- visitor cube ---------------------------------------------------------------------------------


def _cuboid(spark, sf_dir) -> DataFrame:
    return visitors.base_cuboid(d.cube_events(spark, sf_dir), CUBE_DIMS, measures=CUBE_MEASURES)


def visitor_bitmaps(spark, sf_dir):
    lines = d.load(spark, sf_dir, "lineitem")
    bitmaps = visitors.base_cuboid(lines, ["l_returnflag", "l_shipdate"], "l_orderkey")
    return bitmaps.select(
        "l_returnflag",
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
        "bucket",
        F.bitmap_count("uv_bitmap").alias("n_ids"),
    )


def united_bitmaps(spark, sf_dir):
    united = visitors.union_bitmaps(
        visitors.base_cuboid(d.load(spark, sf_dir, "lineitem"), ["l_returnflag", "l_shipdate"], "l_orderkey"),
        ["l_returnflag"],
    )
    return united.select("l_returnflag", "bucket", F.bitmap_count("uv_bitmap").alias("n_ids"))


def bitmap_cardinality(spark, sf_dir):
    lines = d.load(spark, sf_dir, "lineitem")
    return visitors.visitor_counts(visitors.base_cuboid(lines, ["l_suppkey"], "l_partkey"), ["l_suppkey"], out="n_parts")


def base_cuboid(spark, sf_dir):
    return visitors.visitor_counts(_cuboid(spark, sf_dir), CUBE_DIMS, CUBE_MEASURES)


def cube_rollup(spark, sf_dir):
    return visitor_cube.report(_cuboid(spark, sf_dir), ["province"])


def cube_rollup_twice(spark, sf_dir):
    by_two = visitors.roll_up(_cuboid(spark, sf_dir), ["devicetype", "province"], CUBE_MEASURES)
    return visitor_cube.report(by_two, ["devicetype"])


def sparse_cuboid(spark, sf_dir):
    """Sets that are lists where a bitmap would be nearly empty."""
    lines = d.load(spark, sf_dir, "lineitem")
    sets = containers.base_sets(lines, ["l_returnflag", "l_shipdate"], "l_orderkey")
    day = F.col("l_shipdate").cast("date").cast("string").alias("day")
    return sets.select("l_returnflag", day, "bucket", containers.set_size().alias("n_ids"))


def sparse_rollup(spark, sf_dir):
    """A roll-up of such a stored cuboid: lists and bitmaps are united, and lists that grow become bitmaps."""
    lines = d.load(spark, sf_dir, "lineitem").withColumn("lines", F.lit(1).cast("bigint"))
    stored = Staging(spark)(containers.base_sets(lines, ["l_returnflag", "l_suppkey"], "l_orderkey", ["lines"]), "sets")
    return containers.set_counts(containers.union_sets(stored, ["l_returnflag"], ["lines"]), ["l_returnflag"], ["lines"], out="n_orders")


def lattice_report(spark, sf_dir):
    """A report from the smallest of three stored cuboids that has its dimension."""
    cube = Lattice(spark, Staging(spark).location("cube"), CUBE_MEASURES)
    cube.store(_cuboid(spark, sf_dir), CUBE_DIMS, [["province", "isnew"], ["devicetype"]])
    return cube.report(["province"])


# --- encryption -----------------------------------------------------------------------------------


def encrypted_column(spark, sf_dir):
    sealed = protect.encrypt_column(d.load(spark, sf_dir, "customer"), "c_name", KEY, "sealed")
    return sealed.groupBy("c_mktsegment").agg(
        F.count_distinct("sealed").alias("n_sealed"), F.sum(F.length("sealed")).alias("sealed_bytes")
    )


def decrypted_column(spark, sf_dir):
    orders = d.load(spark, sf_dir, "orders").withColumn("note", F.concat_ws("/", "o_orderstatus", "o_orderpriority"))
    sealed = protect.encrypt_column(orders, "note", KEY, "sealed").drop("note")
    return protect.decrypt_column(sealed, "sealed", KEY, "note").select("o_orderkey", "note")


def protection_job(spark, sf_dir):
    people = d.load(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name as id_number")
    return column_protection.build(people, KEY).select(
        "c_custkey", "decrypted_id", F.length("encrypted_id").alias("sealed_bytes")
    )


# --- sinks and jobs over tables -------------------------------------------------------------------


def overwritten_days(spark, sf_dir):
    stage = Staging(spark)
    log = d.event_log(spark, sf_dir).select("event_id", "eventId", "dt")
    path = stage.location("days")
    overwrite_days(log.withColumn("eventId", F.lit("old")), path, rebalance=True)
    overwrite_days(log.where(f"dt >= '{d.MIDDLE_DAY}'"), path, rebalance=True)
    return read_table(spark, path).withColumn("dt", F.col("dt").cast("string"))


def emptied_day(spark, sf_dir):
    stage = Staging(spark)
    log = d.event_log(spark, sf_dir).select("event_id", "eventId", "dt")
    path = stage.location("days")
    overwrite_days(log, path, rebalance=True)
    overwrite_day(log.where("false"), path, d.MIDDLE_DAY)
    return read_table(spark, path).withColumn("dt", F.col("dt").cast("string"))


def appended_days(spark, sf_dir):
    stage = Staging(spark)
    log = d.event_log(spark, sf_dir).select("event_id", "eventId", "dt")
    path = stage.location("days")
    append_days(log, path)
    append_days(log.where(f"dt >= '{d.MIDDLE_DAY}'"), path)
    return read_days(spark, path, d.FIRST_DAY, "2025-01-01").withColumn("dt", F.col("dt").cast("string"))


def area_job(spark, sf_dir):
    stage = Staging(spark)
    replace_table(d.areas(spark, sf_dir), stage.location("areas"))
    area_dictionary.run(spark, stage.location("areas"), stage.location("dictionary"))
    return read_table(spark, stage.location("dictionary"))


def binding_job(spark, sf_dir):
    """Two score days; each takes the log of half of the month as its day."""
    stage = Staging(spark)
    half = F.when(F.col("dt") < d.MIDDLE_DAY, d.FIRST_DAY).otherwise(d.MIDDLE_DAY)
    overwrite_days(d.event_log(spark, sf_dir).withColumn("dt", half), stage.location("log"))
    scores = stage.location("scores")
    first = read_days(spark, stage.location("log"), d.FIRST_DAY)
    nothing = spark.createDataFrame([], "deviceid string, account string, score decimal(22,1), last_login bigint")
    overwrite_days(device_binding.build(first, nothing).withColumn("dt", F.lit(d.FIRST_DAY)), scores)
    device_binding.run(spark, stage.location("log"), scores, d.FIRST_DAY, d.MIDDLE_DAY)
    return read_table(spark, scores).withColumns(
        {"dt": F.col("dt").cast("string"), "score": F.col("score").cast("double")}
    )


def _detail_inputs(spark, sf_dir, stage) -> event_detail.Inputs:
    """What the job reads besides the log, from tables as the job finds them."""
    return event_detail.Inputs(
        dictionary=stage(area.area_dictionary(d.areas(spark, sf_dir)), "dictionary"),
        ip_ranges=stage(d.ip_ranges(spark, sf_dir), "ip_ranges"),
        scores=_scores(spark, sf_dir),
        store=stage(d.guid_store(spark, sf_dir), "store"),
        base=d.GUID_BASE,
    )


def _raw_log(spark, sf_dir) -> DataFrame:
    return clean.parse_properties(d.event_log(spark, sf_dir)).drop("user_id", "value")


def _detail(spark, sf_dir, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The whole month as one batch; every row has to lie in the day it is filed under."""
    stage = Staging(spark)
    log, inputs = stage(_raw_log(spark, sf_dir), "log"), _detail_inputs(spark, sf_dir, stage)
    return event_detail.build(log, inputs, stage, F.col("dt"), keep=keep)


def _shown(detail: DataFrame) -> DataFrame:
    return detail.select(
        "event_id", "account", "deviceId", "eventId", "splitedSessionId", "filledAccount",
        "province", "city", "region", "guid", "isnew", F.col("properties")["k"].alias("prop_k"),
    )


def detail_job(spark, sf_dir):
    return _shown(_detail(spark, sf_dir, keep=("event_id",))[0])


def _detail_repeated(spark, sf_dir, broadcast_rows: int | None = None) -> DataFrame:
    """A tenth of the log arrives twice; rows are known by their place in the files."""
    stage = Staging(spark)
    log = _raw_log(spark, sf_dir)
    stored = stage(log.unionByName(log.where("event_id % 10 = 0")), "log")
    rows = event_detail.located_rows(stored, stage)
    inputs = _detail_inputs(spark, sf_dir, stage)
    detail, _ = event_detail.build(
        rows, inputs, stage, F.col("dt"), row_id=event_detail.PLACE, ties=("event_id", event_detail.CONTENT),
        keep=("event_id",), broadcast_rows=broadcast_rows,
    )
    return _shown(detail)


def detail_job_repeated(spark, sf_dir):
    return _detail_repeated(spark, sf_dir)


def detail_job_repeated_shuffled(spark, sf_dir):
    """The same beyond the broadcast bound."""
    return _detail_repeated(spark, sf_dir, broadcast_rows=0)


def detail_job_store(spark, sf_dir):
    return _detail(spark, sf_dir)[1]


def attribution_job(spark, sf_dir):
    """Every day of the detail table, attributed within the whole month."""
    stage = Staging(spark)
    columns = ("guid", "eventId", "timeStamp")
    month = d.attribution_events(spark, sf_dir).select(*columns).withColumn("dt", F.lit(d.FIRST_DAY))
    overwrite_days(month, stage.location("detail"))
    coupon_attribution.run(
        spark, stage.location("detail"), stage.location("weights"), d.FIRST_DAY, target=TARGET, touchpoints=TOUCHPOINTS
    )
    return read_table(spark, stage.location("weights")).withColumn("dt", F.col("dt").cast("string"))


def cube_job(spark, sf_dir):
    """Page views written as CSV, their base cuboid stored once, and a report from storage."""
    stage = Staging(spark)
    views = d.cube_events(spark, sf_dir).selectExpr(
        "cast(guid as int) as guid", "'' as ip", "'' as sesid", "'' as pgid", "'' as jpout",
        "cast(acc_tml as int) as acc_tml", "devicetype as deviceType", "cast(province as string) as province",
        "cast(isnew as int) as isnew",
    )
    views.write.csv(stage.location("views"), header=True)
    stored = visitor_cube.run(spark, stage.location("views"), stage.location("cuboid"))
    return visitor_cube.report(stored, ["devicetype", "isnew"])


def sql_functions(spark, sf_dir):
    """The functions a SQL text calls by name."""
    register_sql_functions(spark)
    return spark.sql(
        """select deviceId, isNotBlank(deviceId) as has_device, count(distinct geo(latitude, longitude)) as n_cells,
                  count(distinct event_id) as n_events
           from {log} group by deviceId""",
        log=d.event_log(spark, sf_dir),
    )


def sql_cube(spark, sf_dir):
    """A roll-up written as SQL over the stored bitmaps."""
    register_sql_functions(spark)
    return spark.sql(
        """select province, sum(getCnt(bm)) as uv, sum(acc_tml) as acc_tml
           from (select province, bucket, bitmap_or_agg(uv_bitmap) as bm, sum(acc_tml) as acc_tml
                 from {cuboid} group by province, bucket)
           group by province""",
        cuboid=_cuboid(spark, sf_dir),
    )


ALL: dict[str, Query] = {
    query.__name__: query
    for query in (
        parsed_properties, required_fields, day_window, blank_account, detail_projection, calendar_days,
        split_sessions, sessions_over_days,
        geohash, ip_number, area_tree, located_by_position, located_by_ip, located_by_ip_overlap, located_events,
        daily_scores, merged_scores, merged_scores_literal, best_accounts, filled_accounts,
        assigned_guids, new_visitors, next_guid_store, dense_numbers,
        event_lists, event_segments, linear_attribution, linear_attribution_converted,
        visitor_bitmaps, united_bitmaps, bitmap_cardinality, base_cuboid, cube_rollup, cube_rollup_twice,
        encrypted_column, decrypted_column, protection_job,
        overwritten_days, emptied_day, appended_days, area_job, binding_job, detail_job, detail_job_repeated, detail_job_repeated_shuffled, detail_job_store,
        attribution_job, cube_job, ordered_events, sql_functions, sql_cube,
        burst_positions, burst_attribution, sparse_cuboid, sparse_rollup, bucketed_guid_store, merged_scores_bucketed, lattice_report,
    )
}
