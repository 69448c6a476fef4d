"""SQL counterparts of the queries, written against the given tables.

Each is formulated on its own: plain windows where the operators split keys, counts where they use
bitmaps, a join on BETWEEN where they use buckets.
"""

from __future__ import annotations

from workload.derived import CHECK_CTES, FIRST_DAY, GUID_BASE, MIDDLE_DAY
from workload.queries import TARGET, TOUCHPOINTS

BLANK = r"'^\s*$'"

CTES = dict(CHECK_CTES)
CTES["parsed_log"] = """select * replace (case when json_valid(properties) then json_extract_string(properties, '$.k') end
        as properties) from event_log"""
CTES["complete_log"] = rf"""select * from parsed_log
        where not regexp_full_match(coalesce("deviceId", ''), '\s*')
        and not regexp_full_match(coalesce("eventId", ''), '\s*')
        and not regexp_full_match(coalesce("sessionId", ''), '\s*') and properties is not null"""
CTES["clean_log"] = """select * from complete_log
        where "timeStamp" >= epoch_ms(cast(dt as timestamp)) and "timeStamp" < epoch_ms(cast(dt as timestamp)) + 86400000"""


def split_cte(source: str) -> str:
    return f"""select *, concat("sessionId", '_', max(case when cut then "timeStamp" end) over (partition by "sessionId" order by "timeStamp", event_id
            rows unbounded preceding)) split_id
        from (select *, coalesce("timeStamp" - lag("timeStamp") over (partition by "sessionId"
                order by "timeStamp", event_id) > 1800000, true) cut from {source})"""


CTES["area_dict"] = """select hashes.geohash, l1.areaname province, l2.areaname city, l3.areaname region
        from (select id, parentid, concat(substr(a, 1 + cast(v >> 25 & 31 as int), 1), substr(a, 1 + cast(v >> 20 & 31 as int), 1),
                  substr(a, 1 + cast(v >> 15 & 31 as int), 1), substr(a, 1 + cast(v >> 10 & 31 as int), 1),
                  substr(a, 1 + cast(v >> 5 & 31 as int), 1), substr(a, 1 + cast(v & 31 as int), 1)) geohash
              from (select id, parentid, '0123456789bcdefghjkmnpqrstuvwxyz' a,
                        list_sum(list_transform(range(0, 15), lambda b: ((x >> b) & 1) * (1 << (2 * b + 1)) + ((y >> b) & 1) * (1 << (2 * b)))) ::bigint v
                    from (select id, parentid, least(floor((lng + 180) / 360 * 32768)::bigint, 32767) x,
                              least(floor((lat + 90) / 180 * 32768)::bigint, 32767) y from areas where "level" = 4))) hashes
        join areas l3 on hashes.parentid = l3.id join areas l2 on l3.parentid = l2.id join areas l1 on l2.parentid = l1.id"""
CTES["event_hash"] = """select event_id, case when v is not null then concat(substr(a, 1 + cast(v >> 25 & 31 as int), 1),
            substr(a, 1 + cast(v >> 20 & 31 as int), 1), substr(a, 1 + cast(v >> 15 & 31 as int), 1),
            substr(a, 1 + cast(v >> 10 & 31 as int), 1), substr(a, 1 + cast(v >> 5 & 31 as int), 1),
            substr(a, 1 + cast(v & 31 as int), 1)) end geohash
        from (select event_id, '0123456789bcdefghjkmnpqrstuvwxyz' a,
                  case when latitude is not null and longitude is not null then list_sum(list_transform(range(0, 15),
                      lambda b: ((x >> b) & 1) * (1 << (2 * b + 1)) + ((y >> b) & 1) * (1 << (2 * b)))) end ::bigint v
              from (select event_id, latitude, longitude, least(floor((longitude + 180) / 360 * 32768)::bigint, 32767) x,
                        least(floor((latitude + 90) / 180 * 32768)::bigint, 32767) y from event_log))"""
CTES["place_of_hash"] = """select geohash, province, city, region from (select *, row_number() over
        (partition by geohash order by province, city, region) r from area_dict) where r = 1"""
CTES["gps"] = """select event_id, p.geohash is not null hit, province, city, region
        from event_hash e left join place_of_hash p on e.geohash = p.geohash"""
CTES["ip_no"] = """select event_id, ip, cast(split_part(ip, '.', 1) as bigint) * 16777216 + cast(split_part(ip, '.', 2) as bigint) * 65536
        + cast(split_part(ip, '.', 3) as bigint) * 256 + cast(split_part(ip, '.', 4) as bigint) n from event_log"""
CTES["ip_hit"] = """select i.event_id, i.ip, r.region ip_region from ip_no i left join ip_ranges r on i.n between r.lo and r.hi"""
CTES["place"] = """select g.event_id, case when hit then province when usable then split_part(ip_region, '|', 3) end province,
            case when hit then city when usable then split_part(ip_region, '|', 4) end city, region
        from gps g join (select event_id, ip_region, coalesce(split_part(ip_region, '|', 5) <> ''
                and trim(split_part(ip_region, '|', 3)) <> '' and trim(split_part(ip_region, '|', 4)) <> '', false) usable
            from ip_hit) i on g.event_id = i.event_id"""


def scores_sql(where: str = "true", account: str = "nullif(account, '')") -> str:
    return f"""select "deviceId" deviceid, {account} account, 100 * count(distinct "sessionId") score,
        max("timeStamp") last_login from event_log where "eventId" is not null and {where} group by 1, 2"""


def best_sql(scores: str) -> str:
    return f"""select deviceid, account from (select *, row_number() over (partition by deviceid
        order by score desc, last_login desc, account) r from ({scores}) where account is not null) where r = 1"""


LITERAL_ACCOUNT = "case when account = '' then 'null' else account end"
FIRST_HALF, SECOND_HALF = f"dt < '{MIDDLE_DAY}'", f"dt >= '{MIDDLE_DAY}'"


def guid_ctes(rows: str) -> dict[str, str]:
    """The set-based form of the sequential rule over ``rows`` (event_id, ts, dev, acc), with plain windows."""
    return {
        "g_rows": rows,
        "g_first": """select *, row_number() over (partition by acc order by ts, event_id) rn from g_rows where acc is not null
            and acc not in (select k from guid_store where kind = 'A')""",
        "g_line": """select event_id, ts, dev, cast(null as varchar) acc from g_rows where acc is null
            union all select event_id, ts, dev, acc from g_first where rn = 1""",
        "g_prev": """select l.*, s.guid dg, row_number() over w place, lag(acc) over w prev_acc
            from g_line l left join guid_store s on s.kind = 'D' and s.k = l.dev
            window w as (partition by dev order by ts, event_id)""",
        "g_alloc": """select *, not ((place = 1 and dg is not null) or (place > 1 and prev_acc is null)) alloc from g_prev""",
        "g_number": f"""select *, case when alloc then {GUID_BASE} + count(*) filter (where alloc) over (order by ts, event_id) end num
            from g_alloc""",
        "g_guid": """select *, case when alloc then num else coalesce(last_value(case when acc is null then num end ignore nulls)
                over (partition by dev order by ts, event_id rows between unbounded preceding and 1 preceding), dg) end guid
            from g_number""",
        "g_account": """select k acc, guid from guid_store where kind = 'A'
            union all select acc, guid from g_guid where acc is not null""",
        "g_all": """select r.event_id, r.dev, r.acc, a.guid from g_rows r join g_account a on r.acc = a.acc
            union all select event_id, dev, acc, guid from g_guid where acc is null""",
        "g_store": f"""select 'A' kind, acc k, guid from g_account
            union all select 'D', dev, guid from (select *, row_number() over (partition by dev order by ts desc, event_id desc) last
                from g_guid) where last = 1 and acc is null
            union all select kind, k, guid from guid_store where kind = 'D' and k not in (select dev from g_line)
            union all select 'C', 'guid_cnt', {GUID_BASE} + (select count(*) from g_guid where alloc)""",
    }


OWN_ACCOUNT_ROWS = """select event_id, "timeStamp" ts, "deviceId" dev, nullif(account, '') acc from clean_log"""
FILLED_ROWS = f"""select event_id, "timeStamp" ts, m."deviceId" dev, coalesce(nullif(m.account, ''), b.account) acc
    from clean_log m left join ({best_sql(scores_sql())}) b on m."deviceId" = b.deviceid"""

DETAIL = f"""select s.event_id, nullif(s.account, '') account, s."deviceId", s."eventId", s.split_id "splitedSessionId",
        g.acc "filledAccount", p.province, p.city, p.region, g.guid, cast(g.guid > {GUID_BASE} as integer) isnew, s.properties prop_k
    from split_log s join g_all g on s.event_id = g.event_id join place p on s.event_id = p.event_id"""

EVENT_NAMES = ", ".join(f"'{name}'" for name in (TARGET, *TOUCHPOINTS))
SEGMENTS = {
    "numbered": f"""select user_id guid, "eventId" event, "timeStamp" ts, event_id, coalesce(sum(case when "eventId" = '{TARGET}' then 1 else 0 end)
            over (partition by user_id order by "timeStamp", "eventId", event_id
                rows between unbounded preceding and 1 preceding), 0) segment
        from event_log where "eventId" in ({EVENT_NAMES})""",
    "touches": f"""select n.*, exists (select 1 from numbered t where t.guid = n.guid and t.segment = n.segment and t.event = '{TARGET}') converted
        from numbered n where event <> '{TARGET}'""",
}
WEIGHTS = f"""select '优惠券获取归因分析' model, '线性归因' strategy, guid, '{TARGET}' dest_event, event attr_event,
    cast(100 as double) / count(*) over (partition by guid, segment) weight from touches"""
BURST_SEGMENTS = {
    "numbered": f"""select guid, event_type event, ts, event_id, coalesce(sum(case when event_type = '{TARGET}' then 1 else 0 end)
            over (partition by guid order by ts, event_type, event_id rows between unbounded preceding and 1 preceding), 0) segment
        from burst where event_type in ({EVENT_NAMES})""",
    "touches": f"select * from numbered where event <> '{TARGET}'",
}

CUBE = {
    "cube_events": """select event_type devicetype, user_id % 5 province, event_id % 2 isnew, user_id guid,
        cast(round(value * 100) as bigint) acc_tml from events"""
}
BUCKET = "case when {0} > 0 then 1 + ({0} - 1) // 32768 else 0 end"


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the CTEs it needs, found by name."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name, sql in known.items():
            if name in words and name not in needed:
                visit(sql)
                if name not in needed:
                    needed.append(name)

    visit(body)
    head = ",\n".join(f"{name} as ({known[name]})" for name in needed)
    return f"with {head}\n{body}" if needed else body


def cube_sql(dims: str) -> str:
    return f"""select {dims}, count(distinct guid) uv, cast(sum(acc_tml) as bigint) acc_tml from cube_events group by {dims}"""


def merged_sql(account: str, same_account: str, decayed: str) -> str:
    return f"""select coalesce(t.deviceid, b.deviceid) deviceid, coalesce(t.account, b.account) account,
        cast(case when t.score is null then {decayed} when b.score is null then t.score else t.score + b.score end as double) score,
        coalesce(t.last_login, b.last_login) last_login
        from ({scores_sql(SECOND_HALF, account)}) t full join ({scores_sql(FIRST_HALF, account)}) b
        on t.deviceid = b.deviceid and {same_account}"""


def build() -> dict[str, str]:
    own, filled = guid_ctes(OWN_ACCOUNT_ROWS), guid_ctes(FILLED_ROWS)
    null_safe = "t.account is not distinct from b.account"
    cleaned = {"split_log": split_cte("clean_log")}
    whole = {**filled, **cleaned, "detail": DETAIL}
    return {
        "parsed_properties": with_ctes(
            "select event_id, case when properties is not null then 'k' end prop_keys, properties prop_k from parsed_log"
        ),
        "required_fields": with_ctes(
            'select event_id, "deviceId", "eventId", "sessionId", properties prop_k from complete_log'
        ),
        "day_window": with_ctes(
            """select event_id, "timeStamp", dt from event_log where "timeStamp" >= epoch_ms(cast(dt as timestamp))
            and "timeStamp" < epoch_ms(cast(dt as timestamp) + interval 1 day)"""
        ),
        "blank_account": with_ctes("select event_id, nullif(account, '') account from event_log"),
        "detail_projection": with_ctes(
            """select nullif(account, '') account, "appId", "appVersion", carrier, "deviceId", "eventId", ip, latitude, longitude,
            "netType", "osName", "osVersion", properties, resolution, "sessionId", "timeStamp",
            cast(null as varchar) "splitedSessionId", cast(null as varchar) "filledAccount", cast(null as varchar) province,
            cast(null as varchar) city, cast(null as varchar) region, cast(-1 as bigint) guid, cast(0 as integer) isnew,
            event_id, dt from clean_log"""
        ),
        "calendar_days": with_ctes(
            """select dt "day", cast(cast(dt as date) - 1 as varchar) previous_day, cast(cast(dt as date) + 1 as varchar) next_day,
            epoch_ms(cast(dt as timestamp)) - 8 * 3600000 start_ms, count(*) n_events from event_log group by dt"""
        ),
        "split_sessions": with_ctes('select event_id, "sessionId", split_id "splitedSessionId" from split_log', cleaned),
        "geohash": with_ctes("select event_id, geohash from event_hash"),
        "ip_number": with_ctes("select event_id, ip, n ip_number from ip_no"),
        "area_tree": with_ctes("select geohash, province, city, region from area_dict"),
        "located_by_position": with_ctes("select event_id, province, city, region from gps"),
        "located_by_ip": with_ctes("select event_id, ip, ip_region from ip_hit"),
        "located_by_ip_overlap": with_ctes(
            """select event_id, ip, region ip_region from (
                select i.event_id, i.ip, r.region, row_number() over (partition by i.event_id order by r.lo desc, r.hi, r.region desc) place
                from ip_no i left join (select lo, hi, region from ip_ranges
                    union all select lo - 5000, hi + 70000, concat('around ', region) from ip_ranges) r on i.n between r.lo and r.hi)
            where place = 1"""
        ),
        "located_events": with_ctes("select event_id, province, city, region from place"),
        "daily_scores": with_ctes(scores_sql()),
        "merged_scores": with_ctes(merged_sql("nullif(account, '')", null_safe, "round(b.score * 0.6, 1)")),
        "merged_scores_literal": with_ctes(merged_sql(LITERAL_ACCOUNT, "t.account = b.account", "null")),
        "best_accounts": with_ctes(best_sql(scores_sql())),
        "filled_accounts": with_ctes(
            f"""select event_id, nullif(l.account, '') account, coalesce(nullif(l.account, ''), b.account) "filledAccount"
            from event_log l left join ({best_sql(scores_sql())}) b on l."deviceId" = b.deviceid"""
        ),
        "assigned_guids": with_ctes('select event_id, dev "deviceId", acc "filledAccount", guid from g_all', own),
        "new_visitors": with_ctes(
            f"""select cast(guid > {GUID_BASE} as integer) isnew, count(*) n_events, count(distinct guid) n_visitors
            from g_all group by 1""",
            own,
        ),
        "next_guid_store": with_ctes("select kind, k, guid from g_store", own),
        "dense_numbers": with_ctes(
            'select event_id, 100 + row_number() over (order by "timeStamp", event_id) number from event_log'
        ),
        "event_lists": with_ctes(
            """select guid, (rn - 1) // 50 part, string_agg(e, ',' order by rn) events from (
                select user_id guid, concat_ws('_', "timeStamp", "eventId") e,
                    row_number() over (partition by user_id order by "timeStamp", "eventId", event_id) rn
                from event_log) group by 1, 2"""
        ),
        "event_segments": with_ctes(
            'select guid, cast(segment as bigint) segment, ts "timeStamp", event "eventId", event_id from touches', SEGMENTS
        ),
        "linear_attribution": with_ctes(WEIGHTS, SEGMENTS),
        "linear_attribution_converted": with_ctes(f"{WEIGHTS} where converted", SEGMENTS),
        "visitor_bitmaps": f"""select l_returnflag, cast(cast(l_shipdate as date) as varchar) "day",
            {BUCKET.format("l_orderkey")} bucket, count(distinct l_orderkey) n_ids from lineitem group by 1, 2, 3""",
        "united_bitmaps": f"""select l_returnflag, {BUCKET.format("l_orderkey")} bucket, count(distinct l_orderkey) n_ids
            from lineitem group by 1, 2""",
        "bitmap_cardinality": "select l_suppkey, count(distinct l_partkey) n_parts from lineitem group by 1",
        "base_cuboid": with_ctes(cube_sql("devicetype, province, isnew"), CUBE),
        "cube_rollup": with_ctes(cube_sql("province"), CUBE),
        "cube_rollup_twice": with_ctes(cube_sql("devicetype"), CUBE),
        "encrypted_column": """select c_mktsegment, count(distinct c_name) n_sealed,
            cast(sum((strlen(c_name) // 16 + 1) * 16) as bigint) sealed_bytes from customer group by 1""",
        "decrypted_column": "select o_orderkey, concat_ws('/', o_orderstatus, o_orderpriority) note from orders",
        "protection_job": """select c_custkey, c_name decrypted_id, cast((strlen(c_name) // 16 + 1) * 16 as integer) sealed_bytes
            from customer""",
        "overwritten_days": with_ctes(
            f"""select event_id, case when dt >= '{MIDDLE_DAY}' then "eventId" else 'old' end "eventId", dt from event_log"""
        ),
        "emptied_day": with_ctes(f"""select event_id, "eventId", dt from event_log where dt <> '{MIDDLE_DAY}'"""),
        "sessions_over_days": with_ctes(
            """select dt, count(*) n_events, count(distinct concat(s, '_', part)) n_parts from (
                select *, max(case when cut then "timeStamp" end) over (partition by dt, s order by "timeStamp", event_id rows unbounded preceding) part
                from (select *, coalesce("timeStamp" - lag("timeStamp") over (partition by dt, s order by "timeStamp", event_id) > 1800000, true) cut
                    from (select event_id, dt, "timeStamp", "deviceId" s from event_log where "deviceId" is not null))) group by rollup (dt)"""
        ),
        "appended_days": with_ctes(
            f"""select event_id, "eventId", dt from event_log union all
            select event_id, "eventId", dt from event_log where dt >= '{MIDDLE_DAY}'"""
        ),
        "area_job": with_ctes("select geohash, province, city, region from area_dict"),
        "binding_job": with_ctes(
            f"""select deviceid, account, cast(score as double) score, last_login, '{FIRST_DAY}' dt
                from ({scores_sql(FIRST_HALF)}) s
            union all select deviceid, account, score, last_login, '{MIDDLE_DAY}'
                from ({merged_sql("nullif(account, '')", null_safe, "round(b.score * 0.6, 1)")}) m"""
        ),
        "detail_job": with_ctes("select * from detail", whole),
        **dict.fromkeys(
            ("detail_job_repeated", "detail_job_repeated_shuffled"),
            with_ctes("select * from detail union all select * from detail where event_id % 10 = 0", whole),
        ),
        "detail_job_store": with_ctes("select kind, k, guid from g_store", filled),
        "attribution_job": with_ctes(f"select *, '{FIRST_DAY}' dt from ({WEIGHTS}) w", SEGMENTS),
        "cube_job": with_ctes(
            cube_sql("devicetype, isnew").replace("isnew, count", "cast(isnew as integer) isnew, count"), CUBE
        ),
        "ordered_events": with_ctes(
            """select user_id guid, row_number() over (partition by user_id order by "timeStamp", "eventId" nulls first, event_id) "position",
            "timeStamp", event_id from event_log"""
        ),
        "burst_positions": with_ctes(
            """select guid, row_number() over (partition by guid order by ts, event_type, event_id) "position", event_id from burst"""
        ),
        "burst_attribution": with_ctes(WEIGHTS, BURST_SEGMENTS),
        "sparse_cuboid": f"""select l_returnflag, cast(cast(l_shipdate as date) as varchar) "day",
            {BUCKET.format("l_orderkey")} bucket, count(distinct l_orderkey) n_ids from lineitem group by 1, 2, 3""",
        "sparse_rollup": "select l_returnflag, count(distinct l_orderkey) n_orders, count(*) lines from lineitem group by 1",
        "merged_scores_bucketed": with_ctes(merged_sql("nullif(account, '')", null_safe, "round(b.score * 0.6, 1)")),
        "lattice_report": with_ctes(cube_sql("province"), CUBE),
        "bucketed_guid_store": with_ctes("select kind, k, guid from g_store", own),
        "sql_functions": with_ctes(
            """select "deviceId", trim("deviceId") <> '' has_device, count(distinct geohash) n_cells, count(*) n_events
            from event_log l join event_hash h on l.event_id = h.event_id group by 1, 2"""
        ),
        "sql_cube": with_ctes(cube_sql("province"), CUBE),
    }
