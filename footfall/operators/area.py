"""Province, city and region of an event: by position, else by IP address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions import geohash6, ipv4_to_long, is_not_blank
from footfall.functions.coordinates import convert
from footfall.operators.lookup import HOT_SHARE, hot_keys, look_up, look_up_hot, may_crowd, spread

# Where ranges hold is worked out in buckets of 2^shift addresses; a range takes the first shift whose bucket is at
# least a sixteenth of it, so it covers at most 17 buckets (256 for the widest).
_TIER_SHIFTS = (8, 16, 24)
_BUCKETS_PER_RANGE = 16
# Pieces of ranges, and the addresses looked up in them, meet in blocks of 2^16 addresses.
_BLOCK_SHIFT, _SUPER_SHIFT = 16, 24
_BLOCKS = 2**16

# Lookup rows that may be broadcast: about 100 bytes each, so some 200 MB at most.
MAX_BROADCAST_ROWS = 2_000_000

# Fixed value: country|zone|province|city|isp, with something after the fourth bar.
REGION_PATTERN = r"(?s)^([^|]*\|){4}.*[^|]"


def flatten_areas(areas: DataFrame) -> DataFrame:
    """Level-4 areas with the names of their three ancestors: province, city, region."""
    leaf = areas.where("level = 4").select("id", "parentid", "bd09_lat", "bd09_lng")

    def parent(name: str) -> DataFrame:
        return areas.select(
            F.col("id").alias("parentid"), F.col("parentid").alias("_up"), F.col("areaname").alias(name)
        )

    found = leaf
    for name in ("region", "city", "province"):
        found = found.join(parent(name), "parentid").drop("parentid").withColumnRenamed("_up", "parentid")
    return found.select("id", "bd09_lat", "bd09_lng", "province", "city", "region")


def area_dictionary(areas: DataFrame, system: str = "bd09") -> DataFrame:
    """geohash, province, city, region of every level-4 area.

    The areas' coordinates are of system bd09.  ``system`` is that of the log's positions, ``wgs84`` for those of satellite
    receivers: the areas are taken over into it before they are hashed.
    """
    flat = flatten_areas(areas)
    if system != "bd09":
        flat = flat.withColumn("_at", convert(F.col("bd09_lat"), F.col("bd09_lng"), "bd09", system))
        flat = flat.withColumns({"bd09_lat": F.col("_at.lat"), "bd09_lng": F.col("_at.lng")})
    return flat.select(geohash6("bd09_lat", "bd09_lng").alias("geohash"), "province", "city", "region")


def unique_geohashes(dictionary: DataFrame) -> DataFrame:
    """Valid entries with one ``area`` struct per geohash: the smallest when several areas share a cell."""
    return (
        dictionary.where("geohash is not null and geohash <> ''")
        .groupBy("geohash")
        .agg(F.min(F.struct("province", "city", "region")).alias("area"))
    )


def _shift() -> Column:
    """Bucket shift of a range, by its width."""
    width = F.col("hi") - F.col("lo")
    narrow, middle = (2**shift * _BUCKETS_PER_RANGE for shift in _TIER_SHIFTS[:-1])
    small, medium, large = _TIER_SHIFTS
    return F.when(width < narrow, small).when(width < middle, medium).otherwise(large)


def fits_broadcast(dictionary: DataFrame, ranges: DataFrame, limit: int | None = None) -> bool:
    """Whether both lookup tables, the ranges counted by the most pieces they can give, stay below the broadcast bound.

    One job over the lookup tables; the log is not touched.
    """
    limit = MAX_BROADCAST_ROWS if limit is None else limit
    blocks = F.expr(f"shiftright(hi, {_BLOCK_SHIFT}) - shiftright(lo, {_BLOCK_SHIFT}) + 1")
    counted = ranges.where("lo <= hi").agg(F.lit("r").alias("of"), F.count("*").alias("n"), F.coalesce(F.sum(blocks), F.lit(0)).alias("blocks"))
    counted = counted.unionByName(dictionary.agg(F.lit("d").alias("of"), F.count("*").alias("n"), F.lit(0).alias("blocks")))
    sizes = {r["of"]: r for r in counted.collect()}
    return 2 * sizes["r"]["n"] + min(sizes["r"]["blocks"], _BLOCKS) + sizes["d"]["n"] <= limit


def locate_by_position(
    log: DataFrame,
    dictionary: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    out: str = "gps_area",
    small: bool = False,
) -> DataFrame:
    """Add ``out``: the area struct of the event's geohash, null when the cell is not in the dictionary.

    ``small=True``, after :func:`fits_broadcast`, keeps the log where it is; otherwise the log is shuffled
    but for its hot cells, which a sketch finds, and rows without a cell are dealt out evenly.
    """
    places = unique_geohashes(dictionary).withColumnsRenamed({"geohash": "_geohash", "area": out})
    cells = log.withColumn("_geohash", geohash6(latitude, longitude))
    if small:
        return look_up(cells, F.broadcast(places), ["_geohash"]).drop("_geohash")
    return look_up_hot(cells, places, ["_geohash"]).drop("_geohash")


def ip_areas(ranges: DataFrame) -> DataFrame:
    """The ranges with their ``area``: province and city from a region text of five parts, both not blank.

    Other texts give a null area.  Parsing the ranges spares parsing the text once per event.
    """
    parts = F.split("region", r"\|")
    usable = F.col("region").rlike(REGION_PATTERN) & is_not_blank(parts[2]) & is_not_blank(parts[3])
    area = F.when(usable, F.struct(parts[2].alias("province"), parts[3].alias("city")))
    return ranges.select("lo", "hi", area.alias("area"))


def flat_ranges(ranges: DataFrame, value: str = "region", small: bool = False) -> DataFrame:
    """``block``, ``lo``, ``hi``, ``value``: pieces that do not overlap and lie in one block each, with the value that holds there.

    Of the ranges that hold an address, the one that starts last counts, of those the shortest, and of equal ranges the
    one with the largest value.  The winner changes only where a range starts or has just ended, so it is
    worked out at these points and at the starts of blocks, which are at most 65,536 for 32-bit addresses:
    each point meets the ranges of its three buckets.  ``n`` ranges give at most ``2 n`` pieces and one a block.
    With ``small`` the ranges are broadcast to the points, which then move once, to their blocks.
    """
    rank = F.struct("lo", (-F.col("hi")).alias("minus_hi"), F.col(value).alias("value"))
    valid = ranges.where("lo <= hi")
    buckets = F.expr("explode(sequence(shiftright(lo, _shift), shiftright(hi, _shift)))")
    placed = valid.withColumn("_shift", _shift()).select("_shift", rank.alias("_range"), buckets.alias("_bucket"))
    supers = valid.select(F.explode(F.expr(f"sequence(shiftright(lo, {_SUPER_SHIFT}), shiftright(hi, {_SUPER_SHIFT}))")).alias("s")).distinct()
    inside = 2 ** (_SUPER_SHIFT - _BLOCK_SHIFT) - 1
    starts = supers.select(F.explode(F.expr(f"transform(sequence(0, {inside}), b -> shiftleft(s, {_SUPER_SHIFT}) + b * {2**_BLOCK_SHIFT})")).alias("at"))
    points = valid.select(F.explode(F.array("lo", F.col("hi") + 1)).alias("at")).union(starts).withColumn("block", F.shiftright("at", _BLOCK_SHIFT))
    # Dealt out by block, points meet their equals, and later their winners each other, without another shuffle.
    points = points.repartition("block").dropDuplicates(["block", "at"])
    tiers = [F.struct(F.lit(shift).alias("_shift"), F.shiftright("at", shift).alias("_bucket")) for shift in _TIER_SHIFTS]
    asked = points.select("block", "at", F.inline(F.array(*tiers)))
    hits = asked.join(F.broadcast(placed) if small else placed, ["_shift", "_bucket"], "left")
    hits = hits.select("block", "at", F.when(F.expr("at between _range.lo and -_range.minus_hi"), F.col("_range")).alias("_range"))
    winners = hits.groupBy("block", "at").agg(F.max("_range").alias("_range"))
    until = F.coalesce(F.lead("at").over(W.partitionBy("block").orderBy("at")), F.shiftleft(F.col("block") + 1, _BLOCK_SHIFT)) - 1
    return winners.withColumn("hi", until).where("_range is not null").select("block", F.col("at").alias("lo"), "hi", F.col("_range.value").alias("value"))


def locate_by_ip(
    log: DataFrame,
    ranges: DataFrame,
    ip_number: str,
    out: str = "ip_region",
    value: str = "region",
    small: bool = False,
) -> DataFrame:
    """Add ``out``: the ``value`` of the range ``[lo, hi]`` that holds the address number.

    Where ranges overlap, :func:`flat_ranges` says which one holds, so every row stays one row.

    ``small=True``, after :func:`fits_broadcast`, keeps the log where it is: the pieces are broadcast and joined by block.
    Otherwise log and pieces are sorted together, in one exchange of the log, see :func:`_swept`.
    """
    pieces = flat_ranges(ranges, value, small)
    if not small:
        return _swept(log, pieces, ip_number, out)
    held = F.broadcast(pieces.select(F.col("block").alias("_block"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("value").alias(out)))
    address = F.col(ip_number)
    same = (F.shiftright(address, _BLOCK_SHIFT) == F.col("_block")) & address.between(F.col("_lo"), F.col("_hi"))
    return log.join(held, same, "left").drop("_block", "_lo", "_hi")


def _swept(log: DataFrame, pieces: DataFrame, ip_number: str, out: str) -> DataFrame:
    """Addresses and starts of pieces in one order by block: the last piece that started holds an address, if it reaches it.

    Pieces end with their block, so nothing is handed on from one block to the next.  A block with a large share of the
    rows, found by a sketch over the addresses, is dealt over as many parts as it has shares; its pieces, at
    most one an address, go to each part.  Rows without an address are dealt out by their digest.
    """
    rows = log.withColumn("_address", F.col(ip_number).cast("bigint")).withColumn("_block", F.shiftright("_address", _BLOCK_SHIFT))
    hot = hot_keys(rows.select("_block"), F.col("_block")) if may_crowd(log.select(ip_number)) else log.sparkSession.createDataFrame([], "item bigint, share double")
    hot = F.broadcast(hot.select(F.col("item").alias("_block"), F.ceil(F.col("share") * HOT_SHARE).cast("int").alias("_parts")))
    dealt = F.when(F.col("_address").isNull(), spread(log)).otherwise(F.pmod(spread(log), F.coalesce("_parts", F.lit(1))))
    asked = rows.join(hot, "_block", "left").withColumn("_part", dealt).drop("_parts")
    starts = pieces.select(F.col("block").alias("_block"), F.col("lo").alias("_address"), F.struct("hi", "value").alias("_piece"))
    starts = starts.join(hot, "_block", "left").withColumn("_part", F.explode(F.expr("sequence(0L, coalesce(_parts, 1) - 1L)"))).drop("_parts")
    both = asked.withColumn("_asked", F.lit(True)).unionByName(starts, allowMissingColumns=True)
    order = W.partitionBy("_block", "_part").orderBy("_address", F.col("_asked").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("_last", F.last("_piece", ignorenulls=True).over(order)).where("_asked")
    return found.withColumn(out, F.when(F.col("_address") <= F.col("_last.hi"), F.col("_last.value"))).select(*[f"`{c}`" for c in log.columns if c != out], out)


def locate_events(
    log: DataFrame,
    dictionary: DataFrame,
    ranges: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    ip: str = "ip",
    small: bool = False,
) -> DataFrame:
    """Add province, city and region: from the position when its cell is known, else from the IP.

    The IP gives province and city, when its region text has five parts and both are not blank; the
    region stays null.  A located row does not look for its IP.  ``small`` is as in
    :func:`locate_by_position`.
    """
    bare = log.drop("province", "city", "region")
    placed = locate_by_position(bare, dictionary, latitude, longitude, small=small)
    numbered = placed.withColumn("_ip", F.when(F.col("gps_area").isNull(), ipv4_to_long(ip)))
    looked_up = locate_by_ip(numbered, ip_areas(ranges), "_ip", "ip_area", "area", small)
    by_position = F.col("gps_area").isNotNull()
    return looked_up.withColumns(
        {
            "province": F.when(by_position, F.col("gps_area.province")).otherwise(F.col("ip_area.province")),
            "city": F.when(by_position, F.col("gps_area.city")).otherwise(F.col("ip_area.city")),
            "region": F.col("gps_area.region"),
        }
    ).drop("gps_area", "_ip", "ip_area")
