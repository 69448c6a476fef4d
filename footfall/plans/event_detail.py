"""Daily log ETL: raw event log to the event detail table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from footfall.operators import identity
from footfall.operators.area import fits_broadcast, locate_events
from footfall.operators.binding import SCORE_SCHEMA, fill_accounts
from footfall.operators.clean import day_window, parse_properties, required_fields, strip_properties
from footfall.operators.detail import DETAIL_COLUMNS, to_detail
from footfall.operators.sessions import split_sessions
from footfall.sources import KeyedStore, Ledger, Staging, append_days, overwrite_day, read_days, read_table, replace_table

ROW_ID = "event_id"
PLACE, CONTENT = "_place_in_log", "_content"
_KEY_COLUMNS = ("sessionId", "timeStamp", "deviceId", "account")


@dataclass(frozen=True)
class Inputs:
    """What the job reads besides the log."""

    dictionary: DataFrame
    ip_ranges: DataFrame
    scores: DataFrame
    store: DataFrame
    base: int


def build(
    log: DataFrame,
    inputs: Inputs,
    stage: Callable[[DataFrame, str], DataFrame],
    from_day: str | Column,
    to_day: str | None = None,
    zone: str = "UTC",
    row_id: str = ROW_ID,
    keep: tuple[str, ...] = (),
    ties: tuple[str, ...] = (),
    broadcast_rows: int | None = None,
    changes_only: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Detail rows of ``[from_day, to_day)`` and the next guid store; ``from_day`` may be the column of each row's day.

    With ``changes_only`` the second result is what changes in the store, see :func:`identity.store_changes`.

    ``row_id`` is unique per row; ``ties``, then ``row_id``, break ties in time.  Session, account and guid are worked out on
    five narrow columns; the wide rows are shuffled once, by row id, to take the results over.  ``stage``
    writes the narrow results that several later steps read.

    Areas are looked up on the wide rows while the lookup tables fit a broadcast (``broadcast_rows`` in all), which moves no row.
    Beyond that bound the lookups shuffle, so they run on position and address alone, staged because the
    lookups read them several times, and come back by row id, like the rest.
    """
    clean = to_detail(day_window(required_fields(log), from_day, to_day, zone=zone), keep=(row_id, *ties, *keep))
    keys = split_sessions(clean.select(row_id, *ties, *_KEY_COLUMNS))
    keys = stage(fill_accounts(keys, inputs.scores).drop("sessionId", "account"), "keys")

    resolved, store = identity.resolve(
        keys, inputs.store, inputs.base, stage, order=("timeStamp", *ties, row_id), changes_only=changes_only
    )
    resolved = resolved.select(row_id, "splitedSessionId", "filledAccount", "guid", "isnew")

    wide = clean.drop("splitedSessionId", "filledAccount", "guid", "isnew")
    if fits_broadcast(inputs.dictionary, inputs.ip_ranges, broadcast_rows):
        wide = locate_events(wide, inputs.dictionary, inputs.ip_ranges, small=True)
    else:
        positions = stage(clean.select(row_id, "latitude", "longitude", "ip"), "positions")
        places = locate_events(positions, inputs.dictionary, inputs.ip_ranges)
        wide = wide.drop("province", "city", "region").join(
            places.select(row_id, "province", "city", "region"), row_id
        )
    detail = wide.join(resolved, row_id)
    return detail.select(*DETAIL_COLUMNS, *keep), store


def located_rows(raw: DataFrame, stage: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``raw`` with a name for the place of each row and a digest of its content."""
    parts = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in raw.schema.fields]
    content = F.sha2(F.to_json(F.struct(*[p.alias(f"c{k}") for k, p in enumerate(parts)])), 256)
    place = F.concat_ws(".", F.hex(F.xxhash64("_metadata.file_path")), F.col("_metadata.row_index"))
    try:
        return raw.withColumns({PLACE: place, CONTENT: content})
    except AnalysisException:  # not a scan of files
        return stage(raw.withColumns({PLACE: F.monotonically_increasing_id(), CONTENT: content}), "log")


def run(
    spark: SparkSession,
    log: str,
    dictionary: str,
    ip_ranges: str,
    scores: str,
    store: str,
    next_store: str,
    detail: str,
    log_day: str,
    bind_day: str | None = None,
    out_day: str | None = None,
    zone: str | None = None,
    row_id: str | None = None,
    append: bool = False,
    json_properties: bool = False,
    obsolete: Sequence[str] = (),
    first_run: bool = False,
) -> None:
    """Write day ``out_day`` of the detail table and the next version of the guid store.

    Reads log day ``log_day`` and the scores of ``bind_day``; both further days default to ``log_day``.
    ``store`` is read and ``next_store`` written, so a rerun of the day gives the same result.  Rows are told
    apart by where they lie in the log's files, so a log may hold rows twice; events of one time are put in
    order by ``row_id``, if the log has one, and by a digest of all columns, so the layout of the files does
    not matter.  A log whose source does not name places gets numbers in a staged copy.

    Days are those of ``zone``, else of the session's time zone.  ``json_properties`` parses properties that are
    JSON text; ``obsolete`` keys are taken out of them.  With ``first_run`` the store and the score table need
    not exist: ids start at 1 and only accounts of the log itself are known.  What the run stages is named by all
    its locations and removed once both tables are written; a failed run leaves it for its rerun to replace.
    """
    if store == next_store:
        raise ValueError("the next store needs a location of its own, a rerun reads the old one")
    places = (log, dictionary, ip_ranges, scores, store, next_store, detail, log_day, bind_day or "", out_day or "")
    stage = Staging(spark, f"event-detail-{log_day}-{hashlib.sha256(chr(10).join(places).encode()).hexdigest()[:16]}")
    raw = located_rows(read_days(spark, log, log_day), stage)
    if json_properties:
        raw = parse_properties(raw)
    if first_run:
        guid_store = spark.createDataFrame([], identity.STORE_SCHEMA)
        known_scores = spark.createDataFrame([], SCORE_SCHEMA)
    else:
        guid_store = read_table(spark, store)
        known_scores = read_days(spark, scores, bind_day or log_day)
    inputs = Inputs(
        dictionary=read_table(spark, dictionary),
        ip_ranges=read_table(spark, ip_ranges),
        scores=known_scores,
        store=guid_store,
        base=identity.stored_counter(guid_store),
    )
    ties = (row_id, CONTENT) if row_id else (CONTENT,)
    zone = zone or spark.conf.get("spark.sql.session.timeZone")
    rows, new_store = build(raw, inputs, stage, log_day, zone=zone, row_id=PLACE, ties=ties)
    if obsolete:
        rows = strip_properties(rows, obsolete)
    replace_table(new_store, next_store)
    if append:
        append_days(rows.withColumn("dt", F.lit(out_day or log_day)), detail)
    else:
        overwrite_day(rows, detail, out_day or log_day)
    stage.remove()


def guid_store(spark: SparkSession, root: str) -> KeyedStore:
    """The store of visitor ids below ``root``, in buckets with a delta a day."""
    return KeyedStore(spark, f"{root.rstrip('/')}/guids", identity.STORE_SCHEMA, ["kind", "k"])


def read_published(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The detail rows of all published days, with ``dt``, and the store that belongs to them."""
    parts = Ledger(spark, root).read()
    if not parts:
        raise ValueError(f"nothing has been published below {root}")
    days = [spark.read.parquet(place).withColumn("dt", F.lit(day)) for day, place in sorted(parts["detail"].items())]
    detail = days[0]
    for rows in days[1:]:
        detail = detail.unionByName(rows)
    return detail, guid_store(spark, root).read(at=parts["guids"])


def run_published(
    spark: SparkSession,
    log: str,
    dictionary: str,
    ip_ranges: str,
    scores: str,
    root: str,
    log_day: str,
    bind_day: str | None = None,
    zone: str | None = None,
    row_id: str | None = None,
    json_properties: bool = False,
    obsolete: Sequence[str] = (),
) -> None:
    """Like :func:`run`, with detail days and guid store below ``root``, published together by one manifest.

    The day's rows and the store's delta are written first, where no reader looks; the manifest that names both comes last.  So
    a run that fails leaves the former day and the former store readable, and they fit each other.  Days come in order; the last
    one may be run again, from the store as it was before it.  The first day starts with an empty store and needs no scores.
    """
    ledger, store = Ledger(spark, root), guid_store(spark, root)
    newest = ledger.newest()
    parts = ledger.read(newest) or {"detail": {}, "guids": None}
    if parts["detail"] and log_day < max(parts["detail"]):
        raise ValueError(f"{log_day} comes before the last published day")
    stage = Staging(spark, f"event-detail-{log_day}-{hashlib.sha256(f'{root} {newest}'.encode()).hexdigest()[:16]}")
    raw = located_rows(read_days(spark, log, log_day), stage)
    if json_properties:
        raw = parse_properties(raw)
    first = not any(day < log_day for day in parts["detail"])
    if parts["guids"] is None:
        known = spark.createDataFrame([], identity.STORE_SCHEMA)
    else:
        known = stage(store.read(before=log_day, at=parts["guids"]), "store")
    inputs = Inputs(
        dictionary=read_table(spark, dictionary),
        ip_ranges=read_table(spark, ip_ranges),
        scores=spark.createDataFrame([], SCORE_SCHEMA) if first else read_days(spark, scores, bind_day or log_day),
        store=known,
        base=identity.stored_counter(known),
    )
    ties = (row_id, CONTENT) if row_id else (CONTENT,)
    zone = zone or spark.conf.get("spark.sql.session.timeZone")
    rows, changes = build(raw, inputs, stage, log_day, zone=zone, row_id=PLACE, ties=ties, changes_only=True)
    if obsolete:
        rows = strip_properties(rows, obsolete)
    place = ledger.write(rows, f"detail/{log_day}")
    # The store's own manifest moves on, but its readers are told by this one which of them to read.
    at = store.write_day(log_day, changes, parts["guids"] or 0)
    ledger.publish({"detail": {**parts["detail"], log_day: place}, "guids": at}, newest)
    stage.remove()
