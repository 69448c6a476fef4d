"""Daily device-account binding scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators.binding import SCORE_SCHEMA, binding_events, daily_scores, merge_bucketed, merge_scores, with_account_key
from footfall.sources import append_days, overwrite_day, read_days, write_bucketed


def build(log: DataFrame, before: DataFrame, literal: bool = False) -> DataFrame:
    """Scores of the day of ``log``, merged with the previous score table."""
    return merge_scores(daily_scores(binding_events(log, literal)), before, literal)


def run(
    spark: SparkSession,
    log: str,
    scores: str,
    previous_day: str,
    day: str,
    append: bool = False,
    literal: bool = False,
    first_run: bool = False,
) -> None:
    """Write day ``day`` of the score table from the log of that day and the scores of ``previous_day``.

    The day is overwritten; ``append=True`` adds to it instead.  With ``first_run`` there are no scores
    before, and the score table need not exist.
    """
    before = spark.createDataFrame([], SCORE_SCHEMA) if first_run else read_days(spark, scores, previous_day)
    merged = build(read_days(spark, log, day), before, literal)
    if append:
        append_days(merged.withColumn("dt", F.lit(day)), scores)
    else:
        overwrite_day(merged, scores, day)


BUCKET_KEYS = ("deviceid", "account_key")


def run_bucketed(
    spark: SparkSession, log: str, today: str, before: str, merged: str, day: str, buckets: int = 2048, path: str | None = None, first_run: bool = False
) -> None:
    """Write the table ``merged`` from the log of ``day`` and the table ``before``, both bucketed by (deviceid, account_key).

    ``today`` names the table of the day's own scores.  Each day is a table of its own, so a rerun reads what the first run
    read.  Only the day's scores are shuffled, once, into their buckets; the far larger table of before stays where it is, and
    the result comes out in the same buckets.  With ``path`` the tables' files lie below it.
    """
    places = {name: f"{path.rstrip('/')}/{name}" if path else None for name in (today, before, merged)}
    scores = with_account_key(daily_scores(binding_events(read_days(spark, log, day))))
    fresh = write_bucketed(scores, today, BUCKET_KEYS, int(buckets), places[today])
    if first_run:
        nothing = with_account_key(spark.createDataFrame([], SCORE_SCHEMA))
        write_bucketed(nothing, before, BUCKET_KEYS, int(buckets), places[before])
    result = merge_bucketed(fresh, spark.table(before))
    # The rows are in their buckets already; dealing them out again would move them for nothing.
    writer = result.write.mode("overwrite").bucketBy(int(buckets), *BUCKET_KEYS).sortBy(*BUCKET_KEYS).format("parquet")
    (writer.option("path", places[merged]) if path else writer).saveAsTable(merged)
