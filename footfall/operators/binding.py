"""Device-account binding scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from footfall.functions import blank_to_null
from footfall.operators.lookup import look_up_hot

POINTS_PER_SESSION = 100
DECAY = "0.6"
SCORE_TYPE = "decimal(22,1)"
SCORE_SCHEMA = f"deviceid string, account string, score {SCORE_TYPE}, last_login bigint"


def binding_events(log: DataFrame, literal: bool = False) -> DataFrame:
    """The four columns scoring needs, of rows that have an event id.

    An anonymous ('') account becomes null; ``literal=True`` makes it the text ``'null'`` instead,
    which later counts as an account of that name.
    """
    account = (
        F.when(F.col("account") == "", F.lit("null")).otherwise(F.col("account"))
        if literal
        else blank_to_null("account")
    )
    return log.where(F.col("eventId").isNotNull()).select(
        F.col("deviceId").alias("deviceid"),
        account.alias("account"),
        F.col("sessionId").alias("sessionid"),
        F.col("timeStamp").alias("timestamp"),
    )


def daily_scores(events: DataFrame) -> DataFrame:
    """Score of each (device, account): 100 per distinct session, with the last event time.

    Distinct counting runs in two steps, first per session, so no pair is gathered in one task.
    """
    return events.groupBy("deviceid", "account").agg(
        (F.count_distinct("sessionid") * POINTS_PER_SESSION).alias("score"),
        F.max("timestamp").alias("last_login"),
    )


def merge_scores(today: DataFrame, before: DataFrame, literal: bool = False) -> DataFrame:
    """Merge today's scores with the previous table.

    Seen on both sides: the sum.  Only today: today's.  Only before: decayed by 0.6.  The last login is
    today's, else the earlier one.  Null accounts match each other.  ``literal=True`` keeps them apart
    and gives null instead of a decayed score.
    """
    t, b = today.alias("t"), before.alias("b")
    same_account = (
        F.col("t.account") == F.col("b.account")
        if literal
        else F.col("t.account").eqNullSafe(F.col("b.account"))
    )
    decayed = F.lit(None) if literal else F.col("b.score") * F.lit(DECAY).cast("decimal(2,1)")
    score = (
        F.when(F.col("t.score").isNull(), decayed)
        .when(F.col("b.score").isNull(), F.col("t.score"))
        .otherwise(F.col("t.score") + F.col("b.score"))
    )
    return t.join(b, (F.col("t.deviceid") == F.col("b.deviceid")) & same_account, "full").select(
        F.coalesce("t.deviceid", "b.deviceid").alias("deviceid"),
        F.coalesce("t.account", "b.account").alias("account"),
        score.cast(SCORE_TYPE).alias("score"),
        F.coalesce("t.last_login", "b.last_login").alias("last_login"),
    )


def with_account_key(scores: DataFrame) -> DataFrame:
    """``scores`` with ``account_key``, the account as a text that is never null, so that equal keys are equal accounts."""
    return scores.withColumn("account_key", F.coalesce(F.concat(F.lit("="), F.col("account")), F.lit("")))


def merge_bucketed(today: DataFrame, before: DataFrame) -> DataFrame:
    """:func:`merge_scores` of two tables with ``account_key`` that are bucketed alike by (deviceid, account_key).

    Equal buckets meet where they are: neither table is shuffled.  A plain comparison of keys takes the place of the null-safe
    one of accounts, which would hide the buckets from the planner.
    """
    t, b = today.alias("t"), before.alias("b")
    same = (F.col("t.deviceid") == F.col("b.deviceid")) & (F.col("t.account_key") == F.col("b.account_key"))
    score = (
        F.when(F.col("t.score").isNull(), F.col("b.score") * F.lit(DECAY).cast("decimal(2,1)"))
        .when(F.col("b.score").isNull(), F.col("t.score"))
        .otherwise(F.col("t.score") + F.col("b.score"))
    )
    return t.join(b, same, "full").select(
        F.coalesce("t.deviceid", "b.deviceid").alias("deviceid"),
        F.coalesce("t.account", "b.account").alias("account"),
        score.cast(SCORE_TYPE).alias("score"),
        F.coalesce("t.last_login", "b.last_login").alias("last_login"),
        F.coalesce("t.account_key", "b.account_key").alias("account_key"),
    )


def best_accounts(scores: DataFrame) -> DataFrame:
    """One account per device: highest score, then latest login, then the smaller account name.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so each task sends at most
    one row per device however many accounts a device has.
    """
    ranked = W.partitionBy("deviceid").orderBy(F.desc("score"), F.desc("last_login"), F.asc("account"))
    return (
        scores.where(F.col("account").isNotNull())
        .withColumn("_rank", F.row_number().over(ranked))
        .where("_rank = 1")
        .select("deviceid", "account")
    )


def fill_accounts(log: DataFrame, scores: DataFrame, out: str = "filledAccount") -> DataFrame:
    """Add ``out``: the row's own account, else the best account of its device; a device may have any share of the rows."""
    best = best_accounts(scores).withColumnRenamed("account", "_best_account")
    filled = look_up_hot(log.drop(out), best, ["deviceid"])
    return filled.withColumn(out, F.coalesce("account", "_best_account")).drop("_best_account")
