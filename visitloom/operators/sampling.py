"""A sample of sessions spread over days and hours, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitloom.operators.joins import rows_of
from visitloom.operators.sessions import list_text, session_records
from visitloom.schemas import SESSION_DETAIL, SESSION_RANDOM_EXTRACT

# Leading hex digits of a draw by which an hour's sessions are counted: 16^3 slices.
SLICE_DIGITS = 3
# Hours that have a sample are broadcast up to this target, which bounds their number.
BROADCAST_ROWS = 200_000


def _hourly(sessions: DataFrame) -> DataFrame:
    # Never NULL, so that joins on these columns add no filters that would
    # work them out once more.
    start = F.coalesce("start_time", F.lit(""))
    return sessions.where(F.col("start_time").isNotNull()).select(
        "session_id",
        F.substring(start, 1, 10).alias("date"),
        F.substring(start, 12, 2).alias("hour"),
    )


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions by date and hour of their start."""
    return _hourly(sessions).groupBy("date", "hour").agg(F.count(F.lit(1)).alias("sessions"))


def hourly_quota(hours: DataFrame, target: int = 100) -> DataFrame:
    """Per hour: sessions of its day, number of days, the day's quota (target / days,
    whole) and the sample size min(sessions, whole part of sessions / day total * quota)."""
    days = hours.agg(F.countDistinct("date")).scalar()
    share = F.col("sessions").cast("double") / F.col("day_total") * F.col("day_quota")
    return (
        hours.withColumn("day_total", F.sum("sessions").over(Window.partitionBy("date")))
        .withColumn("days", days)
        .withColumn("day_quota", F.expr(f"{int(target)} div days"))
        .withColumn("sample_size", F.least("sessions", share.cast("bigint")))
    )


def sample_sessions(sessions: DataFrame, target: int = 100, seed: int = 42) -> DataFrame:
    """The sampled (date, hour, session_id): in each hour the `sample_size` sessions
    that come first by md5 of seed and session id.

    The sessions of an hour are counted by slices of equal leading md5 digits,
    which tells the last slice the sample reaches into. Only sessions up to that
    slice are sorted, so a full hour is never brought into one task.
    """
    draw = F.md5(F.concat(F.lit(str(seed)), F.coalesce("session_id", F.lit(""))))
    drawn = (
        _hourly(sessions)
        .withColumn("draw", draw)
        .withColumn("slice", F.substring("draw", 1, SLICE_DIGITS))
    )
    slices = drawn.groupBy("date", "hour", "slice").agg(F.count(F.lit(1)).alias("in_slice"))
    hours = hourly_quota(slices.groupBy("date", "hour").agg(F.sum("in_slice").alias("sessions")), target)

    earlier = Window.partitionBy("date", "hour").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        slices.withColumn("ahead", F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)))
        .join(hours.select("date", "hour", "sample_size"), ["date", "hour"])
        .where(F.col("ahead") < F.col("sample_size"))
        .groupBy("date", "hour", "sample_size")
        .agg(F.max("slice").alias("last_slice"))
    )
    # Every hour here has a sample of its own, so there are no more hours than `target`.
    few = F.broadcast(reach) if target <= BROADCAST_ROWS else reach
    few = drawn.join(few, ["date", "hour"]).where(F.col("slice") <= F.col("last_slice"))
    order = Window.partitionBy("date", "hour").orderBy("draw", "session_id")
    return (
        few.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= F.col("sample_size"))
        .select("date", "hour", "session_id")
    )


def sampled_details(actions: DataFrame, sample: DataFrame) -> DataFrame:
    """`session_detail`: all actions of the sampled sessions."""
    return rows_of(actions, sample).select(*SESSION_DETAIL.names)


def sampled_records(details: DataFrame) -> DataFrame:
    """`session_random_extract`, from the details of the sample: keyword and category
    lists are built for the sampled sessions only."""
    return list_text(session_records(details)).select(*SESSION_RANDOM_EXTRACT.names)
