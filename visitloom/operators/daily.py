"""Sessions and categories by day: partial states that are stored once a day and merged when asked for.

A day's state of a session holds its least user, first and last time, number of actions and distinct values; merged states are
what the actions of all those days give at once. So a day that is added, or comes again, is read alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.functions.times import format_time, parse_time
from visitloom.operators.categories import category_counts
from visitloom.operators.predicates import date_range

SESSION_STATE = (
    "session_id string, user_id bigint, start timestamp_ntz, end timestamp_ntz, steps bigint, "
    "search_keywords array<string>, click_category_ids array<bigint>"
)
CATEGORY_STATE = "category_id bigint, click_count bigint, order_count bigint, pay_count bigint"


def session_states(actions: DataFrame) -> DataFrame:
    """(session_id, date, user_id, start, end, steps, search_keywords, click_category_ids): a row for each session and day."""
    time = parse_time(F.col("action_time"))
    return actions.groupBy("session_id", "date").agg(
        F.min("user_id").alias("user_id"),
        F.min(time).alias("start"),
        F.max(time).alias("end"),
        F.count(F.lit(1)).alias("steps"),
        F.collect_set("search_keyword").alias("search_keywords"),
        F.collect_set("click_category_id").alias("click_category_ids"),
    )


def merged_summary(states: DataFrame) -> DataFrame:
    """`session_summary` of the days whose states are given. Lists are not read for it."""
    merged = states.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("steps").alias("step_length")
    )
    return merged.select(
        "session_id",
        "user_id",
        format_time(F.col("start")).alias("start_time"),
        format_time(F.col("end")).alias("end_time"),
        F.timestamp_diff("SECOND", F.col("start"), F.col("end")).alias("visit_length"),
        "step_length",
    )


def merged_values(states: DataFrame) -> DataFrame:
    """(session_id, search_keywords, click_category_ids): sorted distinct values of the days whose states are given."""

    def union(column: str):
        return F.array_sort(F.array_distinct(F.flatten(F.collect_set(column)))).alias(column)

    return states.groupBy("session_id").agg(union("search_keywords"), union("click_category_ids"))


@dataclass(frozen=True)
class DayStore:
    """States under one location, a folder for each day. A day that comes again takes the place of what it was."""

    location: str

    def put(self, actions: DataFrame, day: str) -> None:
        """Work out and store the states of one day; of `actions` only that day is read.

        Both tables of the day are written by their own commit; until a failed call is repeated they may be of two calls.
        """
        if date.fromisoformat(day).isoformat() != day:
            raise ValueError(f"{day} is no date of the form yyyy-MM-dd")
        one = date_range(actions, day, day)
        tables = {"sessions": session_states(one), "categories": category_counts(one)}
        for name, states in tables.items():
            states.drop("date").write.mode("overwrite").parquet(f"{self.location}/{name}/date={day}")

    def put_all(self, actions: DataFrame) -> None:
        """The states of all days of `actions`, in one pass each, in place of all days before."""
        states = session_states(actions)
        states.repartition("date", "session_id").write.mode("overwrite").partitionBy("date").parquet(f"{self.location}/sessions")
        by_day = category_counts(actions, "date")
        by_day.write.mode("overwrite").partitionBy("date").parquet(f"{self.location}/categories")

    def sessions(self, spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
        """States of the sessions from `start` to `end`; other days' folders are not read."""
        states = spark.read.schema(f"{SESSION_STATE}, date string").parquet(f"{self.location}/sessions")
        return date_range(states, start, end)

    def categories(self, spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
        """Clicks, orders and payments of each category from `start` to `end`."""
        states = spark.read.schema(f"{CATEGORY_STATE}, date string").parquet(f"{self.location}/categories")
        counts = (F.sum(c).alias(c) for c in ("click_count", "order_count", "pay_count"))
        return date_range(states, start, end).groupBy("category_id").agg(*counts)
