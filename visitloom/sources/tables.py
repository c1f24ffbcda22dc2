"""The two input tables, read as they are or derived from event and customer tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.functions.times import format_date, format_time
from visitloom.schemas import USER_INFO, USER_VISIT_ACTION

# Event type to action kind.
ACTION_OF_EVENT = {"view": "search", "click": "click", "purchase": "order", "signup": "pay"}


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A parquet table; it may be partitioned by any of its columns, such as the date."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def catalog_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A table of the session catalog, such as a Hive table, bound to a fixed schema."""
    return typed_by_name(spark.table(name), schema)


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, USER_VISIT_ACTION)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, USER_INFO)


def typed_by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind columns by name to a fixed schema; a column that is missing becomes NULL."""
    have = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def _is_date(text: str | None) -> bool:
    try:
        return text is not None and date.fromisoformat(text).isoformat() == text
    except ValueError:
        return False


def actions_from_events(
    events: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """`user_visit_action` over an event table (event_id, ts, user_id, event_type, props).

    The dates bound `ts` itself, so that they reach the scan; a date that is not
    `yyyy-MM-dd` is left to the later comparison of texts.
    """
    if _is_date(start_date):
        events = events.where(F.col("ts") >= F.lit(start_date).cast("timestamp_ntz"))
    if _is_date(end_date):
        after_end = (date.fromisoformat(end_date) + timedelta(days=1)).isoformat()
        events = events.where(F.col("ts") < F.lit(after_end).cast("timestamp_ntz"))

    kind = F.coalesce(
        *(F.when(F.col("event_type") == e, F.lit(a)) for e, a in ACTION_OF_EVENT.items()),
        F.lit("other"),
    )
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    day = format_date(F.col("ts"))
    base = events.select(
        day.alias("date"),
        "user_id",
        F.concat(F.lit("u"), F.col("user_id"), F.lit("_"), F.replace(day, F.lit("-"), F.lit(""))).alias(
            "session_id"
        ),
        (F.col("event_id") % 10).alias("page_id"),
        "event_type",
        kind.alias("action"),
        format_time(F.col("ts")).alias("action_time"),
        k.alias("k"),
        (F.col("event_id") % 100).alias("product"),
    )

    event_of = {action: event for event, action in ACTION_OF_EVENT.items()}

    def only(action: str, value):
        return F.when(F.col("event_type") == event_of[action], value)

    def pair(first: str, step: int):
        return F.concat_ws(",", F.col(first).cast("string"), ((F.col(first) + step) % 100).cast("string"))

    return base.select(
        "date",
        "user_id",
        "session_id",
        "page_id",
        "action",
        "action_time",
        only("search", F.concat(F.lit("kw"), F.col("k") % 10)).alias("search_keyword"),
        only("click", F.col("k")).alias("click_category_id"),
        only("click", F.col("product")).alias("click_product_id"),
        only("order", pair("k", 37)).alias("order_category_ids"),
        only("order", pair("product", 1)).alias("order_product_ids"),
        only("pay", pair("k", 61)).alias("pay_category_ids"),
        only("pay", pair("product", 1)).alias("pay_product_ids"),
    )


def users_from_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """`user_info` over a customer and a nation table."""
    key = F.col("c_custkey")
    return customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).select(
        key.alias("user_id"),
        F.concat(F.lit("user"), key).alias("username"),
        F.col("c_name").alias("name"),
        (key % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(key % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def register_views(actions: DataFrame, users: DataFrame, suffix: str = "") -> tuple[str, str]:
    """The views `user_visit_action` and `user_info`, with a suffix, in the frames' session; their names."""
    names = f"user_visit_action{suffix}", f"user_info{suffix}"
    for frame, name in zip((actions, users), names, strict=True):
        frame.createOrReplaceTempView(name)
    return names
