"""Categories: counts by kind of action, ranking, and top sessions within each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitloom.functions.texts import id_list
from visitloom.operators.predicates import with_value

# Parts into which the sessions of a category are dealt before the last cut.
SALTS = 64


def _ids(column: str) -> Column:
    return F.coalesce(id_list(F.col(column)), F.array().cast("array<bigint>"))


def category_universe(actions: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid for."""
    ids = F.array_compact(
        F.concat(F.array("click_category_id"), _ids("order_category_ids"), _ids("pay_category_ids"))
    )
    return actions.select(F.explode(ids).alias("category_id")).distinct()


def click_counts(actions: DataFrame) -> DataFrame:
    clicks = with_value(actions, "click_category_id")
    return clicks.groupBy(F.col("click_category_id").alias("category_id")).agg(F.count(F.lit(1)).alias("click_count"))


def _list_counts(actions: DataFrame, column: str, name: str) -> DataFrame:
    ids = with_value(actions, column).select(F.explode(id_list(F.col(column))).alias("category_id"))
    return ids.groupBy("category_id").agg(F.count(F.lit(1)).alias(name))


def order_counts(actions: DataFrame) -> DataFrame:
    """Orders per category; an id counts as often as it stands in a list."""
    return _list_counts(actions, "order_category_ids", "order_count")


def pay_counts(actions: DataFrame) -> DataFrame:
    """Payments per category; an id counts as often as it stands in a list."""
    return _list_counts(actions, "pay_category_ids", "pay_count")


def joined_category_counts(actions: DataFrame) -> DataFrame:
    """The universe left-joined with the three counts, 0 where there is none."""
    counts = category_universe(actions)
    for each in (click_counts(actions), order_counts(actions), pay_counts(actions)):
        counts = counts.join(each, "category_id", "left")
    return counts.na.fill(0, ["click_count", "order_count", "pay_count"])


def category_counts(actions: DataFrame, *keys: str) -> DataFrame:
    """As `joined_category_counts`, in one pass and one shuffle; with `keys`, for each of their values."""

    def marked(ids: Column, kind: str) -> Column:
        return F.transform(ids, lambda i: F.struct(i.alias("category_id"), F.lit(kind).alias("kind")))

    entries = F.concat(
        marked(F.array_compact(F.array("click_category_id")), "click"),
        marked(_ids("order_category_ids"), "order"),
        marked(_ids("pay_category_ids"), "pay"),
    )
    return (
        actions.select(*keys, F.explode(entries).alias("entry"))
        .select(*keys, "entry.*")
        .groupBy("category_id", *keys)
        .agg(*(F.count_if(F.col("kind") == kind).alias(f"{kind}_count") for kind in ("click", "order", "pay")))
    )


def ranking() -> list[Column]:
    """By clicks, then orders, then payments, most first; equal ones by id."""
    return [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")]


def ranked_categories(counts: DataFrame) -> DataFrame:
    return counts.orderBy(*ranking())


def top_categories(counts: DataFrame, k: int = 10) -> DataFrame:
    return ranked_categories(counts).limit(k)


def session_category_clicks(actions: DataFrame) -> DataFrame:
    """Clicks per session and category."""
    clicks = with_value(actions, "click_category_id")
    return clicks.groupBy("session_id", F.col("click_category_id").alias("category_id")).agg(
        F.count(F.lit(1)).alias("click_count")
    )


def clicks_in_categories(actions: DataFrame, top: DataFrame) -> DataFrame:
    """Clicks per session inside the given categories.

    How they are joined is left to Spark, which knows the size of `top` when it runs.
    """
    ids = top.select("category_id")
    # Joined before counting, so that clicks on other categories are not shuffled.
    wanted = with_value(actions, "click_category_id").join(
        ids, F.col("click_category_id") == ids["category_id"], "left_semi"
    )
    return session_category_clicks(wanted).select("category_id", "session_id", "click_count")


def top_sessions(actions: DataFrame, top: DataFrame, n: int = 10) -> DataFrame:
    """The n sessions with most clicks in each of the categories; equal ones by session id.

    First cut in each of SALTS parts of a category, so that no task gets more than SALTS * n
    sessions of it.
    """

    def first(counts: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("click_count"), F.asc("session_id"))
        return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n).drop("place")

    salted = clicks_in_categories(actions, top).withColumn("salt", F.pmod(F.xxhash64("session_id"), F.lit(SALTS)))
    return first(first(salted, "category_id", "salt").drop("salt"), "category_id")
