"""Sessions: summaries, records with value lists, selection and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.functions.numbers import ratio_3
from visitloom.functions.times import format_time, parse_time
from visitloom.operators.predicates import equals, in_range, one_of
from visitloom.schemas import STEP_BUCKETS, VISIT_BUCKETS
from visitloom.sources.tasks import Criteria

SUMMARY = ("session_id", "user_id", "start_time", "end_time", "visit_length", "step_length")

# List column of a session record: (action column, holds numbers, is a comma list).
NARROW_LISTS = {
    "search_keywords": ("search_keyword", False, False),
    "click_category_ids": ("click_category_id", True, False),
}
WIDE_LISTS = {
    "page_ids": ("page_id", True, False),
    "actions": ("action", False, False),
    "search_keywords": ("search_keyword", False, False),
    "click_category_ids": ("click_category_id", True, False),
    "click_product_ids": ("click_product_id", True, False),
    "order_category_ids": ("order_category_ids", True, True),
    "order_product_ids": ("order_product_ids", True, True),
    "pay_category_ids": ("pay_category_ids", True, True),
    "pay_product_ids": ("pay_product_ids", True, True),
}


def _timed(actions: DataFrame) -> DataFrame:
    return actions.withColumn("time", parse_time(F.col("action_time")))


def _summary_aggregates() -> list[Column]:
    # Times are kept as timestamps, not texts, so that the aggregation stays a hash aggregation.
    return [
        F.min("user_id").alias("user_id"),
        F.min("time").alias("start"),
        F.max("time").alias("end"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def _summary_columns() -> list[Column]:
    return [
        F.col("session_id"),
        F.col("user_id"),
        format_time(F.col("start")).alias("start_time"),
        format_time(F.col("end")).alias("end_time"),
        F.timestamp_diff("SECOND", F.col("start"), F.col("end")).alias("visit_length"),
        F.col("step_length"),
    ]


def session_summary(actions: DataFrame, **flags: Column) -> DataFrame:
    """One row per session: user, start, end, visit length in seconds, number of actions.

    A flag is a condition on actions and tells whether any action of the session meets it.
    """
    met = [F.bool_or(F.coalesce(condition, F.lit(False))).alias(name) for name, condition in flags.items()]
    return (
        _timed(actions)
        .groupBy("session_id")
        .agg(*_summary_aggregates(), *met)
        .select(*_summary_columns(), *flags)
    )


def _sorted_list(values: str, numbers: bool) -> str:
    if not numbers:
        return f"array_sort({values})"
    by_number = f"array_sort(transform({values}, v -> struct(try_cast(v AS bigint) AS n, v AS v)))"
    return f"transform({by_number}, p -> p.v)"


def _items(column: str) -> str:
    """The non-empty items of a comma list."""
    return f"filter(split({column}, ','), item -> item != '')"


def _records(actions: DataFrame, lists: dict) -> DataFrame:
    """Summaries with lists of distinct values, sorted; one row a session.

    Repeated values are dropped before the shuffle, so a session with many actions
    costs its distinct values only. A cell holds all of them.
    """
    gathered = [F.collect_set(source).alias(name) for name, (source, _, _) in lists.items()]

    def finished(name: str, numbers: bool, is_list: bool) -> Column:
        if is_list:
            values = _sorted_list(f"array_distinct(flatten(transform({name}, t -> {_items('t')})))", numbers)
        else:
            values = f"transform(array_sort({name}), v -> CAST(v AS string))"
        return F.expr(f"{values} AS {name}")

    return (
        _timed(actions)
        .groupBy("session_id")
        .agg(*_summary_aggregates(), *gathered)
        .select(
            *_summary_columns(), *(finished(name, numbers, is_list) for name, (_, numbers, is_list) in lists.items())
        )
    )


def session_records(actions: DataFrame) -> DataFrame:
    """Summaries with the distinct search keywords and clicked categories."""
    return _records(actions, NARROW_LISTS)


def wide_session_records(actions: DataFrame) -> DataFrame:
    """Summaries with the distinct values of all action columns."""
    return _records(actions, WIDE_LISTS)


def session_values(actions: DataFrame) -> DataFrame:
    """(session_id, list, value): what `wide_session_records` lists, a row each, for sessions
    with more values than a cell should hold."""

    def entries(name: str, source: str, is_list: bool) -> str:
        values = f"coalesce({_items(source)}, array())" if is_list else f"array(CAST({source} AS string))"
        return f"transform({values}, v -> struct('{name}' AS list, v AS value))"

    each = ", ".join(entries(name, source, is_list) for name, (source, _, is_list) in WIDE_LISTS.items())
    exploded = actions.select("session_id", F.expr(f"explode(concat({each})) AS entry")).select("session_id", "entry.*")
    return exploded.where(F.col("value").isNotNull()).distinct()


def list_text(df: DataFrame) -> DataFrame:
    """Lists as comma texts, as the result tables hold them."""
    return df.select(
        *(
            F.array_join(f.name, ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields
        )
    )


def with_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions of known users, with age, professional, city and sex."""
    return sessions.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")


def select_sessions(actions: DataFrame, users: DataFrame, criteria: Criteria) -> DataFrame:
    """Sessions that meet all criteria on their user and their actions.

    Whether a session searched a wanted keyword or clicked a wanted category is
    decided while it is aggregated, so no list of values is built; the criteria
    on users reach the scan of the users.
    """
    flags = {}
    if criteria.keywords:
        flags["searched"] = F.col("search_keyword").isin(list(criteria.keywords))
    if criteria.category_ids:
        flags["clicked"] = F.col("click_category_id").isin(list(criteria.category_ids))
    sessions = session_summary(actions, **flags)
    for name in flags:
        sessions = sessions.where(F.col(name))
    wanted = users.where(
        in_range(F.col("age"), criteria.start_age, criteria.end_age)
        & one_of(F.col("professional"), criteria.professionals)
        & one_of(F.col("city"), criteria.cities)
        & equals(F.col("sex"), criteria.sex)
    )
    return with_users(sessions.drop(*flags), wanted)


def _counted(column: str, buckets: tuple) -> list[Column]:
    def condition(low: int | None, high: int | None) -> str:
        if low is None:
            return f"{column} <= {high}"
        return f"{column} >= {low}" if high is None else f"{column} BETWEEN {low} AND {high}"

    return [F.expr(f"count_if({condition(low, high)}) AS {name}") for name, low, high in buckets]


def count_columns() -> list[Column]:
    """Aggregates: number of sessions, in all and per visit and step bucket."""
    return [
        F.count(F.lit(1)).alias("session_count"),
        *_counted("visit_length", VISIT_BUCKETS),
        *_counted("step_length", STEP_BUCKETS),
    ]


def session_counts(sessions: DataFrame) -> DataFrame:
    """One row: number of sessions, in all and per visit and step bucket."""
    return sessions.agg(*count_columns())


def session_statistics(sessions: DataFrame, task_id: int) -> DataFrame:
    """One row: number of sessions and the share of each bucket to three decimals.

    With no session the shares are NULL.
    """
    names = [name for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS]
    return session_counts(sessions).select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "session_count",
        *(ratio_3(F.col(name), F.col("session_count")).alias(name) for name in names),
    )
