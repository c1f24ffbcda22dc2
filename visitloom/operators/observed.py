"""Statistics taken in passing: named metrics of a write that has to be made anyway."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.functions.numbers import ratio_3
from visitloom.operators.sessions import count_columns
from visitloom.schemas import STEP_BUCKETS, VISIT_BUCKETS
from visitloom.session import through_storage


def store_observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, dict]:
    """`df` stored in the scratch folder and read back, and the metrics (aggregates with names) of its rows.

    The metrics are those of the tasks that write: a task counts when it ends well, and once, however often it or one of another
    executor is repeated. An empty frame has no tasks; its metrics are what the aggregates give over no rows.
    """
    observation = Observation(name)
    stored = through_storage(df.observe(observation, *metrics), name)
    found = observation.get
    # Where nothing is left of a plan, as no row can pass it, nothing is observed either.
    return stored, found or stored.limit(0).agg(*metrics).first().asDict()


def one_row(df: DataFrame, values: Mapping[str, object], schema: T.StructType) -> DataFrame:
    """A frame of one row in the session of `df`."""
    columns = (F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields)
    return df.sparkSession.range(1).select(*columns)


def store_with_counts(sessions: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Sessions, stored, and one row of `session_counts` that was counted while they were written."""
    stored, counts = store_observed(sessions, name, *count_columns())
    names = ["session_count", *(bucket for bucket, _, _ in VISIT_BUCKETS + STEP_BUCKETS)]
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])
    return stored, one_row(stored, counts, schema)


def shares(counts: DataFrame, *keys: Column) -> DataFrame:
    """keys, session_count and the share of each bucket to three decimals; NULL where there is no session."""
    buckets = [name for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS]
    ratios = (ratio_3(F.col(name), F.col("session_count")).alias(name) for name in buckets)
    return counts.select(*keys, "session_count", *ratios)
