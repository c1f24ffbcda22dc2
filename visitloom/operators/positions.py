"""Positions of rows in a sorted order, counted without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitloom.session import through_storage


def with_starts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], size: str) -> DataFrame:
    """`df` with `start`: the position, from 1 in each group of `keys`, of the first of its `size` rows.

    Rows are dealt into ranges of keys and order and stored, so that both steps see the same ranges. Rows are
    counted within each range, and what the earlier ranges hold of the same group is added. So a group that holds
    most of the rows lies in many ranges. The order has to be total.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("range", F.spark_partition_id())
    ranged = through_storage(ranged, "ranged-rows")
    inside = Window.partitionBy("range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("range", *keys).agg(F.sum(size).alias("held"))
    # One row for each range that a group lies in.
    earlier = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    ahead = F.sum("held").over(earlier.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("range", *keys, F.coalesce(ahead, F.lit(0)).alias("ahead"))
    left, right = ranged.alias("l"), offsets.alias("r")
    same = F.col("l.range") == F.col("r.range")
    for key in keys:
        same = same & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    placed = left.withColumn("before", F.coalesce(F.sum(size).over(inside), F.lit(0))).alias("l").join(right, same)
    return placed.select(*(F.col(f"l.{c}") for c in df.columns), (F.expr("l.before + r.ahead") + 1).alias("start"))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`df` with `position`, from 1, in a total order."""
    once = df.withColumn("rows_here", F.lit(1).cast("bigint"))
    return with_starts(once, (), order, "rows_here").drop("rows_here").withColumnRenamed("start", "position")
