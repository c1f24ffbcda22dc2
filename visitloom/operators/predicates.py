"""Row filters. A predicate never yields NULL, and a missing parameter lets every row pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_range(actions: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Actions from `start` to `end`, both included; a missing bound is open."""
    if start is not None and end is not None:
        return actions.where(F.col("date").between(start, end))
    if start is not None:
        actions = actions.where(F.col("date") >= F.lit(start))
    if end is not None:
        actions = actions.where(F.col("date") <= F.lit(end))
    return actions


def in_range(data: Column, low: int | None, high: int | None) -> Column:
    """low <= data <= high; passes if a bound is missing, fails if the data is."""
    if low is None or high is None:
        return F.lit(True)
    return data.isNotNull() & data.between(low, high)


def one_of(data: Column, wanted: Sequence) -> Column:
    """A single value among those wanted."""
    if not wanted:
        return F.lit(True)
    return data.isNotNull() & data.isin(list(wanted))


def any_of(data: Column, wanted: Sequence) -> Column:
    """A list that shares an item with those wanted."""
    if not wanted:
        return F.lit(True)
    return F.coalesce(F.arrays_overlap(data, F.array(*(F.lit(w) for w in wanted))), F.lit(False))


def equals(data: Column, wanted) -> Column:
    if wanted is None:
        return F.lit(True)
    return data.isNotNull() & (data == F.lit(wanted))


def with_value(actions: DataFrame, column: str) -> DataFrame:
    """Actions of the kind that fills `column`."""
    return actions.where(F.col(column).isNotNull())


def _bad_coordinate(text: Column) -> Column:
    parts = F.split(text, ",")
    latitude = F.get(parts, F.lit(0)).try_cast("double")
    longitude = F.get(parts, F.lit(1)).try_cast("double")
    return F.coalesce((F.abs(latitude) > 90) | (F.abs(longitude) > 180), F.lit(True))


def split_coordinates(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose `lat,lon` text is valid, and the others (out of range or unreadable)."""
    bad = _bad_coordinate(F.col(column))
    return df.where(~bad), df.where(bad)
