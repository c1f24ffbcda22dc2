"""Sorting and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.operators.positions import numbered


def sort_rows(df: DataFrame, key: str, tie_break: str, descending: bool = False) -> DataFrame:
    """Rows by `key`. The tie-break makes the order total, and lets the range
    partitioning of the sort split a key that many rows share."""
    return df.orderBy(*_order(key, tie_break, descending))


def _order(key: str, tie_break: str, descending: bool) -> list[Column]:
    return [F.desc(key) if descending else F.asc(key), F.asc(tie_break)]


def sorted_positions(df: DataFrame, key: str, tie_break: str, descending: bool = False) -> DataFrame:
    """Rows with their `position` in that order, which outlasts any later shuffle."""
    return numbered(df, *_order(key, tie_break, descending))


def first_rows(df: DataFrame, n: int, key: str, tie_break: str) -> DataFrame:
    """The first n rows by `key`; kept per task, so the sort never holds more than n each."""
    return df.orderBy(F.asc(key), F.asc(tie_break)).limit(n)


def any_rows(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)
