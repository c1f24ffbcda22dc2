"""Equi-joins. None is hinted unless its small side has a proven bound: Spark picks
a broadcast by measured size, and AQE splits skewed sides of sort-merge joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def inner_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key)


def rows_of(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """All actions of the given sessions."""
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


def full_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer join of frames that share only `key`; NULL keys match nothing.

    Spark cannot split a skewed key of a full outer join. Here the matches are
    an inner join, which AQE splits on both sides, and the rows without a match
    are anti joins against the other side's distinct keys.
    """
    rest = [c for c in right.columns if c != key]
    columns = [key, *[c for c in left.columns if c != key], *rest]
    matched = left.join(right, key).select(*columns)
    left_only = left.join(right.select(key).distinct(), key, "left_anti")
    right_only = right.join(left.select(key).distinct(), key, "left_anti")
    return matched.unionByName(left_only, allowMissingColumns=True).unionByName(
        right_only, allowMissingColumns=True
    )
