"""Grouping and whole-table reductions.

Where the result itself is a list, it is given in pages of `page_rows` values, one row
each, by position in the sorted list: page 0 holds the first `page_rows` values, and the
pages in order are the list. What one key's pages are depends on its own values only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.operators.positions import with_starts
from visitloom.session import through_storage

# Values of a page, if the caller does not say.
PAGE_ROWS = 100_000


def count_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value; NULL is a value of its own."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def sum_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias("total"))


def total(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.sum(value).alias("total"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def _paged(values: DataFrame, keys: Sequence[str], lists: Sequence[str], page_rows: int) -> DataFrame:
    """(…keys, page, …lists) of rows (…keys, list, a column of each list's name).

    Rows are counted by key and list first, which Spark combines before the shuffle. Keys whose lists fit a page have
    just that page; only the values of others need positions.
    """
    if not keys:
        return _by_position(values, keys, lists, page_rows)
    sizes = values.groupBy(*keys, "list").agg(F.count(F.lit(1)).alias("n"))
    large = through_storage(sizes.where(F.col("n") > page_rows).select(*keys).distinct(), "large-keys")
    if large.isEmpty():
        return _in_one_page(values, keys, lists)
    named = large.select(*(F.col(k).alias(f"large_{k}") for k in keys))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"large_{k}")) for k in keys))
    small = _in_one_page(values.join(named, same, "left_anti"), keys, lists)
    return small.unionByName(_by_position(values.join(named, same, "left_semi"), keys, lists, page_rows))


def _in_one_page(values: DataFrame, keys: Sequence[str], lists: Sequence[str]) -> DataFrame:
    def listed(name: str) -> Column:
        mine = F.collect_list(F.when(F.col("list") == name, F.struct(F.col(name).alias("value"))))
        return F.transform(F.sort_array(mine), lambda s: s["value"]).alias(name)

    page = F.lit(0).cast("bigint").alias("page")
    grouped = values.groupBy(*keys).agg(*(listed(name) for name in lists))
    return grouped.select(*keys, page, *lists)


def _by_position(values: DataFrame, keys: Sequence[str], lists: Sequence[str], page_rows: int) -> DataFrame:
    """A row belongs to the list it names, with the value in that column; the others are NULL. Equal rows are
    counted first, so that no value is hot; each then knows the pages it is on.
    """
    counted = values.groupBy(*keys, "list", *lists).agg(F.count(F.lit(1)).alias("n"))
    placed = with_starts(counted, [*keys, "list"], [F.asc_nulls_first(name) for name in lists], "n")
    pages = F.expr(f"explode(sequence((start - 1) div {page_rows}, (start + n - 2) div {page_rows}))")
    on_page = f"least(start + n, (page + 1) * {page_rows} + 1) - greatest(start, page * {page_rows} + 1)"
    spread = placed.withColumn("page", pages).withColumn("copies", F.expr(f"CAST({on_page} AS int)"))

    def listed(name: str) -> Column:
        mine = F.collect_list(F.when(F.col("list") == name, F.struct("start", F.col(name).alias("value"), "copies")))
        return F.flatten(F.transform(F.array_sort(mine), lambda s: F.array_repeat(s["value"], s["copies"]))).alias(name)

    return spread.groupBy(*keys, "page").agg(*(listed(name) for name in lists))


def _listed(df: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    return df.select(*keys, F.lit(name).alias("list"), F.col(value).alias(name))


def values_by_key(df: DataFrame, key: str, value: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(key, page, values): the sorted values of every key, NULL first, in pages."""
    return _paged(_listed(df, [key], "values", value), [key], ["values"], page_rows)


def cogroup(left: DataFrame, right: DataFrame, key: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(key, page, left_values, right_values): the sorted values of both sides of every key
    found on either, each side in pages of its own; a page without values of a side has an
    empty list there. Each side is a (key, value) frame. Both sides are grouped together.
    """
    names = ("left_values", "right_values")
    sides = []
    for df, name in zip((left, right), names, strict=True):
        value = next(c for c in df.columns if c != key)
        sides.append(_listed(df, [key], name, value))
    return _paged(sides[0].unionByName(sides[1], allowMissingColumns=True), [key], names, page_rows)


def all_values(df: DataFrame, value: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(page, values): the sorted values of the whole table, in pages."""
    return _paged(_listed(df, [], "values", value), [], ["values"], page_rows)


def joined_text(df: DataFrame, value: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(page, text): all values, sorted, with `_` after each; the pages' texts, in order, are the whole."""
    texts = F.array_join(F.transform("values", lambda v: v.cast("string")), "_", "null")
    return all_values(df, value, page_rows).select("page", F.concat(texts, F.lit("_")).alias("text"))


def count_map(df: DataFrame, key: str, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(page, counts): rows per non-NULL key as maps of `page_rows` keys each, by position of the sorted keys."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    placed = with_starts(counts.withColumn("one", F.lit(1).cast("bigint")), (), [F.asc(key)], "one")
    page = F.expr(f"(start - 1) div {page_rows}").alias("page")
    entries = F.array_sort(F.collect_list(F.struct(key, "rows")))
    return placed.groupBy(page).agg(F.map_from_entries(entries).alias("counts"))


def keyed_sum(df: DataFrame, column: str, preset: Sequence[str] = ("ONE", "TWO", "THREE")) -> DataFrame:
    """Sums of `KEY:number` texts, several of which may be joined by `_`.

    Keys are compared in upper case; the preset keys are there even with a sum
    of 0; entries of another form are left out.
    """
    pair = F.split("entry", ":")
    given = df.select(F.explode(F.split(column, "_")).alias("entry")).where(
        F.col("entry").rlike("^[^:]*:[^:]+:*\\z")
    )
    sums = given.select(
        F.upper(F.get(pair, F.lit(0))).alias("key"), F.get(pair, F.lit(1)).try_cast("bigint").alias("number")
    ).where(F.col("number").isNotNull())
    keys = F.explode(F.array(*(F.lit(k.upper()) for k in preset)).cast("array<string>"))
    zeros = df.sparkSession.range(1).select(keys.alias("key"), F.lit(0).cast("bigint").alias("number"))
    return sums.unionByName(zeros).groupBy("key").agg(F.sum("number").alias("total"))
