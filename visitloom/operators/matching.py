"""Statistics of sessions for all tasks of a table at once.

Tasks with the same criteria are one criterion. Sessions that no criterion can tell apart are one profile, with counts in place
of sessions. Criteria that ask for the same kinds of values look at the profiles as cells: the profiles in these kinds alone, those
alike summed up. So a criterion that asks for ages meets a cell an age, however many sessions there are. A criterion is posted
under each of the values it asks for, of keywords, categories, cities, professions and sex at once; if it asks for none
of the first four, then also under the few aligned blocks of numbers its range of ages, or else of days, is made of. A cell looks up
its own values, and what it finds there is checked for the rest of the criteria; a pair counts where it meets under the least
values only, so no pair is counted twice and none is stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitloom.functions.times import parse_time
from visitloom.operators.observed import shares
from visitloom.operators.sessions import count_columns
from visitloom.schemas import STEP_BUCKETS, VISIT_BUCKETS
from visitloom.session import through_storage
from visitloom.sources.tasks import task_parameter

# Binary digits of the numbers in the index: ages, and days since 1970. Others are found by no index, and checked.
AGE_BITS, DAY_BITS = 8, 16

_COUNTS = ["session_count", *(name for name, _, _ in VISIT_BUCKETS + STEP_BUCKETS)]

_ARRAYS = ("professionals", "cities", "keywords", "categories")
_CRITERIA = ("start", "end", "low", "high", "sex", *_ARRAYS)

# Bits of what a criterion asks for, and of the blocks it is posted under.
_ASKED = ("start", "end", "low", "sex", *_ARRAYS)
_BIT = {name: 1 << k for k, name in enumerate((*_ASKED, "age blocks", "day blocks"))}
_LISTED = sum(_BIT[name] for name in _ARRAYS)


def _items(name: str) -> Column:
    """Distinct, sorted non-empty items of a list parameter, each element of which may be a comma list; NULL if there is none."""
    given = F.element_at(F.from_json("task_param", "map<string,array<string>>"), F.lit(name))
    parts = F.flatten(F.transform(F.filter(given, lambda v: v.isNotNull()), lambda v: F.split(v, ",")))
    items = F.array_sort(F.array_distinct(F.filter(parts, lambda v: v != "")))
    return F.when(F.size(items) > 0, items)


def _first(name: str) -> Column:
    value = task_parameter(F.col("task_param"), name)
    return F.when(value != "", value)


def task_criteria(tasks: DataFrame, key: str = "task_id") -> DataFrame:
    """(the key, start, end, low, high, sex, professionals, cities, keywords, categories); NULL asks for nothing.

    Ages are asked for if both bounds are there. Categories that are no numbers are left out.
    """
    both = _first("startAge").isNotNull() & _first("endAge").isNotNull()
    ids = F.array_sort(F.array_distinct(F.array_compact(F.transform(_items("clickCategoryIds"), lambda v: v.try_cast("bigint")))))
    return tasks.select(
        key,
        _first("startDate").alias("start"),
        _first("endDate").alias("end"),
        F.when(both, _first("startAge").cast("int")).alias("low"),
        F.when(both, _first("endAge").cast("int")).alias("high"),
        _first("sex").alias("sex"),
        _items("professionals").alias("professionals"),
        _items("cities").alias("cities"),
        _items("searchKeywords").alias("keywords"),
        F.when(_items("clickCategoryIds").isNotNull(), ids).alias("categories"),
    )


def _wanted(criteria: DataFrame, column: str, value: str) -> DataFrame:
    return criteria.select(F.explode(column).alias(value)).distinct()


def session_spans(actions: DataFrame, criteria: DataFrame) -> DataFrame:
    """Sessions as criteria with different dates see them: (session_id, user_id, before, first, last, after, visit_length,
    step_length, keywords, categories).

    A row holds the actions from `first` to `last`, days of the session; `before` and `after` are its days next to these, if any.
    A criterion sees the row whose days are those of its dates. A session of one day, as most are, has one row; one of d days
    has d * (d + 1) / 2. keywords and categories are the distinct ones that some criterion asks for.
    """
    bounds = criteria.agg(
        F.when(F.count(F.lit(1)) == F.count("start"), F.min("start")).alias("start"),
        F.when(F.count(F.lit(1)) == F.count("end"), F.max("end")).alias("end"),
    ).first()
    # No criterion looks at other days.
    days = actions.where(F.col("date").isNotNull())
    days = days if bounds["start"] is None else days.where(F.col("date") >= bounds["start"])
    days = days if bounds["end"] is None else days.where(F.col("date") <= bounds["end"])
    time = parse_time(F.col("action_time"))
    states = days.groupBy("session_id", "date").agg(
        F.min("user_id").alias("user_id"), F.min(time).alias("start"), F.max(time).alias("end"), F.count(F.lit(1)).alias("steps")
    )
    for column, source, value in (("keywords", "search_keyword", "keyword"), ("categories", "click_category_id", "category")):
        each = days.select("session_id", "date", F.col(source).alias(value)).where(F.col(value).isNotNull()).distinct()
        lists = each.join(_wanted(criteria, column, value), value, "left_semi")
        lists = lists.groupBy("session_id", "date").agg(F.collect_set(value).alias(column))
        same = states["session_id"].eqNullSafe(lists["session_id"]) & (states["date"] == lists["date"])
        states = states.join(lists, same, "left").select(states["*"], lists[column])
    day = F.struct("date", "user_id", "start", "end", "steps", "keywords", "categories").alias("day")
    whole = states.groupBy("session_id").agg(F.array_sort(F.collect_list(day)).alias("days"))
    places = "flatten(transform(sequence(1, n), i -> transform(sequence(i, n), j -> struct(i, j))))"
    spans = (
        whole.withColumn("n", F.size("days"))
        .select("session_id", "days", "n", F.expr(f"explode({places}) AS at"))
        .withColumn("part", F.expr("slice(days, at.i, at.j - at.i + 1)"))
    )

    def values(column: str) -> Column:
        return F.expr(f"array_sort(array_distinct(flatten(transform(part, d -> coalesce(d.{column}, array()))))) AS {column}")

    return spans.select(
        "session_id",
        F.expr("array_min(transform(part, d -> d.user_id)) AS user_id"),
        F.expr("IF(at.i > 1, days[at.i - 2].date, NULL) AS before"),
        F.expr("part[0].date AS first"),
        F.expr("part[size(part) - 1].date AS last"),
        F.expr("IF(at.j < n, days[at.j].date, NULL) AS after"),
        F.timestamp_diff(
            "SECOND", F.expr("array_min(transform(part, d -> d.start))"), F.expr("array_max(transform(part, d -> d.end))")
        ).alias("visit_length"),
        F.expr("aggregate(part, 0L, (n, d) -> n + d.steps) AS step_length"),
        values("keywords"),
        values("categories"),
    )


def _number(text: str) -> str:
    return f"datediff(try_to_date({text}, 'yyyy-MM-dd'), DATE'1970-01-01')"


def _blocks(low: str, high: str, bits: int) -> str:
    """SQL: the texts 'size:number' of the aligned blocks of 2^k numbers which the numbers from low to high are made of.

    A block is one of them if it lies inside and the block of twice its size around it does not.
    """
    whole = (1 << bits) - 1
    low, high = f"greatest({low}, 0)", f"least({high}, {whole})"
    # Of each size at most one block at either end: those with the first and the last number that can be whole.
    tests = (
        f"filter(array_distinct(array(shiftright({low} + shiftleft(1, k) - 1, k), shiftright({high} + 1, k) - 1)), "
        f"b -> shiftleft(b, k) >= {low} AND shiftleft(b + 1, k) - 1 <= {high} AND NOT (k < {bits} AND "
        f"shiftleft(shiftright(b, 1), k + 1) >= {low} AND shiftleft(shiftright(b, 1) + 1, k + 1) - 1 <= {high}))"
    )
    return f"flatten(transform(sequence(0, {bits}), k -> transform({tests}, b -> concat(k, ':', b))))"


def _ancestors(number: str, bits: int) -> str:
    """SQL: the texts of all blocks that hold a number; none for numbers outside."""
    listed = f"transform(sequence(0, {bits}), k -> concat(k, ':', shiftright({number}, k)))"
    return f"IF({number} BETWEEN 0 AND {(1 << bits) - 1}, {listed}, array())"


def _with_asks(criteria: DataFrame) -> DataFrame:
    """`criteria` with asks: the bits of what each asks for."""
    covered = f"{_number('start')} BETWEEN 0 AND {(1 << DAY_BITS) - 1} AND {_number('end')} BETWEEN 0 AND {(1 << DAY_BITS) - 1}"
    ages = f"low BETWEEN 0 AND {(1 << AGE_BITS) - 1} AND high BETWEEN 0 AND {(1 << AGE_BITS) - 1}"
    bits = " + ".join(f"IF({name} IS NULL, 0, {_BIT[name]})" for name in _ASKED)
    listed = " OR ".join(f"{name} IS NOT NULL" for name in _ARRAYS)
    blocks = f"CASE WHEN {listed} THEN 0 WHEN {ages} THEN {_BIT['age blocks']} WHEN {covered} THEN {_BIT['day blocks']} ELSE 0 END"
    return criteria.withColumn("asks", F.expr(f"{bits} + {blocks}"))


def _has(name: str) -> str:
    return f"(asks & {_BIT[name]}) != 0"


def _postings(criteria: DataFrame) -> DataFrame:
    """`criteria`, a row for each combination of values it asks for: professional, city, keyword, category, block."""
    blocks = (
        f"CASE WHEN {_has('age blocks')} THEN {_blocks('low', 'high', AGE_BITS)} "
        f"WHEN {_has('day blocks')} THEN {_blocks(_number('start'), _number('end'), DAY_BITS)} ELSE array('') END"
    )
    posted = criteria.withColumn("block", F.explode(F.expr(blocks)))
    for value, values in (("professional", "professionals"), ("city", "cities"), ("keyword", "keywords"), ("category", "categories")):
        posted = posted.withColumn(value, F.explode_outer(values))
    return posted


def profile_cells(profiles: DataFrame, asks: list[int]) -> DataFrame:
    """Profiles as criteria with each of the `asks` see them: the values of other kinds NULL, those alike summed up.

    Profiles that cannot meet such criteria are left out: those without a value of a kind, and spans that leave out days of their
    session where no date is asked for.
    """
    each = profiles.withColumn("asks", F.explode(F.array(*map(F.lit, asks))))
    fit = [f"({_has('start')} OR before IS NULL)", f"({_has('end')} OR after IS NULL)"]
    kept = {"before": "start", "first": "start", "last": "end", "after": "end"}
    for column, name in (("age", "low"), ("sex", "sex"), ("professional", "professionals"), ("city", "cities")):
        fit.append(f"(NOT {_has(name)} OR {column} IS NOT NULL)")
        kept[column] = name
    for column in ("keywords", "categories"):
        fit.append(f"(NOT {_has(column)} OR size({column}) > 0)")
        kept[column] = column
    # The bits decide which rows come to be at all, the values which are alike.
    cells = each.where(" AND ".join(fit)).select(
        "asks", *(F.expr(f"IF({_has(name)}, {column}, NULL) AS {column}") for column, name in kept.items()), *_COUNTS
    )
    return cells.groupBy("asks", *kept).agg(*(F.sum(c).alias(c) for c in _COUNTS))


def _lookups(cells: DataFrame) -> DataFrame:
    """`cells` with keyword, category and block, a row for each combination they look up."""
    blocks = (
        f"CASE WHEN {_has('age blocks')} THEN {_ancestors('age', AGE_BITS)} "
        f"WHEN {_has('day blocks')} THEN {_ancestors(_number('first'), DAY_BITS)} ELSE array('') END"
    )
    looked = cells.withColumn("block", F.explode(F.expr(blocks)))
    return looked.withColumn("keyword", F.explode_outer("keywords")).withColumn("category", F.explode_outer("categories"))


# All criteria of a pair that met. Of several keywords or categories by which a pair meets, the least counts.
_MET = """
    p.asks = c.asks AND p.block = c.block AND p.professional <=> c.professional AND p.city <=> c.city AND p.sex <=> c.sex
    AND p.keyword <=> c.keyword AND p.category <=> c.category
    AND (c.start IS NULL OR c.start <= p.first) AND (p.before IS NULL OR coalesce(p.before < c.start, false))
    AND (c.end IS NULL OR c.end >= p.last) AND (p.after IS NULL OR coalesce(p.after > c.end, false))
    AND (c.low IS NULL OR coalesce(p.age BETWEEN c.low AND c.high, false))
    AND (c.keywords IS NULL OR coalesce(p.keyword = array_min(array_intersect(c.keywords, p.keywords)), false))
    AND (c.categories IS NULL OR coalesce(p.category = array_min(array_intersect(c.categories, p.categories)), false))"""


def session_profiles(spans: DataFrame, users: DataFrame) -> DataFrame:
    """Spans of known users, those alike in all that criteria look at as one row with `session_counts`."""
    known = spans.join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")
    alike = ("before", "first", "last", "after", "age", "professional", "city", "sex", "keywords", "categories")
    return known.groupBy(*alike).agg(*count_columns())


def statistics_per_task(actions: DataFrame, users: DataFrame, tasks: DataFrame) -> DataFrame:
    """`session_aggr_stat` of each task (task_id, task_param): as `session_statistics` of `select_sessions`, for all at once.

    A task without sessions has 0 and NULL shares; repeated rows of a task each give a row. A NULL parameter asks for nothing.
    """
    # Many tasks have the same text, which is read once.
    given = task_criteria(tasks.select("task_param").distinct(), "task_param")
    given = given.withColumn("criterion", F.sha2(F.to_json(F.struct(*_CRITERIA)), 256))
    given = through_storage(given, "task-criteria")
    criteria = given.groupBy("criterion").agg(*(F.first(c).alias(c) for c in _CRITERIA))
    criteria = through_storage(_with_asks(criteria), "criteria")
    asks = sorted(r["asks"] for r in criteria.select("asks").distinct().collect())  # no more than there are sums of bits
    profiles = session_profiles(session_spans(actions, criteria), users)
    met = _lookups(profile_cells(profiles, asks)).alias("p").join(_postings(criteria).alias("c"), F.expr(_MET))
    found = met.groupBy("criterion").agg(*(F.sum(f"p.{c}").alias(c) for c in _COUNTS))
    known = given.select("task_param", "criterion")
    each = tasks.join(known, tasks["task_param"].eqNullSafe(known["task_param"])).select("task_id", "criterion")
    each = each.join(found, "criterion", "left")
    return shares(each.na.fill(0, _COUNTS), F.col("task_id"))
