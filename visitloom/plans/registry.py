"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.functions import in_sql, numbers, texts, times
from visitloom.operators import categories, daily, grouping, joins, matching, observed, ordering, predicates, sampling, sessions
from visitloom.plans.job import JobOptions, SessionJob, category_job, statistics_job
from visitloom.schemas import PERSON, SESSION_AGGR_STAT, TOP10_CATEGORY_SESSION, USER_VISIT_ACTION
from visitloom.session import scratch_path
from visitloom.sources import bucketed, files, runs, sinks, tables, tasks

Query = Callable[[SparkSession, str], DataFrame]

START, END, MIDDLE, AFTER_MIDDLE = "2024-01-07", "2024-01-29", "2024-01-18", "2024-01-19"
TASK = tasks.Criteria.from_json(
    '{"startDate":["2024-01-07"],"endDate":["2024-01-29"],"startAge":[20],"endAge":[30]}'
)
NARROW_TASK = tasks.Criteria.from_json(
    '{"startDate":["2024-01-07"],"endDate":["2024-01-29"],"startAge":[10],"endAge":[50],'
    '"professionals":["BUILDING,MACHINERY,HOUSEHOLD"],"sex":["male"],'
    '"cities":["NATION_1,NATION_2,NATION_3,NATION_5,NATION_8,NATION_13,NATION_19,NATION_21"],'
    '"searchKeywords":["kw1,kw3,kw5,kw7,kw9"],'
    '"clickCategoryIds":["1,5,10,12,17,20,23,25,30,34,38,40,45,50,51,56,60,62,67,70,73,75,80,84,89,90,95,97"]}'
)
OPTIONS = JobOptions(task_id=1, sample_target=1000)

QUERIES: dict[str, Query] = {}
SURVEY_ID: dict[str, str] = {}


class Tables:
    """The given tables of one folder, and the two input tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def actions(self) -> DataFrame:
        return tables.actions_from_events(self.events)

    @cached_property
    def days(self) -> DataFrame:
        """Actions in the dates of the tasks; the dates bound the scan."""
        return tables.actions_from_events(self.events, START, END)

    @cached_property
    def users(self) -> DataFrame:
        return tables.users_from_customers(self.customer, self.nation)

    @cached_property
    def summary(self) -> DataFrame:
        return sessions.session_summary(self.actions)

    @cached_property
    def selected(self) -> DataFrame:
        return sessions.select_sessions(self.days, self.users, TASK)

    @cached_property
    def job(self) -> SessionJob:
        return SessionJob(self.days, self.users, TASK, OPTIONS)

    @cached_property
    def bucketed_actions(self) -> DataFrame:
        return bucketed.bucketed(self.actions, 8)

    @cached_property
    def committed(self) -> runs.RunStore:
        """The five result tables of one task, stored together."""
        store = runs.RunStore(scratch_path(self.spark, "committed-results"))
        with store.attempt(self.spark, OPTIONS.task_id) as attempt:
            self.job.run(attempt)
        return store

    @cached_property
    def days_stored(self) -> daily.DayStore:
        """States by day: of all days at once, then of one day by itself."""
        store = daily.DayStore(scratch_path(self.spark, "day-states"))
        store.put_all(self.actions)
        store.put(tables.actions_from_events(self.events, MIDDLE, MIDDLE), MIDDLE)
        return store

    @cached_property
    def many_tasks(self) -> DataFrame:
        """A task for each customer, with criteria of all kinds."""
        key = F.col("c_custkey")

        def field(condition, name: str, *values):
            listed = F.concat_ws(",", *(F.concat(F.lit('"'), v.cast("string"), F.lit('"')) for v in values))
            return F.when(condition, F.concat(F.lit(f'"{name}":['), listed, F.lit("]")))

        day = lambda n: F.concat(F.lit("2024-01-"), F.lpad(n.cast("string"), 2, "0"))
        fields = (
            field(key % 2 == 0, "startDate", day(1 + key % 20)),
            field(key % 3 != 1, "endDate", day(10 + key % 21)),
            field(key % 3 == 0, "startAge", key % 40),
            field(key % 3 != 2, "endAge", key % 40 + 20),
            field(key % 4 == 1, "professionals", F.col("c_mktsegment"), F.lit("MACHINERY")),
            field(key % 7 == 3, "cities", F.concat(F.lit("NATION_"), key % 25), F.lit("NATION_3")),
            field(key % 5 == 2, "sex", F.lit("male")),
            field(key % 6 == 1, "searchKeywords", F.concat(F.lit("kw"), key % 10), F.lit("kw3")),
            field(key % 11 == 4, "clickCategoryIds", key % 100, (key + 7) % 100, (key + 50) % 100),
        )
        param = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
        return self.customer.select(key.alias("task_id"), param.alias("task_param"))

    @cached_property
    def tasks(self) -> DataFrame:
        """One task per customer."""
        key = F.col("c_custkey")
        param = F.concat(
            F.lit('{"startDate":["2024-01-07"],"endDate":["2024-01-29"],"startAge":['),
            key % 60,
            F.lit('],"professionals":["'),
            F.col("c_mktsegment"),
            F.lit('","MACHINERY"],"cities":[]'),
            F.when(key % 2 == 1, F.lit(',"sex":["female"]')).otherwise(F.lit("")),
            F.lit("}"),
        )
        return self.customer.select(
            key.alias("task_id"),
            F.col("c_name").alias("task_name"),
            F.lit("2024-01-01 00:00:00").alias("create_time"),
            F.lit(None).cast("string").alias("start_time"),
            F.lit(None).cast("string").alias("finish_time"),
            F.lit("session").alias("task_type"),
            F.lit("new").alias("task_status"),
            param.alias("task_param"),
        )


def query(survey_id: str):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = lambda spark, folder: build(Tables(spark, folder))
        SURVEY_ID[build.__name__] = survey_id
        return build

    return register


def _text(df: DataFrame) -> DataFrame:
    return sessions.list_text(df)


def _own() -> str:
    """A part of view names by which queries of one session do not disturb each other."""
    return "_" + uuid.uuid4().hex


# Sources and sinks


@query("A1")
def action_log(t: Tables) -> DataFrame:
    actions, _ = tables.register_views(t.actions, t.users, _own())
    return t.spark.table(actions)


@query("A2")
def user_info(t: Tables) -> DataFrame:
    _, users = tables.register_views(t.actions, t.users, _own())
    return t.spark.table(users)


@query("A3")
def json_lines(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "events-json")
    t.events.select(
        "event_id",
        "event_type",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.when(F.col("event_type") == "click", F.col("value")).alias("value"),
    ).write.json(path)
    return files.read_json_lines(t.spark, path)


def _people_text(t: Tables) -> str:
    path = scratch_path(t.spark, "people-text")
    t.customer.select(F.concat("c_name", F.lit(", "), F.col("c_custkey") % 60).alias("value")).write.text(path)
    return path


@query("A4")
def people_lines(t: Tables) -> DataFrame:
    return files.read_people_lines(t.spark, _people_text(t))


@query("A5")
def text_columns(t: Tables) -> DataFrame:
    return files.read_text_columns(t.spark, _people_text(t), "name age")


@query("A6")
def local_collection(t: Tables) -> DataFrame:
    meaning = files.local_rows(
        t.spark, [("F", "filled"), ("O", "open"), ("P", "partial")], "o_orderstatus string, meaning string", 3
    )
    return grouping.count_by(t.orders.join(meaning, "o_orderstatus"), "meaning")


@query("A7")
def typed_people(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "people-json")
    age = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey") % 60)
    t.customer.select(age.alias("age"), F.col("c_name").alias("name")).write.json(path)
    return tables.typed_by_name(files.read_json_lines(t.spark, path), PERSON)


@query("A8")
def view_sql(t: Tables) -> DataFrame:
    actions, _ = tables.register_views(t.actions, t.users, _own())
    return t.spark.sql(f"SELECT action, count(*) AS actions FROM {actions} GROUP BY action")


@query("A9")
def global_view_sql(t: Tables) -> DataFrame:
    view = f"user_info_{uuid.uuid4().hex}"
    t.users.createGlobalTempView(view)
    return t.spark.newSession().sql(f"SELECT city, count(*) AS users FROM global_temp.{view} GROUP BY city")


@query("A10")
def appended_tables(t: Tables) -> DataFrame:
    sink = sinks.TableSink(scratch_path(t.spark, "results"))
    for first, last in ((None, MIDDLE), (AFTER_MIDDLE, None)):
        days = predicates.date_range(t.actions, first, last)
        sink.append(categories.top_categories(categories.category_counts(days)), "top10_category")
    return sink.read(t.spark, "top10_category")


@query("A11")
def task_by_id(t: Tables) -> DataFrame:
    return tasks.find_task(t.tasks, 7)


# Projections, filters, predicates


@query("B1")
def actions_in_dates(t: Tables) -> DataFrame:
    return predicates.date_range(t.days, START, END)


@query("B2")
def task_parameters(t: Tables) -> DataFrame:
    return tasks.with_task_parameters(t.tasks)


@query("B3")
def number_in_range(t: Tables) -> DataFrame:
    category = F.col("click_category_id")
    return t.actions.select(
        "session_id",
        "action_time",
        "click_category_id",
        predicates.in_range(category, 20, 50).alias("in_range"),
        predicates.in_range(category, 20, None).alias("one_sided"),
    )


@query("B4")
def any_of_list(t: Tables) -> DataFrame:
    return t.actions.select(
        "session_id",
        "action_time",
        predicates.any_of(texts.id_texts(F.col("order_category_ids")), ["5", "42", "79"]).alias("list_matches"),
        predicates.one_of(F.col("search_keyword"), ["kw1", "kw4"]).alias("value_matches"),
        predicates.any_of(texts.id_texts(F.col("order_category_ids")), []).alias("nothing_asked"),
    )


@query("B5")
def equal_value(t: Tables) -> DataFrame:
    return t.actions.select(
        "session_id",
        "action_time",
        predicates.equals(F.col("search_keyword"), "kw3").alias("matches"),
        predicates.equals(F.col("search_keyword"), None).alias("nothing_asked"),
    )


@query("B6")
def selected_sessions(t: Tables) -> DataFrame:
    return sessions.select_sessions(t.days, t.users, NARROW_TASK)


@query("B7")
def order_actions(t: Tables) -> DataFrame:
    return predicates.with_value(t.actions, "order_category_ids")


@query("B8")
def projected_users(t: Tables) -> DataFrame:
    return t.users.select("name", "city", "sex")


@query("B9")
def arithmetic(t: Tables) -> DataFrame:
    return t.actions.select(
        "session_id",
        "action_time",
        (F.col("click_category_id") + 1).alias("plus_one"),
        (F.col("page_id") * 2).alias("doubled"),
    )


@query("B10")
def older_users(t: Tables) -> DataFrame:
    return t.users.where(F.col("age") > 21).select("user_id", "age")


@query("B10")
def teenagers(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT name, age FROM {people} WHERE age BETWEEN 13 AND 19", people=t.users)


@query("B10")
def even_categories(t: Tables) -> DataFrame:
    return t.actions.where(F.col("click_category_id") % 2 == 0).select("session_id", "action_time", "click_category_id")


@query("B11")
def name_labels(t: Tables) -> DataFrame:
    return t.users.where(F.col("age").between(13, 19)).select(F.concat(F.lit("Name: "), "name").alias("value"))


@query("B12")
def document_words(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(texts.words(F.col("text"))).alias("word"))


def _coordinates(t: Tables) -> tuple[DataFrame, DataFrame]:
    key = F.col("c_custkey")
    text = F.concat_ws(",", ((key * 7) % 210 - 105).cast("string"), ((key * 13) % 410 - 205).cast("string"))
    return predicates.split_coordinates(t.customer.select("c_custkey", text.alias("coordinates")), "coordinates")


@query("B13")
def invalid_coordinates(t: Tables) -> DataFrame:
    return _coordinates(t)[1]


@query("B13")
def valid_coordinates(t: Tables) -> DataFrame:
    return _coordinates(t)[0]


# Joins


@query("C1")
def sessions_with_users(t: Tables) -> DataFrame:
    return sessions.with_users(t.summary, t.users)


@query("C2")
def selected_actions(t: Tables) -> DataFrame:
    return joins.rows_of(t.days, t.selected)


@query("C3")
def sampled_details(t: Tables) -> DataFrame:
    sample = sampling.sample_sessions(t.summary, 1000)
    return sampling.sampled_details(t.actions, sample)


@query("C4")
def joined_category_counts(t: Tables) -> DataFrame:
    return categories.joined_category_counts(t.actions)


@query("C4")
def category_counts(t: Tables) -> DataFrame:
    return categories.category_counts(t.actions)


@query("C5")
def clicks_in_top_categories(t: Tables) -> DataFrame:
    top = categories.top_categories(categories.category_counts(t.actions))
    return categories.clicks_in_categories(t.actions, top)


@query("C6")
def customers_with_orders(t: Tables) -> DataFrame:
    left = t.customer.select(F.col("c_custkey").alias("key"), "c_name")
    right = t.orders.select(F.col("o_custkey").alias("key"), "o_orderkey", "o_totalprice")
    return joins.inner_join(left, right, "key")


@query("C7")
def customers_cogrouped_with_orders(t: Tables) -> DataFrame:
    left = t.customer.select((F.col("c_custkey") + 10).alias("key"), "c_name")
    right = t.orders.select(F.col("o_custkey").alias("key"), "o_orderkey")
    return _text(grouping.cogroup(left, right, "key", page_rows=3))


@query("C8")
def customers_joined_with_themselves(t: Tables) -> DataFrame:
    """One side is moved by ten keys, so that either side has rows without a partner."""
    left = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("left_value"))
    right = t.customer.select((F.col("c_custkey") + 10).alias("key"), F.col("c_acctbal").alias("right_value"))
    return joins.full_join(left, right, "key")


@query("C8")
def customers_full_joined_with_orders(t: Tables) -> DataFrame:
    left = t.customer.select((F.col("c_custkey") + 10).alias("key"), "c_name")
    right = t.orders.select(F.col("o_custkey").alias("key"), "o_orderkey")
    return joins.full_join(left, right, "key")


# Aggregations


@query("D1")
def session_records(t: Tables) -> DataFrame:
    return _text(sessions.session_records(t.actions))


@query("D1")
def session_summary(t: Tables) -> DataFrame:
    return t.summary


@query("D1b")
def session_values(t: Tables) -> DataFrame:
    return sessions.session_values(t.actions)


@query("D1b")
def wide_session_records(t: Tables) -> DataFrame:
    return _text(sessions.wide_session_records(t.actions))


@query("D2")
def session_counts(t: Tables) -> DataFrame:
    return sessions.session_counts(t.summary)


@query("D2")
def selected_session_counts(t: Tables) -> DataFrame:
    return sessions.session_counts(t.selected)


@query("D3")
def session_statistics(t: Tables) -> DataFrame:
    return statistics_job(t.days, TASK)


@query("D4")
def click_counts(t: Tables) -> DataFrame:
    return categories.click_counts(t.actions)


@query("D5")
def order_counts(t: Tables) -> DataFrame:
    return categories.order_counts(t.actions)


@query("D6")
def pay_counts(t: Tables) -> DataFrame:
    return categories.pay_counts(t.actions)


@query("D7")
def category_universe(t: Tables) -> DataFrame:
    return categories.category_universe(t.actions)


@query("D8")
def sessions_per_hour(t: Tables) -> DataFrame:
    return sampling.sessions_per_hour(t.summary)


@query("D9")
def hourly_quota(t: Tables) -> DataFrame:
    return sampling.hourly_quota(sampling.sessions_per_hour(t.summary), 1000)


@query("D10")
def session_category_clicks(t: Tables) -> DataFrame:
    return categories.session_category_clicks(t.actions)


@query("D11")
def rows_per_keyword(t: Tables) -> DataFrame:
    return grouping.count_by(t.actions, "search_keyword")


@query("D12")
def orders_per_customer(t: Tables) -> DataFrame:
    return _text(grouping.values_by_key(t.orders, "o_custkey", "o_orderkey", page_rows=4))


@query("D13")
def quantity_per_supplier(t: Tables) -> DataFrame:
    return grouping.sum_by(t.lineitem, "l_suppkey", "l_quantity")


@query("D14")
def total_quantity(t: Tables) -> DataFrame:
    return grouping.total(t.lineitem, "l_quantity")


@query("D15")
def lineitem_count(t: Tables) -> DataFrame:
    return grouping.row_count(t.lineitem)


@query("D16")
def orders_per_priority(t: Tables) -> DataFrame:
    return grouping.count_by(t.orders, "o_orderpriority")


@query("D16")
def customer_order_map(t: Tables) -> DataFrame:
    maps = grouping.count_map(t.orders, "o_custkey", page_rows=50)
    return maps.select("page", F.explode("counts").alias("o_custkey", "rows"))


@query("D17")
def listed_coordinates(t: Tables) -> DataFrame:
    return _text(grouping.all_values(_coordinates(t)[1], "coordinates", page_rows=20))


@query("D18")
def keyed_sum(t: Tables) -> DataFrame:
    number = F.get_json_object("props", "$.k")
    return grouping.keyed_sum(
        t.events.select(F.concat("event_type", F.lit(":"), number).alias("given")), "given", ["VIEW", "REFUND"]
    )


@query("D19")
def joined_names(t: Tables) -> DataFrame:
    return grouping.joined_text(t.customer, "c_name", page_rows=20)


# Ranking, sampling, top-k


@query("E1")
def top_categories(t: Tables) -> DataFrame:
    return categories.top_categories(categories.category_counts(t.actions))


@query("E1")
def top_categories_of_selected(t: Tables) -> DataFrame:
    return categories.top_categories(categories.category_counts(joins.rows_of(t.days, t.selected)))


@query("E1b")
def ranked_categories(t: Tables) -> DataFrame:
    return category_job(t.days, TASK)


@query("E2")
def top_sessions(t: Tables) -> DataFrame:
    top = categories.top_categories(categories.category_counts(t.actions))
    return categories.top_sessions(t.actions, top)


@query("E3")
def sampled_sessions(t: Tables) -> DataFrame:
    return sampling.sample_sessions(t.summary, 1000)


@query("E4")
def sampled_records(t: Tables) -> DataFrame:
    sample = sampling.sample_sessions(t.summary, 1000)
    return sampling.sampled_records(sampling.sampled_details(t.actions, sample))


# Sorts, limits, set operations


@query("F1")
def orders_by_price(t: Tables) -> DataFrame:
    return ordering.sorted_positions(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("F1")
def orders_by_price_descending(t: Tables) -> DataFrame:
    return ordering.sorted_positions(
        t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", descending=True
    )


@query("F2")
def cheapest_orders(t: Tables) -> DataFrame:
    return ordering.first_rows(t.orders.select("o_orderkey", "o_totalprice"), 3, "o_totalprice", "o_orderkey")


@query("F3")
def some_actions(t: Tables) -> DataFrame:
    """How many rows the limit gives, and how many of them are rows of the table."""
    rows = ordering.any_rows(t.actions.select("session_id", "action_time", "page_id"), 3)
    found = t.actions.select("session_id", "action_time", "page_id").withColumn("there", F.lit(1)).distinct()
    joined = rows.join(found, ["session_id", "action_time", "page_id"], "left")
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count("there").alias("of_the_table"))


@query("G1")
def distinct_pairs(t: Tables) -> DataFrame:
    return grouping.distinct_rows(t.actions, "user_id", "action")


# Scalar functions

def _mixed():
    """Times, with other texts among them."""
    return F.coalesce("search_keyword", "action_time")


@query("H1")
def date_hours(t: Tables) -> DataFrame:
    return t.actions.select("session_id", "action_time", times.date_hour(F.col("action_time")).alias("date_hour"))


@query("H2")
def parsed_times(t: Tables) -> DataFrame:
    parsed = times.parse_time(_mixed())
    return t.actions.select(
        "session_id",
        _mixed().alias("given"),
        times.format_time(parsed).alias("time"),
        times.format_date(parsed).alias("date"),
    )


@query("H3")
def before_and_after(t: Tables) -> DataFrame:
    fixed = F.lit("2024-01-15 12:00:00")
    return t.actions.select(
        "session_id",
        _mixed().alias("given"),
        times.before(_mixed(), fixed).alias("before"),
        times.after(_mixed(), fixed).alias("after"),
    )


@query("H4")
def seconds_between(t: Tables) -> DataFrame:
    fixed = F.lit("2024-01-15 12:00:00")
    return t.actions.select("session_id", _mixed().alias("given"), times.seconds_between(_mixed(), fixed).alias("seconds"))


@query("H5")
def current_dates(t: Tables) -> DataFrame:
    """How the dates of the clock relate, which is the same on every day."""
    today, now, yesterday = times.today(), times.now(), times.yesterday()
    return t.actions.select(
        "session_id",
        F.datediff(today.cast("date"), yesterday.cast("date")).alias("days_between"),
        (F.substring(now, 1, 10) == today).alias("now_is_today"),
        F.length(now).alias("now_length"),
        F.length(today).alias("today_length"),
        times.parse_time(now).isNotNull().alias("now_parses"),
    ).distinct()


@query("H6")
def empty_keywords(t: Tables) -> DataFrame:
    keyword = F.when(F.col("page_id") == 0, F.lit("")).otherwise(F.col("search_keyword"))
    return t.actions.select(
        "session_id",
        "action_time",
        texts.is_empty(keyword).alias("is_empty"),
        texts.is_not_empty(keyword).alias("is_not_empty"),
    )


@query("H7")
def trimmed_commas(t: Tables) -> DataFrame:
    given = F.concat(F.lit(","), F.col("order_category_ids"), F.when(F.col("page_id") < 5, ",,").otherwise(""))
    return t.actions.select("session_id", "action_time", texts.trim_comma(given).alias("trimmed"))


@query("H8")
def two_digit_texts(t: Tables) -> DataFrame:
    given = F.col("user_id").cast("string")
    return t.actions.select("session_id", "action_time", texts.two_digits(given).alias("padded"))


def _record_texts(t: Tables) -> DataFrame:
    records = _text(sessions.session_records(t.actions))
    return records.select(
        "session_id",
        texts.record(
            sessionId=F.col("session_id"),
            searchKeywords=F.col("search_keywords"),
            clickCategoryIds=F.col("click_category_ids"),
            visitLength=F.col("visit_length"),
            stepLength=F.col("step_length"),
            startTime=F.col("start_time"),
        ).alias("record"),
    )


@query("H9")
def record_fields(t: Tables) -> DataFrame:
    text = F.col("record")
    return _record_texts(t).select(
        "record",
        texts.record_field(text, "sessionId").alias("session"),
        texts.record_field(text, "searchKeywords").alias("keywords"),
        texts.record_field(text, "stepLength").alias("steps"),
        texts.record_field(text, "age").alias("absent"),
    )


@query("H10")
def changed_records(t: Tables) -> DataFrame:
    return _record_texts(t).select(
        "session_id", texts.set_record_field(F.col("record"), "searchKeywords", F.lit("none")).alias("record")
    )


@query("H11")
def rounded_values(t: Tables) -> DataFrame:
    return t.events.select("event_id", "value", numbers.round_half_up(F.col("value"), 1).alias("rounded"))


@query("H12")
def split_ids(t: Tables) -> DataFrame:
    ids = texts.id_list(F.col("pay_category_ids"))
    return t.actions.select("session_id", "action_time", F.explode(ids).alias("category_id"))


@query("H13")
def documents_containing(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", texts.contains(F.col("text"), "the").alias("contains"))


# The five result tables of the full job


@query("job")
def job_session_aggr_stat(t: Tables) -> DataFrame:
    return t.job.session_aggr_stat


@query("job")
def job_session_random_extract(t: Tables) -> DataFrame:
    return t.job.session_random_extract


@query("job")
def job_session_detail(t: Tables) -> DataFrame:
    return t.job.session_detail


@query("job")
def job_top10_category(t: Tables) -> DataFrame:
    return t.job.top10_category


@query("job")
def job_top10_category_session(t: Tables) -> DataFrame:
    return t.job.top10_category_session


# Stored forms of the tables, and what is worked out in passing


def _task_1() -> Column:
    return F.lit(1).cast("bigint").alias("task_id")


@query("D2")
def counts_in_passing(t: Tables) -> DataFrame:
    _, counts = observed.store_with_counts(sessions.session_summary(t.days), "counted-sessions")
    return observed.shares(counts, _task_1())


@query("A10")
def committed_statistics(t: Tables) -> DataFrame:
    return t.committed.read(t.spark, "session_aggr_stat", SESSION_AGGR_STAT)


@query("A10")
def committed_top_sessions(t: Tables) -> DataFrame:
    return t.committed.read(t.spark, "top10_category_session", TOP10_CATEGORY_SESSION, OPTIONS.task_id)


@query("A11")
def task_states(t: Tables) -> DataFrame:
    return t.committed.with_states(t.tasks).select(
        "task_id",
        "task_status",
        (F.col("start_time") <= F.col("finish_time")).alias("has_run"),
    )


@query("B6")
def task_statistics(t: Tables) -> DataFrame:
    return matching.statistics_per_task(t.actions, t.users, t.many_tasks)


@query("D1")
def summary_by_days(t: Tables) -> DataFrame:
    return daily.merged_summary(t.days_stored.sessions(t.spark, START, END))


@query("D2")
def statistics_by_days(t: Tables) -> DataFrame:
    return sessions.session_statistics(daily.merged_summary(t.days_stored.sessions(t.spark)), 1)


@query("D4")
def categories_by_days(t: Tables) -> DataFrame:
    return t.days_stored.categories(t.spark)


@query("D1")
def bucketed_summary(t: Tables) -> DataFrame:
    return sessions.session_summary(t.bucketed_actions)


@query("C2")
def bucketed_selected_actions(t: Tables) -> DataFrame:
    actions = t.bucketed_actions
    days = predicates.date_range(actions, START, END)
    return joins.rows_of(days, sessions.select_sessions(days, t.users, TASK))


@query("A1")
def catalog_actions(t: Tables) -> DataFrame:
    name = f"user_visit_action{_own()}"
    bucketed.catalog_partitions(t.actions, name, scratch_path(t.spark, name))
    stored = tables.catalog_table(t.spark, name, USER_VISIT_ACTION)
    return predicates.date_range(stored, START, END)


@query("A3")
def inferred_columns(t: Tables) -> DataFrame:
    kind = F.concat(F.lit('"kind": "'), F.col("event_type"), F.lit('"'))
    value = F.when(F.col("event_type") == "click", F.concat(F.lit('"value": '), F.col("value")))
    text = F.concat(F.regexp_replace("props", "}", ", "), F.concat_ws(", ", kind, value), F.lit("}"))
    given = t.events.select("event_id", F.when(F.col("event_id") % 50 == 0, "no JSON").otherwise(text).alias("props"))
    typed = files.json_columns(given, "props").drop("props")
    return typed.withColumn("value", F.col("value").cast("double"))


def _odd_lines(t: Tables) -> str:
    """Events as JSON lines, some of which are broken, are no objects or hold a text in place of a number."""
    path, number = scratch_path(t.spark, "odd-lines"), F.col("event_id")
    line = F.format_string('{"event_id": %d, "kind": "%s"}', number, F.col("event_type"))
    odd = (
        F.when(number % 40 == 0, F.concat(F.lit("{"), line))
        .when(number % 40 == 1, F.concat(F.lit("["), number, F.lit("]")))
        .when(number % 40 == 2, F.format_string('{"event_id": "%d th", "kind": "%s"}', number, F.col("event_type")))
        .otherwise(line)
    )
    t.events.select(odd.alias("value")).write.text(path)
    return path


_EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("kind", T.StringType())])


@query("A3")
def accepted_lines(t: Tables) -> DataFrame:
    return files.read_json_checked(t.spark, _odd_lines(t), _EVENT)[0]


@query("A3")
def rejected_lines(t: Tables) -> DataFrame:
    return files.read_json_checked(t.spark, _odd_lines(t), _EVENT)[1]


@query("A4")
def rejected_people(t: Tables) -> DataFrame:
    path, key = scratch_path(t.spark, "odd-people"), F.col("c_custkey")
    age = F.when(key % 9 == 0, "").when(key % 9 == 1, ", unknown").when(key % 9 == 2, ", 1, 2")
    line = F.concat(F.when(key % 9 != 3, F.col("c_name")).otherwise(" "), F.coalesce(age, F.concat(F.lit(", "), key % 60)))
    t.customer.select(line.alias("value")).write.text(path)
    return files.read_people_checked(t.spark, path)[1]


@query("H10")
def records_read_back(t: Tables) -> DataFrame:
    table = _text(sessions.session_records(t.actions))
    written = table.select(texts.record(**{c: F.col(c) for c in table.columns}).alias("record"))
    empty = {"search_keywords": "", "click_category_ids": ""}
    return written.select(texts.typed_record(F.col("record"), table.schema, empty).alias("row")).select("row.*")


@query("A8")
def functions_in_sql(t: Tables) -> DataFrame:
    in_sql.register_functions(t.spark)
    actions, _ = tables.register_views(t.actions, t.users, _own())
    return t.spark.sql(f"""
        SELECT session_id, action_time, date_hour(action_time) AS hour,
            seconds_apart(coalesce(search_keyword, action_time), '2024-01-15 12:00:00') AS seconds,
            is_before(action_time, '2024-01-15 12:00:00') AS before, no_text(search_keyword) AS no_keyword,
            without_commas(concat(',', order_category_ids, ',')) AS ids, two_digits(CAST(page_id AS STRING)) AS page,
            array_join(id_list(order_product_ids), '+') AS products,
            record_field(concat('page=', page_id, '|kind=', action), 'kind') AS kind, share_3(page_id, user_id) AS share
        FROM {actions}""")
