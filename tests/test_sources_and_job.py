import json

import pytest
from pyspark.sql import functions as F

from visitloom.operators.categories import category_counts, ranked_categories
from visitloom.operators.predicates import any_of, date_range, equals, in_range, one_of
from visitloom.plans.job import JobOptions, SessionJob, category_job, statistics_job
from tests.conftest import final_plan
from visitloom.schemas import (
    PERSON,
    SESSION_AGGR_STAT,
    SESSION_DETAIL,
    TASK,
    TOP10_CATEGORY_SESSION,
    USER_INFO,
    USER_VISIT_ACTION,
)
from visitloom.session import scratch_path, shuffle_partitions, through_storage
from visitloom.sources import files, tables
from visitloom.sources.sinks import TableSink
from visitloom.sources.tasks import Criteria, find_task, load_criteria, with_task_parameters

PARAM = '{"startDate":["2024-01-07"],"endDate":["2024-01-29"],"startAge":[20],"endAge":[30]}'


def test_json_lines(spark, tmp_path):
    (tmp_path / "people.json").write_text(
        '{"name":"Michael"}\n{"name":"Andy", "age":30}\n{"name":"Justin", "age":19}'
    )
    people = files.read_json_lines(spark, str(tmp_path / "people.json"))
    assert people.dtypes == [("age", "bigint"), ("name", "string")]
    assert sorted(people.select("name", F.col("age") + 1).collect(), key=str) == [
        ("Andy", 31),
        ("Justin", 20),
        ("Michael", None),
    ]
    assert people.where(F.col("age") > 21).collect() == [(30, "Andy")]
    typed = tables.typed_by_name(files.read_json_lines(spark, str(tmp_path / "people.json"), PERSON), PERSON)
    assert typed.schema == PERSON and typed.count() == 3


def test_text_lines(spark, tmp_path):
    (tmp_path / "people.txt").write_text("Michael, 29\nAndy, 30\nJustin, 19\nNobody\n")
    people = files.read_people_lines(spark, str(tmp_path / "people.txt"))
    people.createOrReplaceTempView("people")
    young = spark.sql("SELECT concat('Name: ', name) FROM people WHERE age BETWEEN 13 AND 19")
    assert young.collect() == [("Name: Justin",)]
    columns = files.read_text_columns(spark, str(tmp_path / "people.txt"), "name age")
    assert columns.collect() == [("Michael", "29"), ("Andy", "30"), ("Justin", "19"), ("Nobody", None)]


def test_partitioned_actions_are_pruned(spark, make_actions, tmp_path):
    actions = make_actions(
        *({"session_id": "s", "date": f"2024-01-0{d}", "page_id": d, "action_time": "x"} for d in range(1, 6))
    )
    actions.write.partitionBy("date").parquet(str(tmp_path / "actions"))
    read = tables.read_actions(spark, str(tmp_path / "actions"))
    assert read.schema == USER_VISIT_ACTION
    some = date_range(read, "2024-01-02", "2024-01-03")
    assert sorted(r["page_id"] for r in some.collect()) == [2, 3]
    plan = final_plan(some)
    assert "PartitionFilters: [isnotnull(date" in plan and "(date#" in plan.split("PartitionFilters")[1]


def test_catalog_table(spark, make_users):
    make_users({"user_id": 3, "age": 4}).createOrReplaceTempView("stored_users")
    users = tables.catalog_table(spark, "stored_users", USER_INFO)
    assert users.schema == USER_INFO and users.first()["user_id"] == 3


def test_missing_columns_become_null(spark):
    df = spark.createDataFrame([(1, "a")], "x int, name string")
    assert tables.typed_by_name(df, PERSON).collect() == [("a", None)]


def test_dates_are_inclusive_and_open(make_actions):
    actions = make_actions(*({"session_id": "s", "date": f"2024-01-0{d}"} for d in range(1, 6)))
    assert date_range(actions, "2024-01-02", "2024-01-04").count() == 3
    assert date_range(actions, "2024-01-02").count() == 4
    assert date_range(actions, None, "2024-01-02").count() == 2
    assert date_range(actions).count() == 5


def test_predicates(spark):
    df = spark.createDataFrame([(5, "a", ["x", "y"]), (None, None, None)], "n int, s string, l array<string>")

    def flags(condition):
        return [r[0] for r in df.select(condition.alias("v")).collect()]

    n, s, items = F.col("n"), F.col("s"), F.col("l")
    assert flags(in_range(n, 5, 6)) == flags(one_of(s, ["a", "b"])) == flags(any_of(items, ["y", "z"])) == [True, False]
    assert flags(in_range(n, 6, 7)) == flags(equals(s, "b")) == flags(any_of(items, ["z"])) == [False, False]
    for nothing in (in_range(n, 6, None), in_range(n, None, 3), one_of(s, []), any_of(items, ()), equals(s, None)):
        assert flags(nothing) == [True, True]


def test_criteria():
    assert Criteria.from_json(PARAM) == Criteria("2024-01-07", "2024-01-29", 20, 30)
    given = {"professionals": ["a,b", "c"], "cities": [], "sex": [""], "clickCategoryIds": ["1,2", 3]}
    assert Criteria.from_json(json.dumps(given)) == Criteria(professionals=("a", "b", "c"), category_ids=(1, 2, 3))


def test_tasks(spark):
    rows = [(i, f"t{i}", None, None, None, None, None, p) for i, p in enumerate([PARAM, '{"sex":[]}', None])]
    tasks = spark.createDataFrame(rows, TASK)
    assert find_task(tasks, 1).collect()[0]["task_name"] == "t1"
    assert find_task(tasks, 9).collect() == []
    assert load_criteria(tasks, 0) == Criteria.from_json(PARAM) and load_criteria(tasks, 2) == Criteria()
    with pytest.raises(LookupError):
        load_criteria(tasks, 9)
    got = {r["task_id"]: (r["startDate"], r["startAge"], r["sex"]) for r in with_task_parameters(tasks).collect()}
    assert got == {0: ("2024-01-07", "20", None), 1: (None, None, None), 2: (None, None, None)}


def test_dates_bound_the_event_scan(spark):
    events = spark.createDataFrame(
        [(i, f"2024-01-0{i} 23:59:59.5", 1, "view", '{"k": 1}') for i in range(1, 6)],
        "event_id bigint, ts string, user_id bigint, event_type string, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = tables.actions_from_events(events, "2024-01-02", "2024-01-03").select("date", "action_time").collect()
    assert got == [("2024-01-02", "2024-01-02 23:59:59"), ("2024-01-03", "2024-01-03 23:59:59")]
    assert tables.actions_from_events(events, "soon", None).count() == 5


def test_sink_appends(spark, tmp_path):
    sink = TableSink(str(tmp_path), "json")
    df = spark.createDataFrame([("leo", 3), ("tom", 4)], "username string, age int")
    sink.append(df, "user")
    sink.append(df, "user")
    assert sink.read(spark, "user").count() == 4
    by_age = TableSink(str(tmp_path / "parts"))
    by_age.append(df, "user", ["age"])
    assert sorted(p.name for p in (tmp_path / "parts" / "user").glob("age=*")) == ["age=3", "age=4"]


def test_storage(spark):
    df = spark.range(5).select("id", F.lit(None).cast("string").alias("s"))
    stored = through_storage(df, "rows")
    assert stored.schema == df.schema.fromJson(stored.schema.jsonValue()) and stored.count() == 5
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert shuffle_partitions(10**13, 8) == 47684 and shuffle_partitions(1, 8) == 8


TABLES = ("session_aggr_stat", "session_random_extract", "session_detail", "top10_category", "top10_category_session")


@pytest.fixture
def visits(make_actions, make_users):
    rows = [
        {
            "session_id": f"s{i % 30}",
            "user_id": i % 30,
            "action_time": f"2024-01-{8 + i % 30 % 4:02d} {i % 30 % 6:02d}:{i // 30:02d}:00",
            "click_category_id": i % 12 if i % 2 else None,
            "order_category_ids": None if i % 2 else f"{i % 5},{i % 7}",
            "page_id": 1,
        }
        for i in range(300)
    ]
    rows.append({"session_id": "old", "user_id": 1, "action_time": "2023-01-01 00:00:00", "click_category_id": 1})
    users = [{"user_id": i, "age": i, "sex": "male", "city": "c", "professional": "p"} for i in range(40)]
    return make_actions(*rows), make_users(*users)


def test_job_writes_five_tables(spark, visits, tmp_path):
    actions, users = visits
    sink = TableSink(str(tmp_path))
    criteria = Criteria.from_json(PARAM)
    SessionJob(actions, users, criteria, JobOptions(task_id=4, sample_target=40)).run(sink)
    stat = sink.read(spark, "session_aggr_stat")
    assert {f.name for f in stat.schema} == set(SESSION_AGGR_STAT.names)
    assert (stat.first()["task_id"], stat.first()["session_count"]) == (4, 10)
    detail = sink.read(spark, "session_detail")
    assert detail.columns == [*SESSION_DETAIL.names, "task_id"]
    sampled = {r["session_id"] for r in sink.read(spark, "session_random_extract").collect()}
    assert sampled and sampled == {r["session_id"] for r in detail.collect()}
    assert sampled <= {f"s{i}" for i in range(20, 30)}
    top = sink.read(spark, "top10_category").collect()
    chosen = actions.where(F.col("user_id").between(20, 30) & (F.col("date") >= "2024-01-07"))
    assert sorted(tuple(r)[:4] for r in top) == sorted(ranked_categories(category_counts(chosen)).limit(10).collect())
    best = sink.read(spark, "top10_category_session")
    assert best.columns == [*TOP10_CATEGORY_SESSION.names, "task_id"]
    assert {r["category_id"] for r in best.collect()} <= {r["category_id"] for r in top}


def test_smaller_jobs(visits):
    actions, _ = visits
    criteria = Criteria.from_json(PARAM)
    assert statistics_job(actions, criteria, 3).first()["session_count"] == 30
    in_dates = actions.where("date >= '2024-01-07'")
    ranked = category_job(actions, criteria).orderBy("position").drop("position").collect()
    assert ranked == ranked_categories(category_counts(in_dates)).collect()


def test_a_job_can_be_repeated(spark, visits, tmp_path):
    actions, users = visits
    criteria = Criteria.from_json(PARAM)

    class Failing(TableSink):
        def replace(self, df, table, task_id):
            if table == "top10_category":
                raise OSError("no space")
            super().replace(df, table, task_id)

    def counts(sink):
        return {t: sink.read(spark, t).groupBy("task_id").count().orderBy("task_id").collect() for t in TABLES}

    sink = TableSink(str(tmp_path / "once"))
    for task in (4, 5):
        SessionJob(actions, users, criteria, JobOptions(task_id=task, sample_target=40)).run(sink)
    once = counts(sink)
    again = TableSink(str(tmp_path / "again"))
    with pytest.raises(OSError):
        SessionJob(actions, users, criteria, JobOptions(task_id=4, sample_target=40)).run(Failing(again.location))
    for task in (4, 5, 4):
        SessionJob(actions, users, criteria, JobOptions(task_id=task, sample_target=40)).run(again)
    assert counts(again) == once


def test_bad_values_in_events(spark):
    events = spark.createDataFrame(
        [(1, "2024-01-02 00:00:00", 1, "click", '{"k":"a"}'), (2, "2024-01-02 00:00:00", 1, "click", '{"k":5}')],
        "event_id long, ts string, user_id long, event_type string, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = tables.actions_from_events(events).select("click_category_id").collect()
    assert sorted(r[0] or 0 for r in got) == [0, 5]
