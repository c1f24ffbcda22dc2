"""Every registered query: its plan, and its rows against its SQL in another engine."""

from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.conftest import final_plan
from visitloom.plans.oracle import ORACLE as SQL
from visitloom.plans.registry import QUERIES, SURVEY_ID

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_contract():
    assert set(QUERIES) == set(SURVEY_ID) <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
    assert set(SQL) == set(QUERIES)


@pytest.fixture(scope="module")
def other_engine():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal_sql(spark, other_engine, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    plan = final_plan(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in plan, plan
    got = Counter(map(tuple, df.select(*(f"`{c}`" for c in columns)).collect()))
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = other_engine.execute(f"SELECT {listed} FROM ({SQL[name]}) q").fetchall()
    assert got == Counter(expected)


@needs_data
def test_summary_plan(spark):
    """Dates reach the scan, unused columns are not read, one hash aggregation, one shuffle."""
    plan = final_plan(QUERIES["session_summary"](spark, FOLDER))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    dated = final_plan(QUERIES["session_statistics"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts," in dated and "LessThan(ts," in dated
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate") == 2
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def scanned_rows_of_executed(df):
    """Rows that the scans of a query gave, by the counters of its executed plan; after collect()."""
    executed = df._jdf.queryExecution().executedPlan()
    total, open_ = 0, [executed]
    while open_:
        node = open_.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            open_.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            open_.append(node.plan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return total


@needs_data
@pytest.mark.parametrize("name", ["session_records", "wide_session_records", "session_values", "session_summary"])
def test_sessions_read_the_events_once(spark, name):
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    assert scanned_rows_of_executed(df) == spark.read.parquet(f"{FOLDER}/events.parquet").count()


@needs_data
def test_category_counts_plan(spark):
    plan = final_plan(QUERIES["category_counts"](spark, FOLDER))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert "TakeOrderedAndProject" in final_plan(QUERIES["top_categories"](spark, FOLDER))


@needs_data
def test_groups_are_cut_before_the_shuffle(spark):
    assert "row_number(), 10, Partial" in final_plan(QUERIES["top_sessions"](spark, FOLDER))


@needs_data
def test_sample_reads_once_and_cuts_hours_before_the_shuffle(spark):
    plan = final_plan(QUERIES["sampled_sessions"](spark, FOLDER))
    assert plan.count("FileScan") == 1
    sorted_part = plan[plan.index("Sort [date") :]
    assert sorted_part.index("last_slice") < sorted_part.index("HashAggregate(keys=[session_id")


@needs_data
def test_user_criteria_reach_the_user_scan(spark):
    plan = final_plan(QUERIES["selected_sessions"](spark, FOLDER))
    assert "c_mktsegment" in plan.split("PushedFilters:")[1] or "In(c_mktsegment" in plan
