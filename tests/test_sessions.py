
from collections import defaultdict

import pytest

from visitloom.operators.predicates import date_range
from visitloom.operators.sessions import (
    session_values,
    select_sessions,
    session_counts,
    session_records,
    session_statistics,
    session_summary,
    wide_session_records,
    with_users,
)
from visitloom.schemas import STEP_BUCKETS, VISIT_BUCKETS
from visitloom.sources.tasks import Criteria

NAMES = [n for n, _, _ in VISIT_BUCKETS + STEP_BUCKETS]

# Seconds or steps at both ends of every bucket, and the bucket they belong to.
VISIT_EDGES = {
    0: "visit_0s", 1: "visit_1s_3s", 3: "visit_1s_3s", 4: "visit_4s_6s", 6: "visit_4s_6s", 7: "visit_7s_9s",
    9: "visit_7s_9s", 10: "visit_10s_30s", 30: "visit_10s_30s", 31: "visit_30s_60s", 60: "visit_30s_60s",
    61: "visit_1m_3m", 180: "visit_1m_3m", 181: "visit_3m_10m", 600: "visit_3m_10m", 601: "visit_10m_30m",
    1800: "visit_10m_30m", 1801: "visit_30m",
}
STEP_EDGES = {
    1: "step_1_3", 3: "step_1_3", 4: "step_4_6", 6: "step_4_6", 7: "step_7_9", 9: "step_7_9", 10: "step_10_30",
    30: "step_10_30", 31: "step_30_60", 60: "step_30_60", 61: "step_60",
}


def at(seconds):
    return f"2024-01-10 {10 + seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}"


@pytest.mark.parametrize("seconds,bucket", VISIT_EDGES.items())
def test_visit_bucket_edges(make_actions, seconds, bucket):
    actions = make_actions(
        {"session_id": "s", "action_time": at(0)}, {"session_id": "s", "action_time": at(seconds)}
    )
    counts = session_counts(session_summary(actions)).first().asDict()
    assert [n for n in NAMES[:10] if counts[n]] == [bucket]


def test_step_bucket_edges(make_actions):
    rows = [{"session_id": f"s{n}", "action_time": at(0)} for n in STEP_EDGES for _ in range(n)]
    counts = session_counts(session_summary(make_actions(*rows))).first()
    expected = defaultdict(int)
    for bucket in STEP_EDGES.values():
        expected[bucket] += 1
    assert {n: counts[n] for n in NAMES[10:]} == {n: expected[n] for n in NAMES[10:]}
    assert sum(counts[n] for n in NAMES[10:]) == sum(counts[n] for n in NAMES[:10]) == counts["session_count"]


def test_summary(make_actions):
    actions = make_actions(
        {"session_id": "a", "user_id": 7, "action_time": at(100)},
        {"session_id": "a", "user_id": 7, "action_time": at(40)},
        {"session_id": "a", "user_id": None, "action_time": "not a time"},
    )
    assert session_summary(actions).collect() == [("a", 7, at(40), at(100), 60, 3)]


def test_ratios_are_exact_half_up(make_actions):
    # 1 of 16 is 0.0625, which rounds up to 0.063.
    rows = [{"session_id": f"s{i}", "action_time": at(0)} for i in range(15)]
    rows += [{"session_id": "long", "action_time": at(0)}, {"session_id": "long", "action_time": at(5)}]
    stat = session_statistics(session_summary(make_actions(*rows)), 9).first()
    assert (stat["task_id"], stat["session_count"]) == (9, 16)
    assert (stat["visit_0s"], stat["visit_4s_6s"], stat["step_1_3"]) == (0.938, 0.063, 1.0)


def test_statistics_of_nothing(make_actions):
    stat = session_statistics(session_summary(date_range(make_actions({"session_id": "s"}), "2030-01-01")), 1).first()
    assert stat["session_count"] == 0
    assert all(stat[n] is None for n in NAMES)


def test_lists_are_exact_sets(make_actions):
    # 1 is a part of the text 12, and must still be listed.
    actions = make_actions(
        {"session_id": "a", "action_time": at(0), "click_category_id": 12},
        {"session_id": "a", "action_time": at(1), "click_category_id": 1},
        {"session_id": "a", "action_time": at(1), "click_category_id": 12},
        {"session_id": "a", "action_time": at(2), "search_keyword": "cakes"},
        {"session_id": "a", "action_time": at(3), "search_keyword": "cake"},
    )
    row = session_records(actions).first()
    assert (row["click_category_ids"], row["search_keywords"]) == (["1", "12"], ["cake", "cakes"])


def test_wide_lists_split_before_dedupe(make_actions):
    actions = make_actions(
        {"session_id": "a", "action_time": at(0), "order_category_ids": "3,12,1", "page_id": 4, "action": "order"},
        {"session_id": "a", "action_time": at(1), "order_category_ids": "1,2,", "page_id": 4, "action": "order"},
        {"session_id": "a", "action_time": at(2), "pay_product_ids": "10,9", "page_id": 30, "action": "pay"},
    )
    row = wide_session_records(actions).first()
    assert row["order_category_ids"] == ["1", "2", "3", "12"]
    assert row["pay_product_ids"] == ["9", "10"]
    assert (row["page_ids"], row["actions"], row["search_keywords"]) == (["4", "30"], ["order", "pay"], [])


@pytest.fixture(scope="module")
def hot_session(spark):
    """100,001 actions of one session with 5 keywords and 7 categories, and another session."""
    from pyspark.sql import functions as F

    from visitloom.schemas import USER_VISIT_ACTION
    from visitloom.sources.tables import typed_by_name

    n = F.col("id")
    hot = n < 100_001
    rows = spark.range(100_011).select(
        F.when(hot, "hot").otherwise("small").alias("session_id"),
        F.lit("2024-01-10").alias("date"),
        F.lit(1).alias("user_id"),
        F.lit("2024-01-10 08:00:00").alias("action_time"),
        F.concat(F.lit("kw"), n % 5).alias("search_keyword"),
        (n % 7).alias("click_category_id"),
    )
    return typed_by_name(rows, USER_VISIT_ACTION)


@pytest.mark.parametrize("records", [session_records, wide_session_records])
def test_one_row_for_a_session_of_any_size(hot_session, records):
    rows = {r["session_id"]: r for r in records(hot_session).collect()}
    assert set(rows) == {"hot", "small"}
    assert rows["hot"]["search_keywords"] == [f"kw{i}" for i in range(5)]
    assert rows["hot"]["click_category_ids"] == [str(i) for i in range(7)]
    assert rows["hot"]["step_length"] == 100_001


def test_values_as_rows(hot_session):
    values = session_values(hot_session).where("session_id = 'hot'").collect()
    assert sorted((r["list"], r["value"]) for r in values) == sorted(
        [("search_keywords", f"kw{i}") for i in range(5)] + [("click_category_ids", str(i)) for i in range(7)]
    )


def test_values_are_those_of_the_records(make_actions):
    actions = make_actions(
        {"session_id": "a", "action_time": at(0), "order_category_ids": "3,12,1", "page_id": 4, "action": "order"},
        {"session_id": "a", "action_time": at(1), "order_category_ids": "1,2,", "page_id": 4, "action": "order"},
        {"session_id": None, "action_time": at(2), "search_keyword": "x"},
    )
    listed = {
        (r["session_id"], name, v)
        for r in wide_session_records(actions).collect()
        for name, values in r.asDict().items()
        if isinstance(values, list)
        for v in values
    }
    assert {tuple(r) for r in session_values(actions).collect()} == listed


def test_a_session_without_values_is_kept(make_actions):
    actions = make_actions(*({"session_id": "a", "action_time": at(i)} for i in range(20)))
    assert session_records(actions).collect() == [("a", 1, at(0), at(19), 19, 20, [], [])]


def _two_users(make_users):
    return make_users(
        {"user_id": 1, "age": 25, "professional": "cook", "city": "Ulm", "sex": "male"},
        {"user_id": 2, "age": None, "professional": "smith", "city": None, "sex": "female"},
    )


@pytest.fixture
def clicks(make_actions):
    return make_actions(
        {"session_id": "a", "user_id": 1, "action_time": at(0), "search_keyword": "tea"},
        {"session_id": "a", "user_id": 1, "action_time": at(1), "click_category_id": 12},
        {"session_id": "b", "user_id": 2, "action_time": at(0), "click_category_id": 1},
        {"session_id": "c", "user_id": 3, "action_time": at(0), "click_category_id": 1},
    )


def test_unknown_users_are_dropped(clicks, make_users):
    rows = with_users(session_summary(clicks), _two_users(make_users)).collect()
    assert {r["session_id"]: r["city"] for r in rows} == {"a": "Ulm", "b": None}


@pytest.mark.parametrize(
    "criteria,expected",
    [
        (Criteria(), "ab"),
        (Criteria(start_age=25, end_age=25), "a"),
        (Criteria(start_age=90), "ab"),
        (Criteria(professionals=("smith", "clerk")), "b"),
        (Criteria(cities=("Ulm",)), "a"),
        (Criteria(sex="female"), "b"),
        (Criteria(keywords=("coffee", "tea")), "a"),
        (Criteria(category_ids=(1, 2)), "b"),
        (Criteria(category_ids=(12,), keywords=("tea",), sex="male"), "a"),
        (Criteria(category_ids=(12,), keywords=("coffee",)), ""),
    ],
)
def test_selection(clicks, make_users, criteria, expected):
    rows = select_sessions(clicks, _two_users(make_users), criteria).collect()
    assert sorted(r["session_id"] for r in rows) == list(expected)
