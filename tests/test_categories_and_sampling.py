from collections import Counter

import pytest
from pyspark.sql import functions as F

from visitloom.operators import categories, sampling
from visitloom.operators.sessions import session_summary


def _time(i):
    return f"2024-01-{10 + i % 3:02d} {i % 5:02d}:{i % 60:02d}:00"


@pytest.fixture
def ranked_actions(make_actions):
    """Category counts 4: 0/0/18, 1: 5/18/0, 3: 0/18/18, 5: 0/0/18, 2: 7/18/0."""
    rows = [{"session_id": f"s{i}", "action_time": _time(i), "order_category_ids": "1,2,3"} for i in range(18)]
    rows += [{"session_id": f"s{i}", "action_time": _time(i), "pay_category_ids": "3,4,5"} for i in range(18)]
    rows += [{"session_id": f"s{i % 2}", "action_time": _time(i), "click_category_id": 1} for i in range(5)]
    rows += [{"session_id": f"s{i % 3}", "action_time": _time(i), "click_category_id": 2} for i in range(7)]
    return make_actions(*rows)


def test_category_ranking(ranked_actions):
    counts = categories.category_counts(ranked_actions)
    ranked = [tuple(r) for r in categories.ranked_categories(counts).collect()]
    assert ranked == [(2, 7, 18, 0), (1, 5, 18, 0), (3, 0, 18, 18), (4, 0, 0, 18), (5, 0, 0, 18)]
    assert [r[0] for r in categories.top_categories(counts, 2).collect()] == [2, 1]


def test_one_pass_counts_equal_joined_counts(ranked_actions):
    one_pass = sorted(map(tuple, categories.category_counts(ranked_actions).collect()))
    assert one_pass == sorted(map(tuple, categories.joined_category_counts(ranked_actions).collect()))
    assert sorted(r[0] for r in categories.category_universe(ranked_actions).collect()) == [1, 2, 3, 4, 5]


def test_an_id_counts_as_often_as_listed(make_actions):
    actions = make_actions({"session_id": "a", "action_time": _time(0), "order_category_ids": "7,7,x,"})
    assert categories.order_counts(actions).collect() == [(7, 2)]


def test_top_sessions(ranked_actions):
    top = categories.top_categories(categories.category_counts(ranked_actions), 2)
    got = sorted(map(tuple, categories.top_sessions(ranked_actions, top, 2).collect()))
    assert got == [(1, "s0", 3), (1, "s1", 2), (2, "s0", 3), (2, "s1", 2)]


def test_ties_are_broken_by_session(make_actions):
    actions = make_actions(
        *({"session_id": f"s{i:02d}", "action_time": _time(i), "click_category_id": 1} for i in range(15))
    )
    top = categories.top_categories(categories.category_counts(actions))
    got = sorted(r["session_id"] for r in categories.top_sessions(actions, top).collect())
    assert got == [f"s{i:02d}" for i in range(10)]


def test_long_tops(make_actions):
    actions = make_actions(
        *({"session_id": f"s{i % 150}", "action_time": _time(i), "click_category_id": i % 2} for i in range(500))
    )
    top = categories.top_categories(categories.category_counts(actions))
    rows = sorted(map(tuple, categories.top_sessions(actions, top, n=40).collect()))
    counts = Counter((i % 2, f"s{i % 150}") for i in range(500))
    expected = [
        (c, s, n)
        for c in (0, 1)
        for n, s in sorted((-n, s) for (k, s), n in counts.items() if k == c)[:40]
        for n in [-n]
    ]
    assert rows == sorted(expected)


def test_one_plan_for_any_length(make_actions):
    actions = make_actions({"session_id": "a", "action_time": _time(1), "click_category_id": 1})
    top = categories.top_categories(categories.category_counts(actions))

    def shape(n):
        plan = categories.top_sessions(actions, top, n)._jdf.queryExecution().analyzed().toString()
        return [line.strip(" +-:").split()[0] for line in plan.splitlines()]

    assert shape(5) == shape(5000)


def test_no_broadcast_by_argument(spark, make_actions):
    actions = make_actions({"session_id": "a", "action_time": _time(1), "click_category_id": 1})
    many = spark.range(10_000_000).select(F.col("id").alias("category_id"))
    sample = spark.range(10_000_000).select(F.col("id").cast("string").alias("session_id"))
    for df in (categories.clicks_in_categories(actions, many), sampling.sampled_details(actions, sample)):
        assert "strategy=broadcast" not in df._jdf.queryExecution().analyzed().toString().lower()
        assert "hint" not in df._jdf.queryExecution().logical().toString().lower()


@pytest.fixture
def many_sessions(make_actions):
    """Most sessions start in one hour of one day."""
    rows = [{"session_id": f"h{i}", "action_time": "2024-01-10 09:00:00"} for i in range(300)]
    rows += [{"session_id": f"s{i}", "action_time": _time(i)} for i in range(200)]
    return session_summary(make_actions(*rows))


@pytest.mark.parametrize("target", [1, 10, 100, 5000])
def test_sample_matches_plain_calculation(many_sessions, target):
    starts = [(r["session_id"], r["start_time"][:10], r["start_time"][11:13]) for r in many_sessions.collect()]
    import hashlib

    hours = Counter((d, h) for _, d, h in starts)
    days = Counter(d for _, d, _ in starts)
    quota = target // len(days)
    expected = set()
    for (day, hour), n in hours.items():
        size = min(n, int(n / days[day] * quota))
        inside = sorted(
            (hashlib.md5(f"42{s}".encode()).hexdigest(), s) for s, d, h in starts if (d, h) == (day, hour)
        )
        expected |= {s for _, s in inside[:size]}
    got = [r["session_id"] for r in sampling.sample_sessions(many_sessions, target).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected


def test_sample_is_the_same_under_other_partitionings(many_sessions):
    a = set(map(tuple, sampling.sample_sessions(many_sessions.repartition(1), 60).collect()))
    b = set(map(tuple, sampling.sample_sessions(many_sessions.repartition(17), 60).collect()))
    assert a == b and a
    assert a != set(map(tuple, sampling.sample_sessions(many_sessions, 60, seed=1).collect()))


def test_sample_of_nothing(many_sessions):
    assert sampling.sample_sessions(many_sessions.where("step_length > 5")).collect() == []


def test_quota(many_sessions):
    rows = sampling.hourly_quota(sampling.sessions_per_hour(many_sessions), 100).collect()
    assert {r["days"] for r in rows} == {3} and {r["day_quota"] for r in rows} == {33}
    assert all(r["sample_size"] <= r["sessions"] for r in rows)


def test_sampled_tables(ranked_actions):
    sample = session_summary(ranked_actions).where("session_id = 's1'").select("session_id")
    details = sampling.sampled_details(ranked_actions, sample)
    assert details.count() == ranked_actions.where(F.col("session_id") == "s1").count()
    assert details.columns[0:4] == ["user_id", "session_id", "page_id", "action_time"]
    (row,) = sampling.sampled_records(details).collect()
    assert (row["session_id"], row["click_category_ids"], row["search_keywords"]) == ("s1", "1,2", "")
