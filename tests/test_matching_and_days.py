"""All tasks in one scan against one task at a time; states by day against all days at once."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan
from visitloom.operators.categories import category_counts
from visitloom.operators.daily import DayStore, merged_summary, merged_values
from visitloom.operators.matching import (
    _ancestors,
    _blocks,
    _with_asks,
    profile_cells,
    session_profiles,
    session_spans,
    statistics_per_task,
    task_criteria,
)
from visitloom.operators.predicates import date_range
from visitloom.operators.sessions import select_sessions, session_records, session_statistics, session_summary
from visitloom.sources.tasks import Criteria

DAYS = [f"2024-01-{d:02d}" for d in range(8, 16)]


@pytest.fixture(scope="module")
def log():
    """Actions and users as dicts: sessions of one and of several days, NULL users, sessions and values."""
    rng, actions = random.Random(7), []
    for s in range(60):
        start, days = rng.randrange(8), rng.choice([1, 1, 1, 2, 3])
        user = rng.randrange(12) if s % 9 else None
        for _ in range(rng.randrange(1, 12)):
            day = DAYS[min(7, start + rng.randrange(days))]
            kind = rng.randrange(3)
            actions.append(
                dict(
                    date=day, user_id=user, session_id=f"s{s}" if s else None,
                    action_time=f"{day} {rng.choice(['10', '23', '00'])}:{rng.randrange(60):02d}:{rng.randrange(60):02d}",
                    search_keyword=f"kw{rng.randrange(5)}" if kind == 0 else None,
                    click_category_id=rng.randrange(8) if kind == 1 else None,
                    order_category_ids=f"{rng.randrange(8)},x,3" if kind == 2 else None,
                )
            )
    users = [
        dict(user_id=i, age=None if i == 5 else 15 + 4 * i, professional=f"p{i % 3}", city=f"c{i % 4}" if i % 5 else None,
             sex=("male", "female", None)[i % 3])
        for i in range(11)
    ]
    return actions, users


def parameters(rng):
    p = {}
    if rng.random() < 0.6:
        p["startDate"] = [rng.choice(DAYS)]
    if rng.random() < 0.6:
        p["endDate"] = [rng.choice(DAYS)]
    if rng.random() < 0.4:
        low = rng.randrange(10, 50)
        p |= {"startAge": [low], "endAge": [low + rng.randrange(-3, 30)]}
    if rng.random() < 0.2:
        p["startAge"] = [20]
    for name, values, share in (("professionals", "p0 p1 p2", 0.3), ("cities", "c0 c1 c2 c3", 0.3), ("sex", "male female", 0.3),
                                ("searchKeywords", "kw0 kw1 kw2 kw9", 0.3), ("clickCategoryIds", "0 1 2 3", 0.3)):
        if rng.random() < share:
            chosen = rng.sample(values.split(), rng.randrange(1, 3) if name != "sex" else 1)
            p[name] = [",".join(chosen)] if rng.random() < 0.5 else chosen
    if rng.random() < 0.1:
        p["cities"] = []
    return p


def test_statistics_per_task(spark, make_actions, make_users, log):
    actions, users = make_actions(*log[0]), make_users(*log[1])
    rng = random.Random(3)
    given = [(i, json.dumps(parameters(rng))) for i in range(40)] + [(100, "{}"), (101, None), (102, '{"startDate":["2030-01-01"]}'), (100, "{}")]
    tasks = spark.createDataFrame(given, "task_id long, task_param string")
    df = statistics_per_task(actions, users, tasks)
    plan = final_plan(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = df.collect()
    assert sorted(r["task_id"] for r in got) == sorted(i for i, _ in given)
    several = 0
    for task_id, param in set(given):
        c = Criteria.from_json(param or "{}")
        one = session_statistics(select_sessions(date_range(actions, c.start_date, c.end_date), users, c), task_id).first()
        assert all(r == one for r in got if r["task_id"] == task_id), (param, one)
        several += one["session_count"] > 0
    assert several > 15


def test_odd_criteria(spark, make_actions, make_users, log):
    """Ranges and values that no block or list holds, and several lists at once."""
    users = [dict(u, age=(-3, 255, 256, 300, 40, None)[u["user_id"] % 6]) for u in log[1]]
    actions, users = make_actions(*log[0]), make_users(*users)
    dates = ([], ["2024-01-1"], ["2024-01-09"], ["0000"], ["9999"])
    odd = [{"startDate": a, "endDate": b} for a in dates for b in dates]
    odd += [{"startAge": [a], "endAge": [b]} for a, b in ((-9, 400), (-5, 0), (250, 256), (256, 300), (40, 40), (41, 39))]
    odd += [{"clickCategoryIds": ["x"]}, {"clickCategoryIds": ["x", "1,2,3,4,5"], "searchKeywords": ["kw0,kw1", "kw2", "kw3"]}]
    odd += [dict(odd[-1], professionals=["p0,p1,p2,p0"], cities=["c0,c1,c2"], startAge=[0], endAge=[256], startDate=[DAYS[2]])]
    tasks = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(odd)], "task_id long, task_param string")
    got = {r["task_id"]: r for r in statistics_per_task(actions, users, tasks).collect()}
    for i, p in enumerate(odd):
        if p.get("clickCategoryIds") == ["x"]:
            assert got[i]["session_count"] == 0 and got[i]["step_60"] is None
            continue
        c = Criteria.from_json(json.dumps(p).replace('"x", ', ""))
        one = session_statistics(select_sessions(date_range(actions, c.start_date, c.end_date), users, c), i).first()
        assert got[i] == one, p
    assert sum(r["session_count"] > 0 for r in got.values()) > 10


def test_criteria_meet_cells_not_sessions(spark, make_actions, make_users):
    """How many cells there are depends on the values that are asked for, not on the sessions or on what else differs in them."""
    rows = [
        dict(action_time=f"2024-01-{8 + s % 6:02d} 10:00:00", user_id=s % 40, session_id=f"s{s}", click_category_id=s % 13)
        for s in range(600)
    ]
    users = [dict(user_id=i, age=20 + i % 4, professional=f"p{i % 5}", city=f"c{i % 8}", sex=("male", "female")[i % 2]) for i in range(40)]
    asked = [{"startAge": [a], "endAge": [a + 1]} for a in range(19, 24)] + [{"clickCategoryIds": [str(c)]} for c in range(13)] + [{}]
    tasks = spark.createDataFrame([(i, json.dumps(p)) for i, p in enumerate(asked)], "task_id long, task_param string")
    criteria = _with_asks(task_criteria(tasks))
    asks = sorted({r["asks"] for r in criteria.select("asks").collect()})
    profiles = session_profiles(session_spans(make_actions(*rows), criteria), make_users(*users))
    cells = profile_cells(profiles, asks)
    assert profiles.count() > 500 and cells.count() == 1 + 4 + 13
    counts = {r["asks"]: r["n"] for r in cells.groupBy("asks").agg(F.sum("session_count").alias("n")).collect()}
    assert list(counts.values()) == [600] * 3


def test_no_tasks_and_no_actions(spark, make_actions, make_users, log):
    tasks = spark.createDataFrame([(1, "{}")], "task_id long, task_param string")
    assert statistics_per_task(make_actions(*log[0]), make_users(*log[1]), tasks.limit(0)).count() == 0
    row = statistics_per_task(make_actions(), make_users(*log[1]), tasks).first()
    assert row["session_count"] == 0 and row["step_60"] is None


def test_blocks_of_a_range(spark):
    """Each number of a range lies in one of its blocks, others in none; there are few."""
    ranges = [(a, b) for a in range(0, 40, 3) for b in range(a, 64, 5)] + [(0, 63), (5, 5), (9, 4), (0, 62), (1, 63), (0, 90)]
    df = spark.createDataFrame(ranges, "low int, high int")
    got = df.select("low", "high", F.expr(f"{_blocks('low', 'high', 6)} AS blocks")).collect()
    numbers = spark.range(64).select(F.expr("int(id) AS n")).select("n", F.expr(f"{_ancestors('n', 6)} AS over")).collect()
    for r in got:
        assert len(set(r["blocks"])) == len(r["blocks"]) <= 12
        for n in numbers:
            assert len(set(n["over"]) & set(r["blocks"])) == (r["low"] <= n["n"] <= r["high"]), (r, n)


def test_states_by_day(spark, make_actions, log, tmp_path):
    everything = make_actions(*log[0])
    path = str(tmp_path / "log")
    everything.write.partitionBy("date").parquet(path)
    actions = spark.read.schema(everything.schema).parquet(path)
    store = DayStore(str(tmp_path / "states"))
    store.put_all(actions.where(F.col("date") < DAYS[4]))
    for day in DAYS[4:]:
        store.put(actions, day)

    def same(start, end):
        days = date_range(actions, start, end)
        states = store.sessions(spark, start, end)
        assert sorted(map(str, merged_summary(states).collect())) == sorted(map(str, session_summary(days).collect()))
        lists = session_records(days).select("session_id", "search_keywords", F.expr("transform(click_category_ids, v -> bigint(v)) AS click_category_ids"))
        lists = lists.withColumn("click_category_ids", F.array_sort("click_category_ids"))
        assert sorted(map(str, merged_values(states).collect())) == sorted(map(str, lists.collect()))
        assert sorted(store.categories(spark, start, end).collect()) == sorted(category_counts(days).collect())

    same(None, None)
    same(DAYS[1], DAYS[5])
    # A day that comes again, with more actions.
    more = actions.union(actions.where(F.col("date") == DAYS[2]).withColumn("session_id", F.lit("again")).select(actions.columns))
    store.put(more, DAYS[2])
    assert merged_summary(store.sessions(spark)).where("session_id = 'again'").count() == 1
    store.put(actions, DAYS[2])
    same(None, None)
    with pytest.raises(ValueError):
        store.put(actions, "yesterday")


def test_a_day_is_read_alone(spark, make_actions, log, tmp_path):
    path = str(tmp_path / "log")
    make_actions(*log[0]).write.partitionBy("date").parquet(path)
    actions = spark.read.schema(make_actions().schema).parquet(path)
    from visitloom.operators.daily import session_states

    plan = final_plan(session_states(date_range(actions, DAYS[3], DAYS[3])))
    assert f"(date#" in plan and "PartitionFilters: [isnotnull(date" in plan and DAYS[3] in plan
    store = DayStore(str(tmp_path / "states"))
    store.put_all(actions)
    merged = final_plan(merged_summary(store.sessions(spark, DAYS[2], DAYS[3])))
    assert "PartitionFilters: [isnotnull(date" in merged and "search_keywords" not in merged.split("ReadSchema")[1]
