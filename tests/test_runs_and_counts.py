"""Counts taken in passing; result tables that appear together."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from visitloom.operators.observed import shares, store_observed, store_with_counts
from visitloom.operators.sessions import session_counts, session_statistics, session_summary
from visitloom.plans.job import JobOptions, SessionJob
from visitloom.schemas import (
    SESSION_AGGR_STAT, SESSION_DETAIL, SESSION_RANDOM_EXTRACT, TASK, TOP10_CATEGORY, TOP10_CATEGORY_SESSION,
)
from visitloom.sources.runs import RunStore
from visitloom.sources.tasks import Criteria

SCHEMAS = {"session_aggr_stat": SESSION_AGGR_STAT, "session_random_extract": SESSION_RANDOM_EXTRACT,
           "session_detail": SESSION_DETAIL, "top10_category": TOP10_CATEGORY,
           "top10_category_session": TOP10_CATEGORY_SESSION}


@pytest.fixture
def log(make_actions, make_users):
    rows = [
        dict(session_id=f"s{i % 40}", user_id=i % 40 % 7, action_time=f"2024-01-{10 + i % 3:02d} 10:{i % 40:02d}:{i % 60:02d}",
             click_category_id=i % 9 if i % 2 else None, order_category_ids=f"{i % 5},3" if i % 4 == 0 else None)
        for i in range(400)
    ]
    users = [dict(user_id=i, age=20 + i, professional="p", city="c", sex="male") for i in range(7)]
    return make_actions(*rows), make_users(*users)


def test_counts_in_passing(spark, tmp_path, log):
    summary = session_summary(log[0])
    stored, counts = store_with_counts(summary, "sessions")
    assert sorted(stored.collect()) == sorted(summary.collect())
    assert counts.collect() == session_counts(summary).collect()
    assert shares(counts, F.lit(5).cast("bigint").alias("task_id")).collect() == session_statistics(summary, 5).collect()


def test_counts_of_nothing(spark, tmp_path, log):
    for nothing in (session_summary(log[0]).where("session_id = 'none'"), session_summary(log[0].limit(0)), session_summary(log[0]).where("false")):
        stored, counts = store_with_counts(nothing, "sessions")
        row = counts.first()
        assert stored.count() == 0 and set(row.asDict().values()) == {0}
        assert shares(counts).first()["visit_30m"] is None


def test_statistics_need_no_second_read(spark, tmp_path, log):
    """The counts come with the rows that are stored: their frame holds a row and scans nothing."""
    job = SessionJob(*log, Criteria(start_age=20, end_age=30))
    plan = job.session_aggr_stat._jdf.queryExecution().executedPlan().toString()
    assert "Scan" not in plan and "Exchange" not in plan and "Range (0, 1" in plan
    assert job.session_aggr_stat.collect() == session_statistics(job.sessions, 1).collect()


REPEATED = """
import sys
from pathlib import Path
from visitloom.operators.observed import store_observed
from visitloom.session import build_session
from pyspark.sql import functions as F
mark, folder = sys.argv[1:]
spark = build_session("repeated", "local[2,4]", 2, **{"spark.ui.enabled": "false", "spark.checkpoint.dir": folder})
def fails_once(batches):
    for n, batch in enumerate(batches):
        yield batch
    if not Path(mark).exists():
        Path(mark).touch()
        raise RuntimeError("once, after all rows of the task have passed")
counted = spark.range(0, 1000, 1, 4).select("id", F.rand(1).alias("r"))
import visitloom.operators.observed as observed
write = observed.through_storage
observed.through_storage = lambda df, name: write(df.mapInArrow(fails_once, df.schema), name)
stored, found = store_observed(counted, "numbers", F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
print("FOUND", stored.count(), found["n"], found["s"])
"""


def test_a_repeated_task_counts_once(tmp_path):
    """A task fails after it has counted all its rows, and is repeated."""
    mark = tmp_path / "failed"
    done = subprocess.run(
        [sys.executable, "-c", REPEATED, str(mark), str(tmp_path / "scratch")],
        cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=300,
    )
    assert mark.exists() and "FOUND 1000 1000 499500" in done.stdout, done.stderr[-2000:]


def _all(store, spark):
    return {n: sorted(map(str, store.read(spark, n, s, 1).collect())) for n, s in SCHEMAS.items()}


def test_five_tables_appear_together(spark, tmp_path, log):
    store = RunStore(str(tmp_path / "results"))
    assert store.read(spark, "session_detail", SESSION_DETAIL).count() == 0 and store.states(spark).count() == 0

    def run(options, fail_after=None, criteria=Criteria()):
        job = SessionJob(*log, criteria, options)
        with store.attempt(spark, options.task_id) as attempt:
            if fail_after is None:
                job.run(attempt)
                return job
            for n, name in enumerate(list(SCHEMAS)):
                if n == fail_after:
                    raise RuntimeError("lost")
                attempt.replace(getattr(job, name), name, options.task_id)

    first = run(JobOptions(task_id=1, sample_target=9))
    before = _all(store, spark)
    assert all(before.values())
    with pytest.raises(RuntimeError):
        run(JobOptions(task_id=1, sample_target=30), 3, Criteria(start_age=20, end_age=22))
    assert _all(store, spark) == before and len(store.unnamed(spark, 1)) == 3
    second = run(JobOptions(task_id=1, sample_target=30), criteria=Criteria(start_age=20, end_age=22))
    after = _all(store, spark)
    assert after != before
    detail = store.read(spark, "session_detail", SESSION_DETAIL, 1).drop("task_id")
    assert sorted(map(str, detail.collect())) == sorted(map(str, second.session_detail.collect()))
    assert first.session_aggr_stat.first()["session_count"] > second.session_aggr_stat.first()["session_count"]

    run(JobOptions(task_id=2, sample_target=9))
    both = store.read(spark, "session_aggr_stat", SESSION_AGGR_STAT)
    assert sorted(r["task_id"] for r in both.collect()) == [1, 2]
    states = sorted(store.states(spark).collect())
    assert [(r["task_id"], r["number"], r["task_status"]) for r in states] == [(1, 1, "done"), (1, 2, "done"), (2, 1, "done")]
    assert all(r["tables"] == sorted(SCHEMAS) and r["start_time"] <= r["finish_time"] for r in states)
    tasks = spark.createDataFrame([(i, "t", "c", None, None, "session", "new", "{}") for i in (1, 3)], TASK)
    named = {r["task_id"]: r for r in store.with_states(tasks).collect()}
    assert named[1]["task_status"] == "done" and named[1]["finish_time"] == states[1]["finish_time"]
    assert named[3]["task_status"] == "new" and named[3]["finish_time"] is None


def test_two_attempts_at_once(spark, tmp_path):
    store = RunStore(str(tmp_path / "results"))
    df = spark.createDataFrame([(1, 2, 3, 4)], TOP10_CATEGORY)
    with pytest.raises(FileExistsError), store.attempt(spark, 1) as late:
        late.replace(df.limit(0), "top10_category", 1)
        with store.attempt(spark, 1) as early:
            early.replace(df, "top10_category", 1)
    assert store.read(spark, "top10_category", TOP10_CATEGORY).count() == 1
    with pytest.raises(ValueError), store.attempt(spark, 1) as attempt:
        attempt.replace(df, "top10_category", 2)
    folder = tmp_path / "results" / "_runs" / "task_id=1"
    assert [p.name for p in folder.iterdir() if not p.name.startswith(".")] == ["00000001.json"]
    assert json.loads((folder / "00000001.json").read_text())["tables"].keys() == {"top10_category"}
