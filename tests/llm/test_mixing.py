"""Source mix against a plain program: targets, rates and copies; small cases and plans."""

import math
from collections import Counter, defaultdict
from pathlib import Path

import pytest

from visitloom.llm.mixing import mix_plan, mixed, token_targets
from visitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain_targets(sizes, weights=(3, 1, 2), growth=1.5, most=2):
    """{source: target}: the share of each source, full ones first."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = growth * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in names}
        full |= over


def plain_rates(sizes, target, most=2):
    """Rates min(most, exp(t * size / mean)) of one source, by bisection."""
    words = [s for s in sizes if s]
    if not words or target >= most * sum(words):
        return [1.0 if s == 0 else float(most) for s in sizes]
    mean = sum(words) / len(words)
    rate = lambda t: [math.exp(min(t * s / mean, math.log(most))) for s in sizes]
    low, high = -1e4, 1e4
    for _ in range(200):
        t = (low + high) / 2
        low, high = (low, t) if sum(r * s for r, s in zip(rate(t), sizes)) > target else (t, high)
    return rate(low)


def check(rows, source_of, near, **options):
    sizes = defaultdict(int)
    for r in rows:
        sizes[source_of[r["doc_id"]]] += r["size"]
    targets = plain_targets(sizes, **options)
    by_source = defaultdict(list)
    for r in rows:
        by_source[source_of[r["doc_id"]]].append(r)
    for source, own in by_source.items():
        assert all(r["source_size"] == sizes[source] for r in own)
        assert all(r["target"] == pytest.approx(targets[source], rel=1e-12) for r in own)
        expected = plain_rates([r["size"] for r in own], targets[source], options.get("most", 2))
        for r, rate in zip(own, expected):
            assert r["rate"] == pytest.approx(rate, rel=1e-3, abs=0.01)
            assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= options.get("most", 2)
        assert abs(sum(r["taken"] for r in own) - targets[source]) <= near(targets[source])


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_query_against_a_plain_program(spark):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    df = QUERIES["op11_source_mix"](spark, FOLDER)
    rows = df.collect()
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d["doc_id"], len((d["text"] or "").encode().split())) for d in given)
    check(rows, {d["doc_id"]: d["source"] for d in given}, lambda t: 0.002 * t)
    again = QUERIES["op11_source_mix"](spark, FOLDER)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again.collect()))
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def frame(spark, rows):
    """Documents of (doc_id, words, source), with columns whose names the operator uses itself."""
    filled = [(i, None if n is None else "w " * n, s, 0, "k", 1.0, 5, 7) for i, n, s in rows]
    return spark.createDataFrame(filled, "doc_id long, text string, source string, size int, KEY string, rate double, m int, mix_id int")


def test_small_cases(spark):
    rows = [(1, None, "a"), (2, 0, "a"), (3, 10, "a"), (3, 10, "a"), (None, 4, "b"), (5, 30, None), (6, 3, None), (7, 8, "é"), (8, 5, "z"), (9, None, "empty")]
    got = mix_plan(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, n or 0) for i, n, _ in rows)
    check(got, {i: s for i, _, s in rows}, lambda t: 10)
    assert all(r["taken"] == 0 for r in got if not r["size"])
    assert mix_plan(frame(spark, [])).count() == 0
    only = mix_plan(frame(spark, [(1, None, None), (2, 0, "a")])).collect()
    assert {(r["target"], r["taken"]) for r in only} == {(0.0, 0)}


def test_a_source_with_most_rows_and_equal_rows(spark):
    """A third of all rows are one row, and most are of one size."""
    rows = [(1, 50, "hot")] * 2500 + [(10 + i, 50, "hot") for i in range(2500)] + [(9000 + i, 1 + i % 90, f"s{i % 5}") for i in range(1500)]
    df = frame(spark, rows)
    got = mix_plan(df).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in rows)
    check(got, {i: s for i, _, s in rows}, lambda t: 50)
    taken = mixed(df)
    assert taken.columns == df.columns
    by_id = Counter()
    for r in got:
        by_id[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in taken.collect()) == +by_id


def test_other_weights(spark):
    rows = [(i, 1 + (i * 37) % 200, f"s{i % 4}") for i in range(800)]
    options = {"weights": (1, 5), "growth": 0.4, "most": 3}
    check(mix_plan(frame(spark, rows), **options).collect(), {i: s for i, _, s in rows}, lambda t: 2, **options)
    with pytest.raises(ValueError):
        mix_plan(frame(spark, rows), growth=3)


def test_targets_of_many_full_sources(spark):
    sizes = {f"s{i:03d}": 1 + i * i * (i % 7) for i in range(300)} | {"big": 10**7}
    df = spark.createDataFrame([("0" + s, n) for s, n in sizes.items()], "key string, source_size long")
    got = {r["key"][1:]: r["target"] for r in token_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes), rel=1e-12)
    assert sum(got.values()) == pytest.approx(1.5 * sum(sizes.values()))
