"""Whitening against plain numpy on whole tables, and small cases."""

from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from visitloom.llm import whitening
from visitloom.llm.queries import QUERIES
from visitloom.llm.whitening import whiten

FOLDER = "/root/testdata/sf0.001"


def plain(rows, most=16, counted=False):
    """{(vec_id, component): (deviation, whitened without its sign, explained)} and n."""
    x = np.array([np.floor(64 * np.array(e, np.float64)) + 1_000_000 for _, e in rows], np.int64)
    if counted:
        fit, weight = x, np.ones(len(x))
    else:
        fit = np.unique(x, axis=0)
        weight = np.ones(len(fit))
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    matrix = (centred * weight[:, None]).T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    size = (values > 1e-11 * values[0]).sum()
    z = ((n * x - total) / n) @ vectors[:, :size] / np.sqrt(values[:size])
    deviation = [sum(int(n * v - t) ** 2 for v, t in zip(row, total)) for row in x]
    return {
        (i, k + 1): (deviation[j], abs(z[j, k]), values[k] / np.trace(matrix)) for j, (i, _) in enumerate(rows) for k in range(size)
    }, n


def same(df, rows, most=16, counted=False):
    expected, n = plain(rows, most, counted)
    got = df.collect()
    assert Counter((r["vec_id"], r["component"]) for r in got) == Counter(
        (i, k) for i, _ in rows for k in range(1, 1 + max(c for _, c in expected))
    )
    for r in got:
        deviation, z, explained = expected[r["vec_id"], r["component"]]
        assert r["n"] == n and r["deviation"] == deviation and r["identity_error"] < 1e-9
        assert abs(abs(r["whitened"]) - z) < 1e-6 and abs(r["explained"] / explained - 1) < 1e-6
    return got


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_query_against_numpy(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = same(QUERIES["op12_embedding_whitening"](spark, FOLDER), [tuple(r) for r in table])
    # Signs of a component are the same for all rows: columns are centred and uncorrelated.
    z = np.zeros((len(table), 16))
    number = {r["vec_id"]: i for i, r in enumerate(table)}
    for r in got:
        z[number[r["vec_id"]], r["component"] - 1] = r["whitened"]
    fit = np.unique(np.round(z, 9), axis=0)
    assert np.abs(fit.T @ fit / len(fit) - np.outer(fit.mean(0), fit.mean(0)) - np.eye(16)).max() < 1e-6


SCHEMA = "vec_id long, embedding array<float>, label int, x array<long>, h1 long, copies long, component int, whitened double"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, 1, [], 0, 0, 0, 0.0) for i, e in rows], SCHEMA)


def test_rows_that_take_no_part(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)] + [(0, good[0][1])]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0]), (903, [1.0, float("nan"), 2.0]), (904, [float("inf"), 0.0, 0.0]),
           (905, [1.0, 2.0]), (906, [float("-inf"), 0.0, 0.0]), (907, [1e30, 0.0, 0.0])]
    df = frame(spark, bad + good)
    same(whiten(df), good)
    same(whiten(df, weights="count"), good, counted=True)
    same(whiten(df, most=2), good, most=2)
    with pytest.raises(ValueError):
        whiten(df, weights="rows")
    nulls = whiten(frame(spark, [(None, good[0][1]), (None, good[1][1]), (1, good[2][1])])).collect()
    assert Counter(r["vec_id"] for r in nulls) == {None: 4, 1: 2}


def test_few_vectors(spark):
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = [(1, [0.0, 0.0, 1.0]), (2, [1.0, 1.0, 1.0]), (3, [2.0, 2.0, 1.0]), (4, [2.0, 2.0, 1.0])]
    same(whiten(frame(spark, line)), line)


def test_shuffled_and_sent_groups_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in rng.normal(size=4)]) for i in range(30)]
    rows += [(50 + i, rows[i % 3][1]) for i in range(60)]
    for hot in (2, 5, 1000):
        monkeypatch.setattr(whitening, "HOT", hot)
        same(whiten(frame(spark, rows)), rows)


def test_deviations_are_exact():
    x = np.array([[2**52, 0], [0, 2**52], [5, 7]], np.int64)
    totals = [int(v) for v in x.sum(axis=0)]
    expected = [sum((3 * int(v) - t) ** 2 for v, t in zip(row, totals)) for row in x]
    got = whitening._deviations(x, 3, totals)
    assert got == [v if v < 2**63 else None for v in expected]
    small = x % 1000
    assert whitening._deviations(small, 10**9, [5, 6]) == [
        sum((10**9 * int(v) - t) ** 2 for v, t in zip(row, (5, 6))) if sum((10**9 * int(v) - t) ** 2 for v, t in zip(row, (5, 6))) < 2**63 else None
        for row in small
    ]
