"""Periodic runs: grammar, extensions and runs against brute force, small cases, the query."""

import hashlib
import random
import re
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from visitloom.llm.periodic_runs import Grammar, RunFinder, periodic_runs
from visitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, least=24, exponent=3):
    """All stretches of each period, longest first seen with the smallest period: no grid, no grammar."""
    n, found = len(words), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i > s and i + p - s >= max(least, exponent * p):
                found.setdefault((s, i + p - s), p)
            i += i == s
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 30 else 0):
        a = rng.randrange(n)
        p, end = 1 + rng.randrange(max(1, (n - a) // 3)), rng.randrange(a, n)
        for i in range(a, end):
            words[i] = words[a + (i - a) % p]
    return words


def test_extensions_are_exact():
    rng = random.Random(1)
    for _ in range(60):
        words = random_words(rng, rng.choice([2, 9, 40, 300]))
        grammar = Grammar(np.array([-1, *words, -2]))
        n = len(words)
        pairs = [(a, b) for a in range(n) for b in range(a + 1, n)]
        pairs = rng.sample(pairs, min(len(pairs), 200))
        a, b = np.array(pairs).T + 1
        ahead, behind = grammar.extensions(a, b, 1), grammar.extensions(a, b, -1)
        for (i, j), f, back in zip(pairs, ahead, behind):
            assert f == next((k for k in range(n) if j + k >= n or words[i + k] != words[j + k]), n)
            assert back == next((k for k in range(n) if i - k < 0 or words[i - k] != words[j - k]), n)


@pytest.mark.parametrize("least, exponent", [(24, 3), (6, 2), (1, 4), (40, 2), (10, 3)])
def test_runs_against_brute_force(least, exponent):
    rng = random.Random(least)
    texts = [random_words(rng, rng.choice([0, 1, 5, 24, 30, 80, 200, 400])) for _ in range(150)]
    found = RunFinder(least, exponent).find([np.array(t, np.int64) for t in texts])
    for words, runs in zip(texts, found):
        assert [tuple(map(int, r)) for r in runs] == plain_runs(words, least, exponent)


def test_grammars_of_several_texts_and_pieces_of_the_grid(monkeypatch):
    import visitloom.llm.periodic_runs as module

    rng = random.Random(5)
    texts = [random_words(rng, 400) for _ in range(20)]
    expected = [plain_runs(t) for t in texts]
    monkeypatch.setattr(module, "GRAMMAR_WORDS", 500)
    monkeypatch.setattr(module, "_GRID_PLACES", 50)
    finder = RunFinder()
    finder._small_grid = lambda n: tuple(np.concatenate(x) for x in zip(*finder._grid(n)))
    found = finder.find([np.array(t, np.int64) for t in texts])
    assert [[tuple(map(int, r)) for r in runs] for runs in found] == expected and any(expected)


def test_long_texts():
    words = np.random.default_rng(1).integers(0, 9000, 300_000)
    words[1_000:200_000] = np.tile(words[1_000:1_007], 28_429)[:199_000]
    words[250_000:] = 1
    (runs,) = RunFinder().find([words])
    assert runs.tolist() == [[1_000, 199_000, 7], [250_000, 50_000, 1]]


@pytest.mark.parametrize("least, exponent, n", [(24, 3, 8_192), (24, 3, 9_000), (24, 3, 16_383), (24, 3, 16_384), (1, 2, 3_000)])
def test_long_periods_of_texts_of_every_size(least, exponent, n):
    """The grid of a text holds all its periods, of however many pieces it is."""
    for period in (n // exponent, n // (exponent + 1), n // (4 * exponent)):
        words = np.arange(n) % period
        (runs,) = RunFinder(least, exponent).find([words])
        assert runs.tolist() == [[0, n, period]]


def test_small_cases(spark, make_documents):
    a = " ".join(["x", "y\tz"] * 12)
    rows = [(1, None), (2, ""), (3, " \n\x0b "), (4, a), (4, a), (None, a), (5, "w " * 23), (6, "w " * 24),
            (7, "A " * 20 + "a " * 20), (8, "é 中 " * 30), (9, "q " + a + " q")]
    got = sorted(map(tuple, periodic_runs(make_documents(*rows)).collect()), key=str)
    run = lambda *x: [tuple(x)]
    expected = [
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 36, run(0, 36, 3), "x y z"), (4, 36, run(0, 36, 3), "x y z"),
        (None, 36, run(0, 36, 3), "x y z"), (5, 23, [], " ".join("w" * 23)), (6, 24, run(0, 24, 1), "w"),
        (7, 40, [], " ".join("A" * 20 + "a" * 20)), (8, 30, run(0, 30, 1), "é 中"), (9, 38, run(1, 36, 3), "q x y z q"),
    ]
    assert [(i, n, [tuple(r) for r in runs], text) for i, n, runs, text in got] == sorted(expected, key=str)
    assert periodic_runs(make_documents()).count() == 0
    with pytest.raises(ValueError):
        RunFinder(24, 1)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_query_against_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows, several = QUERIES["op13_periodic_runs"](spark, FOLDER).collect(), 0
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g, own = h // 10, list(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words[a:] = [own[a + (i - a) % p] for i in range(a, n)]
        if n > 3000:
            continue  # brute force takes the square
        runs = plain_runs(words)
        several += len(runs)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == (best or (None,) * 3)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert r["runs_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        gone = {i for s, length, p in runs for i in range(s + p, s + length)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert several > 10
