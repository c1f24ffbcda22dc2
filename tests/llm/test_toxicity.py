"""The search for nearest examples: many texts at once, with the results of one at a time."""

import random
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from visitloom.llm import toxicity
from visitloom.llm.batches import plain_bytes, plain_words


def _vector(rng, terms):
    ids = np.array(sorted(rng.sample(range(terms), rng.randrange(1, 9))))
    weights = np.array([rng.random() + 0.01 for _ in ids])
    return ids, weights / np.linalg.norm(weights)


@pytest.mark.parametrize("examples", [12, 700])
def test_many_vectors_at_once(monkeypatch, examples):
    for name, value in (("TEXTS", 50), ("BOUNDED", 7), ("POSTINGS", 300)):
        monkeypatch.setattr(toxicity, name, value)
    rng = random.Random(17)
    # The first terms are in most entries, the last ones in few.
    pool = [i for i in range(120) for _ in range(max(1, 60 // (i + 1)))]
    vectors = []
    for i in range(examples):
        ids = np.array(sorted({rng.choice(pool) for _ in range(6)}))
        weights = np.array([rng.random() + 0.01 for _ in ids])
        vectors.append((i, i % 2, ids, weights / np.linalg.norm(weights)))
    entries = toxicity._build_entries(vectors, 130)
    exact = np.zeros((len(entries.ids), 130))
    for term, (numbers, values) in enumerate(entries.postings):
        exact[numbers, term] = values
    asked = [_vector(rng, 130) for _ in range(180)] + [(ids, weights) for _, _, ids, weights in vectors[:60]]
    asked[3:3] = asked[100:100] = [(np.zeros(0, np.int64), np.zeros(0))] * 2  # texts without a known word
    lengths = [len(ids) for ids, _ in asked]
    given = toxicity.Vectors(
        np.append(0, np.cumsum(lengths)), np.concatenate([x for x, _ in asked]), np.concatenate([x for _, x in asked])
    )
    got = list(entries.nearest_of_all(given, 15))
    assert len(got) == len(asked)
    for (ids, weights), (found, cosines) in zip(asked, got):
        scores = exact[:, ids] @ weights
        best = np.sort(scores)[::-1][:15]
        assert np.allclose(cosines, best[best > 0], atol=1e-12) and np.allclose(scores[found], cosines, atol=1e-12)
        assert len(set(found.tolist())) == len(found)


def test_equal_cosines_go_to_the_earlier_entry():
    vectors = [(i, 0, np.array([i]), np.ones(1)) for i in range(40)]
    entries = toxicity._build_entries(vectors, 40)
    given = toxicity.Vectors(np.array([0, 40, 60]), np.append(np.arange(40), np.arange(20, 40)), np.full(60, 0.125))
    first, second = entries.nearest_of_all(given, 15)
    own = np.flatnonzero(entries.ids >= 20)
    assert first[0].tolist() == list(range(15)) and second[0].tolist() == own[:15].tolist()


def test_cosines_that_differ_by_rounding_are_equal():
    rng = np.random.default_rng(3)
    weights = rng.random(6)
    weights /= np.linalg.norm(weights)
    vectors = [(i, 0, np.arange(6) + 6 * (i % 5), rng.permutation(weights)) for i in range(200)]
    entries = toxicity._build_entries(vectors, 30)
    given = toxicity.Vectors(np.array([0, 30]), np.arange(30), np.full(30, 30**-0.5))
    ((found, cosines),) = entries.nearest_of_all(given, 15)
    assert found.tolist() == list(range(15)) and np.allclose(cosines, weights.sum() * 30**-0.5)


def test_words_of_many_texts_are_counted_at_once():
    texts = ["", None, "Zig zag zig", " , . ", "zag\tZOG über", "x" * 50, "zig", ""]
    ids = {b"zag": 0, b"zig": 1, "über".encode(): 2}
    for some in (texts, texts[:2], texts[3:4], []):
        owners, terms, counts = toxicity._term_counts([plain_bytes(t) for t in some], ids)
        known = {(o, t): c for o, t, c in zip(owners.tolist(), terms.tolist(), counts.tolist()) if t < len(ids)}
        words = [Counter(plain_words(t)) for t in some]
        assert known == {(i, ids[w]): n for i, c in enumerate(words) for w, n in c.items() if w in ids}
        assert len(owners) == sum(map(len, words)) and len({*zip(owners.tolist(), terms.tolist())}) == len(owners)
        assert counts.sum() == sum(sum(c.values()) for c in words)
    assert [len(g) for g in toxicity._groups(texts)] == [len(texts)]


def test_groups_of_long_texts(monkeypatch):
    monkeypatch.setattr(toxicity, "GROUP_BYTES", 10)
    texts = ["a b", None, "c" * 30, "d e f g h i", "j"]
    assert [len(g) for g in toxicity._groups(texts)] == [3, 1, 1]
    assert [w for g in toxicity._groups(texts) for w in g] == [plain_bytes(t) for t in texts]


def test_python_does_little_for_each_text(spark, monkeypatch):
    """a search of its own for each text took 263 calls a text here, and 988 CPU seconds a GB."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400) for _ in range(1 + 400 // (i + 1))]
    rows = [(i, " ".join(rng.choices(words, k=60)), int(i % 5 == 0)) for i in range(600)]
    examples = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(examples.select("doc_id", "text"), examples)
    started = []
    monkeypatch.setattr(toxicity, "map_pieces", lambda df, start, schema: started.append(start()))
    toxicity.score_toxicity(examples, model)
    batch = pa.record_batch([pa.array([r[0] for r in rows[:512]]), pa.array([r[1] for r in rows[:512]])], ["doc_id", "text"])
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        result = started[0](batch)
    finally:
        sys.setprofile(None)
    assert result.num_rows == 512 and calls["call"] + calls["c_call"] < 60 * 512
