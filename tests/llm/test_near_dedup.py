"""Near-duplicates against all pairs of sets."""

import random
import re
from collections import defaultdict

from visitloom.llm import near_dedup
from visitloom.llm.components import connected_components
from visitloom.llm.near_dedup import fewest_matches, near_duplicates, without_near_duplicates


def shingles(text):
    words = tuple(re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")))
    return {words[i : i + 5] for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted((i, len(s), root(i), i == root(i)) for i, s in sets)


def check(make_documents, rows):
    assert sorted(map(tuple, near_duplicates(make_documents(*rows)).collect())) == expected(rows)


def words(rng, n, alphabet=5000):
    return [f"w{rng.randrange(alphabet)}" for _ in range(n)]


def edited(rng, given, edits):
    out = list(given)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def test_groups_of_all_kinds(make_documents):
    rng = random.Random(7)
    rows, number = [], iter(rng.sample(range(10_000), 2_000))
    for _ in range(40):  # copies with more and more edits, about the threshold
        base = words(rng, rng.randrange(5, 120))
        rows += [(next(number), " ".join(edited(rng, base, rng.randrange(0, 6)))) for _ in range(rng.randrange(1, 6))]
    hot = words(rng, 200)
    rows += [(next(number), " ".join(hot))] * 3
    rows += [(next(number), " ".join(hot)) for _ in range(150)]
    rows += [(next(number), " ".join(edited(rng, hot, rng.randrange(0, 9)))) for _ in range(150)]
    passage = words(rng, 60)  # a common passage, without which the texts differ
    rows += [(next(number), " ".join(passage + words(rng, rng.randrange(10, 60)))) for _ in range(150)]
    chain = words(rng, 100)  # each text is near the one before, the ends are not
    for _ in range(30):
        rows.append((next(number), " ".join(chain)))
        chain = chain[4:] + words(rng, 4)
    rows = list(dict.fromkeys(rows))
    check(make_documents, rows)


def test_short_empty_null_and_long(make_documents):
    check(make_documents, [(5, ""), (6, ""), (7, None), (8, None), (9, " \t\n"), (3, "A b c"), (2, "a  B\nc"), (1, "a b"),
                           (4, "a b c d e"), (11, "é b c"), (10, "É b c"), (12, "a b"), (-4, "a b c")])
    long = " ".join(f"v{i}" for i in range(50_000))
    check(make_documents, [(2, long), (1, long + " more"), (3, "v1 v2 v3 v4 v5")])


def test_repeated_rows_and_null_ids(make_documents):
    rows = [(2, "a b c d e f"), (2, "a b c d e f"), (3, "q r s t u v"), (3, "a b c d e f"), (5, "q r s t u v"), (None, "q r s t u v"), (None, None)]
    got = sorted(map(tuple, near_duplicates(make_documents(*rows)).collect()), key=str)
    assert got == sorted([(2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False), (3, 2, 2, False), (5, 2, 2, False),
                          (None, 2, None, True), (None, 0, None, True)], key=str)
    kept = without_near_duplicates(make_documents(*rows))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 2]
    assert kept.columns == make_documents().columns


def test_empty_table(make_documents):
    assert near_duplicates(make_documents()).count() == 0
    assert without_near_duplicates(make_documents()).count() == 0


def test_fewest_matches_keep_what_is_similar():
    least = fewest_matches()
    rng = random.Random(1)
    r = 0.75 + 0.25 / 256
    lost = 0
    for _ in range(3000):
        matches = 0
        for step, fewest in enumerate(least):
            matches += sum(rng.random() < r for _ in range(16))
            lost += matches < fewest
    assert lost == 0 and least == sorted(least) and least[-1] > 60


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(1000, 1400)]  # a path
    links += [(5, i) for i in range(2000, 2300)]  # a star
    links += [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(250)]
    links += [(7, 7), (2000, 5)]
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    least = {}
    for node in sorted(near):
        stack = [node] if node not in least else []
        while stack:
            at = stack.pop()
            if at not in least:
                least[at] = node
                stack += near[at]
    del least[7]
    least = {k: v for k, v in least.items() if near[k] != {k}}
    got = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == least and len(got) == len(least)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_doc_id_are_linked_to_the_first(spark):
    reps = spark.createDataFrame([(7, r) for r in range(3, 203)] + [(8, 300), (8, 400)], "doc_id long, rep long")
    links = sorted(map(tuple, near_dedup._linked_to_first(reps).collect()))
    assert links == [(3, r) for r in range(4, 203)] + [(300, 400)]


def test_pairs_of_several_buckets_come_once(make_documents, monkeypatch):
    """Edits of one text, most of them too far from each other: no pair leaves two blocks, and few pairs leave one."""
    rng = random.Random(3)
    base = words(rng, 200)
    rows = [(i, " ".join(edited(rng, base, rng.randrange(5, 9)))) for i in range(300)]
    seen, across = [], near_dedup._across_components

    def counted(*given):
        pairs = across(*given)
        seen.extend(map(tuple, pairs.collect()))
        return pairs

    monkeypatch.setattr(near_dedup, "_across_components", counted)
    monkeypatch.setattr(near_dedup, "BLOCK", 20)
    check(make_documents, rows)
    assert 0 < len(seen) == len(set(seen)) < 4 * len(rows)


def test_keys_below():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    for _ in range(50):
        lists = [rng.sample(range(-100, 100), rng.randrange(0, 32)) for _ in range(rng.randrange(1, 40))]
        key = rng.randrange(-100, 100)
        bits = near_dedup._keys_below(key, pa.array(lists, pa.list_(pa.int64())))
        for i, a in enumerate(lists):
            for j, b in enumerate(lists):
                if i != j:
                    assert bool(np.any(bits[i] & bits[j])) == any(k < key for k in set(a) & set(b))
