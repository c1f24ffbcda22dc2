"""Line deduplication against a plain program."""

import random

from visitloom.llm.line_dedup import LEAST_WORDS, dedup_lines


def within_one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words(line):
    return tuple(w for w in line.translate({9: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w)


def expected(rows):
    places = [((i, n), words(line)) for i, t in rows if i is not None and t is not None
              for n, line in enumerate(t.split("\n")) if words(line)]
    first = {}
    for at, line in sorted(places):
        first.setdefault(line, at)
    long = [(line, at) for line, at in first.items() if len(line) >= LEAST_WORDS]
    near = {a for a, at in long for b, before in long if before < at and within_one_edit(a, b)}
    out = []
    for i, text in rows:
        kept = []
        for n, line in enumerate(text.split("\n") if text is not None else []):
            w = words(line)
            if i is None or not w or (w not in near and (i, n) == first[w]):
                kept.append(line)
        out.append((i, None if text is None else "\n".join(kept), 0 if text is None else text.count("\n") + 1 - len(kept)))
    return sorted(out, key=str)


def check(make_documents, rows):
    got = [(r["doc_id"], r["text"], r["lines_removed_"]) for r in dedup_lines(make_documents(*rows)).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_against_a_plain_program(make_documents):
    rng = random.Random(5)
    lines = []
    for _ in range(60):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 45))]
        for _ in range(rng.randrange(1, 7)):
            line = list(base)
            for _ in range(rng.randrange(0, 3)):
                i = rng.randrange(max(len(line), 1))
                line[i : i + rng.randrange(0, 2)] = [f"e{rng.randrange(50)}"] * rng.randrange(0, 2)
            lines.append((" " if rng.random() < 0.9 else " \t ").join(line) + rng.choice(["", "", " ", "\r"]))
    template = [f"t{i}" for i in range(30)]
    for i in range(80):  # many lines that differ at one place, and at places of their own
        lines.append(" ".join([*template[:12], f"x{i}", *template[13:]]))
        lines.append(" ".join([*template[:i % 30], f"y{i}", *template[i % 30 + 1 :]]))
    lines += ["hot line"] * 100 + ["", "  "] * 20 + ["a " * 12, "a " * 11, "a " * 13, "a b " + "a " * 10]
    rng.shuffle(lines)
    rows, number = [], iter(rng.sample(range(-500, 5000), 400))
    while lines:
        n = rng.randrange(1, 9)
        rows.append((next(number), "\n".join(lines[:n])))
        lines = lines[n:]
    check(make_documents, rows)


def test_null_empty_long_and_repeated(make_documents):
    long = " ".join(f"v{i}" for i in range(20_000))
    ten = " ".join(f"u{i}" for i in range(10))
    check(make_documents, [(1, None), (2, ""), (3, "\n"), (None, "a\na"), (None, None), (4, "a\na\n\na"), (5, "a"),
                           (6, long), (7, long.replace("v777 ", "")), (8, long.replace("v9 ", "z ")), (9, ten), (10, ten + " x"),
                           (11, ten.replace("u4 ", "")), (12, ten.replace("u4", "é"))])
    got = dedup_lines(make_documents((1, "a\nb\na"), (1, "a\nb\na"), (2, "b"))).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(1, "a\nb"), (1, "a\nb"), (2, "")]


def test_names_and_empty_table(make_documents):
    documents = make_documents()
    assert dedup_lines(documents).count() == 0
    assert dedup_lines(documents).columns == [*documents.columns, "lines_removed_"]


def test_no_python_in_the_plan(make_documents):
    plan = dedup_lines(make_documents((1, "a\nb")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Pandas" not in plan
