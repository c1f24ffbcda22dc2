import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from visitloom.operators import grouping, joins, ordering, predicates


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(
        [("class1", 80), ("class2", 75), ("class1", 90), ("class2", 65)], "key string, value int"
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, half of them equal; a NULL key and NULL values."""
    rng = random.Random(3)
    rows = [("hot", 5 if i % 2 else i) for i in range(400)]
    rows += [(f"k{rng.randrange(60)}", rng.randrange(30)) for _ in range(700)]
    rows += [(None, i % 3) for i in range(80)] + [("k1", None), ("hot", None), ("hot", None)]
    return rows, spark.createDataFrame(rows, "key string, value int").repartition(5)


def test_small_groupings(scores):
    lists = {r["key"]: r["values"] for r in grouping.values_by_key(scores, "key", "value").collect()}
    assert lists == {"class1": [80, 90], "class2": [65, 75]}
    assert dict(grouping.sum_by(scores, "key", "value").collect()) == {"class1": 170, "class2": 140}
    assert dict(grouping.count_by(scores, "key").collect()) == {"class1": 2, "class2": 2}
    assert grouping.count_map(scores, "key").collect() == [(0, {"class1": 2, "class2": 2})]


def test_whole_table_reductions(spark):
    numbers = spark.range(1, 11).select(F.col("id").cast("int").alias("x"))
    assert grouping.total(numbers, "x").first()[0] == 55
    assert grouping.row_count(numbers).first()[0] == 10
    assert [r[0] for r in ordering.first_rows(numbers, 3, "x", "x").collect()] == [1, 2, 3]
    assert ordering.any_rows(numbers, 3).count() == 3
    assert grouping.all_values(numbers, "x").collect() == [(0, list(range(1, 11)))]


def test_null_is_a_group(spark):
    people = spark.createDataFrame([("Michael", None), ("Andy", 30), ("Justin", 19)], "name string, age int")
    assert dict(grouping.count_by(people, "age").collect()) == {None: 1, 30: 1, 19: 1}


def _sorted(values):
    return sorted(values, key=lambda v: (v is not None, v))


@pytest.mark.parametrize("page_rows", [1, 10, 50, 100_000])
def test_pages_of_a_key_are_its_sorted_list(skewed, page_rows):
    rows, df = skewed
    expected = defaultdict(list)
    for key, value in rows:
        expected[key].append(value)
    got = defaultdict(list)
    for row in grouping.values_by_key(df, "key", "value", page_rows).orderBy("page").collect():
        assert row["page"] * page_rows == len(got[row["key"]])
        assert len(row["values"]) <= page_rows
        got[row["key"]] += row["values"]
    assert got == {k: _sorted(v) for k, v in expected.items()}


def test_a_hot_key_is_spread_over_ranges(spark, skewed):
    from visitloom.operators.positions import with_starts

    _, df = skewed
    counted = df.where("key = 'hot'").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    starts = with_starts(counted, ["key"], [F.asc_nulls_first("value")], "n").collect()
    at = 1
    for row in sorted(starts, key=lambda r: (r["value"] is not None, r["value"])):
        assert row["start"] == at
        at += row["n"]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = counted.repartitionByRange("key", "value").select(F.spark_partition_id().alias("p")).distinct().count()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert dealt > 1


@pytest.mark.parametrize("page_rows", [20, 100_000])
def test_pages_of_all_values(skewed, page_rows):
    rows, df = skewed
    pages = grouping.all_values(df, "value", page_rows).orderBy("page").collect()
    assert all(len(r["values"]) == page_rows for r in pages[:-1])
    assert [v for r in pages for v in r["values"]] == _sorted(v for _, v in rows)


@pytest.mark.parametrize("page_rows", [7, 100_000])
def test_count_map_is_whole(skewed, page_rows):
    rows, df = skewed
    pages = grouping.count_map(df, "key", page_rows).orderBy("page").collect()
    assert all(len(r["counts"]) == page_rows for r in pages[:-1])
    keys = [k for r in pages for k in sorted(r["counts"])]
    assert keys == sorted(keys)
    assert {k: n for r in pages for k, n in r["counts"].items()} == Counter(k for k, _ in rows if k is not None)


def test_joined_text(spark):
    letters = spark.createDataFrame([(c,) for c in "QRSTUVW"], "s string").repartition(3)
    assert grouping.joined_text(letters, "s").collect() == [(0, "Q_R_S_T_U_V_W_")]
    pages = grouping.joined_text(letters, "s", 3).orderBy("page").collect()
    assert [r["text"] for r in pages] == ["Q_R_S_", "T_U_V_", "W_"]
    assert grouping.joined_text(letters.where("s = 'x'"), "s").collect() == []


def test_positions(spark):
    marks = spark.createDataFrame([(i * 7919 % 101 // 10, i) for i in range(100)], "m int, n int").repartition(4)
    rows = ordering.sorted_positions(marks, "m", "n", descending=True).collect()
    ranked = [(r["m"], r["n"]) for r in sorted(rows, key=lambda r: r["position"])]
    assert ranked == sorted(ranked, key=lambda x: (-x[0], x[1]))
    assert sorted(r["position"] for r in rows) == list(range(1, 101))


def test_keyed_sum(spark):
    def sums(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        return dict(grouping.keyed_sum(df, "t").collect())

    assert sums("ONE:1", "TWO:2", "THREE:3", "ONE:9") == {"ONE": 10, "TWO": 2, "THREE": 3}
    assert sums("one:4", "four:5", "bad", "x:1:2", "FIVE:x") == {"ONE": 4, "TWO": 0, "THREE": 0, "FOUR": 5}
    assert sums("ONE:1_TWO:5") == {"ONE": 1, "TWO": 5, "THREE": 0}


def test_sorting(spark):
    marks = spark.createDataFrame([(65, "leo"), (89, "tom"), (80, "marr"), (50, "jack"), (80, "ann")], "m int, n string")
    assert [r[0] for r in ordering.sort_rows(marks, "m", "n").collect()] == [50, 65, 80, 80, 89]
    assert [r[1] for r in ordering.sort_rows(marks, "m", "n", True).collect()] == ["tom", "ann", "marr", "leo", "jack"]


def test_coordinates(spark):
    given = ["27.34832,111.32135", "34.88478,185.17841", "39.92378,119.50802", "94,119.50802", "nowhere"]
    valid, invalid = predicates.split_coordinates(spark.createDataFrame([(g,) for g in given], "c string"), "c")
    assert sorted(r[0] for r in invalid.collect()) == ["34.88478,185.17841", "94,119.50802", "nowhere"]
    assert sorted(r[0] for r in valid.collect()) == ["27.34832,111.32135", "39.92378,119.50802"]


def test_join_and_cogroup(spark):
    students = spark.createDataFrame([(1, "leo"), (2, "jack"), (3, "tom"), (None, "x")], "id int, name string")
    marks = spark.createDataFrame(
        [(1, 100), (2, 90), (3, 98), (1, 100), (2, 85), (3, 45), (4, 1), (None, 2)], "id int, mark int"
    )
    assert joins.inner_join(students, marks, "id").count() == 6
    got = {r["id"]: (r["left_values"], r["right_values"]) for r in grouping.cogroup(students, marks, "id").collect()}
    assert got == {
        1: (["leo"], [100, 100]),
        2: (["jack"], [85, 90]),
        3: (["tom"], [45, 98]),
        4: ([], [1]),
        None: (["x"], [2]),
    }


def test_cogroup_in_parts_is_whole(skewed, spark):
    rows, df = skewed
    other = spark.createDataFrame([("hot", i) for i in range(90)] + [("k1", 1)], "key string, mark int")
    left, right = defaultdict(Counter), defaultdict(Counter)
    for row in grouping.cogroup(df, other, "key", 40).collect():
        left[row["key"]].update(row["left_values"])
        right[row["key"]].update(row["right_values"])
    assert left["hot"] == Counter(v for k, v in rows if k == "hot")
    assert right["hot"] == Counter(range(90))
    assert set(left) == {k for k, _ in rows}


def test_full_join_matches_spark(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, l string")
    b = spark.createDataFrame([(2, "x"), (2, "y"), (3, "z"), (None, "n")], "k int, r string")
    got = Counter(map(tuple, joins.full_join(a, b, "k").collect()))
    assert got == Counter(map(tuple, a.join(b, "k", "full").collect()))


def test_keys_of_one_page_and_of_more(spark):
    """Keys at the edge of a page, whose lists come either way, are the same lists cut into pages."""
    rows = [(k, (i * 7) % 5 if i % 3 else None) for k, n in ((None, 4), (1, 5), (2, 6), (3, 11), (4, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, v int")
    order = lambda v: (v is not None, v or 0)
    for page_rows in (1, 3, 5, 6, 100):
        got = grouping.values_by_key(df, "k", "v", page_rows).collect()
        lists = {}
        for r in sorted(got, key=lambda r: r["page"]):
            assert 1 <= len(r["values"]) <= page_rows
            lists.setdefault(r["k"], []).extend(r["values"])
        assert lists == {k: sorted((v for x, v in rows if x == k), key=order) for k in (None, 1, 2, 3, 4)}
        assert sorted((str(r["k"]), r["page"]) for r in got) == sorted(
            (str(k), p) for k, v in lists.items() for p in range(-(-len(v) // page_rows))
        )
    left, right = df.where("k < 3"), df.where("k > 1").withColumnRenamed("v", "w")
    for page_rows in (2, 5, 6, 100):
        got = grouping.cogroup(left, right, "k", page_rows).collect()
        for side, frame in (("left_values", left), ("right_values", right)):
            lists = {}
            for r in sorted(got, key=lambda r: r["page"]):
                lists.setdefault(r["k"], []).extend(r[side])
            given = [tuple(r) for r in frame.collect()]
            assert {k: v for k, v in lists.items() if v} == {k: sorted((v for x, v in given if x == k), key=order) for k, _ in given}
