"""Bad lines set aside, inferred JSON columns, records read back in, SQL functions, bucketed tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import final_plan
from visitloom.functions import texts, times
from visitloom.functions.in_sql import FUNCTIONS, register_functions
from visitloom.functions.numbers import ratio_3
from visitloom.operators.joins import rows_of
from visitloom.operators.sessions import list_text, session_records, session_summary
from visitloom.sources.bucketed import bucketed, catalog_partitions, drop_table, save_bucketed
from visitloom.sources.files import json_columns, read_json_checked, read_people_checked


def test_bad_json_lines(spark, tmp_path):
    good = ['{"name": "a", "age": 3}', '{"age": null, "other": [1]}', "{}"]
    bad = {"": "empty", "   ": "empty", "{": "not JSON", "name": "not JSON", "[1]": "not an object", "3": "not an object",
           '{"age": "x"}': "wrong type", '{"age": 9999999999}': "wrong type", '{"name": "b", "age": [3]}': "wrong type"}
    (tmp_path / "lines.json").write_text("\n".join([*good, *bad]) + "\n")
    rows, rejected = read_json_checked(spark, str(tmp_path / "lines.json"), T.StructType.fromDDL("name string, age int"))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("a", 3), (None, None), (None, None)], key=str)
    assert {tuple(r) for r in rejected.collect()} == set(bad.items())
    assert rows.count() + rejected.count() == len(good) + len(bad)
    (tmp_path / "none.json").write_text("")
    rows, rejected = read_json_checked(spark, str(tmp_path / "none.json"), T.StructType.fromDDL("name string"))
    assert rows.count() == rejected.count() == 0


def test_bad_people_lines(spark, tmp_path):
    lines = ["ann, 29", "bo,x", "cy", "dee, 3, 4", ", 5", "", "ed, 99999999999", "fay,-1"]
    (tmp_path / "people.txt").write_text("\n".join(lines))
    rows, rejected = read_people_checked(spark, str(tmp_path / "people.txt"))
    assert sorted(map(tuple, rows.collect())) == [("ann", 29), ("fay", -1)]
    assert sorted(map(tuple, rejected.collect())) == sorted([
        ("bo,x", "no number"), ("cy", "too few values"), ("dee, 3, 4", "too many values"), (", 5", "no name"),
        ("", "too few values"), ("ed, 99999999999", "no number"),
    ])


def test_json_columns(spark):
    rows = [(1, '{"k": 5, "s": "x", "o": {"p": [1, 2.5]}, "m": 1}'), (2, '{"k": 7000000000, "id": 4, "m": "t"}'), (3, None), (4, "no json"), (5, "{}")]
    df = json_columns(spark.createDataFrame(rows, "id int, j string"), "j")
    assert df.columns == ["id", "j", "id_", "k", "m", "o", "s"]
    got = {r["id"]: r for r in df.withColumn("m", F.col("m").cast("string")).collect()}
    assert got[1]["k"] == 5 and got[2]["k"] == 7_000_000_000 and got[2]["id_"] == 4 and got[1]["s"] == "x"
    assert (got[1]["m"], got[2]["m"]) == ("1", "t") and [float(v) for v in got[1]["o"]["p"]] == [1.0, 2.5]
    assert all(v is None for i in (3, 4, 5) for v in got[i][2:])
    assert json_columns(spark.createDataFrame([], "j string"), "j").columns == ["j"]


def test_records_are_read_back(spark, make_actions):
    rows = [dict(session_id=f"s{i % 5}", user_id=i % 3, action_time=f"2024-01-10 10:00:{i:02d}", search_keyword=f"k{i % 4}" if i % 3 else None) for i in range(20)]
    table = list_text(session_records(make_actions(*rows, dict(session_id="x", action_time="no time"))))
    empty = {"search_keywords": "", "click_category_ids": ""}
    written = table.select(texts.record(**{c: F.col(c) for c in table.columns}).alias("r"))
    again = written.select(texts.typed_record(F.col("r"), table.schema, empty).alias("t")).select("t.*")
    assert [f.dataType for f in again.schema] == [f.dataType for f in table.schema] and again.columns == table.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, table.collect()))
    odd = spark.createDataFrame([("a=1|a=2|b=|b=3||c==|c=x=y|d=4==|=5|e",), ("",), (None,)], "r string")
    found = odd.select(texts.record_fields(F.col("r"), ["a", "b", "c", "d", "e"]).alias("f"), "r").collect()
    assert tuple(found[0]["f"]) == ("1", "3", None, "4", None) and tuple(found[1]["f"]) == (None,) * 5
    for name, value in found[0]["f"].asDict().items():
        assert odd.limit(1).select(texts.record_field(F.col("r"), name)).first()[0] == value


def test_sql_functions(spark):
    """Each function gives what the function of columns gives, without Python in the plan."""
    assert register_functions(spark) == list(FUNCTIONS)
    values = ["2024-01-10 10:00:00", "2024-01-11 09:00:01", "2024-02-30 10:00:00", "x", "", None, ",1,2,", "7", "12", "a=1|b=2|a=3", "5,x,,9", "2024-01-10 "]
    df = spark.createDataFrame([(a, b) for a in values for b in values], "a string, b string")
    df.createOrReplaceTempView("pairs_of_texts")
    a, b = F.col("a"), F.col("b")
    both = {
        "time_text(parsed_time(a))": times.format_time(times.parse_time(a)),
        "date_hour(a)": times.date_hour(a),
        "is_before(a, b)": times.before(a, b),
        "is_after(a, b)": times.after(a, b),
        "seconds_apart(a, b)": times.seconds_between(a, b),
        "no_text(a)": texts.is_empty(a),
        "without_commas(a)": texts.trim_comma(a),
        "two_digits(a)": texts.two_digits(a),
        "id_texts(a)": texts.id_texts(a),
        "id_list(a)": texts.id_list(a),
        "record_field(a, 'a')": texts.record_field(a, "a"),
        "share_3(length(a), length(b))": ratio_3(F.length(a).cast("bigint"), F.length(b).cast("bigint")),
    }
    listed = ", ".join(f"{call} AS c{i}" for i, call in enumerate(both))
    sql = spark.sql(f"SELECT a, b, {listed} FROM pairs_of_texts")
    assert "Python" not in final_plan(sql)
    expected = df.select("a", "b", *(c.alias(f"c{i}") for i, c in enumerate(both.values())))
    assert sorted(map(str, sql.collect())) == sorted(map(str, expected.collect()))
    assert set(FUNCTIONS) == {call.partition("(")[0] for call in both} | {"parsed_time"}


@pytest.fixture
def log(make_actions):
    return make_actions(*(dict(session_id=f"s{i % 40}" if i % 7 else None, user_id=i % 7, action_time=f"2024-01-{10 + i % 3:02d} 10:00:{i % 60:02d}") for i in range(300)))


def _plain(df):
    return sorted(map(str, df.collect()))


def test_bucketed_log_is_not_shuffled(spark, log):
    table = bucketed(log, 5)
    assert _plain(table) == _plain(log)
    summary = session_summary(table)
    assert "Exchange" not in final_plan(summary) and _plain(summary) == _plain(session_summary(log))
    sessions = log.select("session_id").where("session_id < 's2'").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wanted = rows_of(table, sessions)
        plan = final_plan(wanted)
        actions_side = plan.split("SortMergeJoin")[1]
        assert plan.count("Exchange hashpartitioning(session_id") <= 2 and "Bucketed: true" in actions_side
        assert _plain(wanted) == _plain(rows_of(log, sessions))
        chosen = bucketed(sessions, 5)
        wanted = rows_of(table, chosen)
        assert "Exchange" not in final_plan(wanted) and _plain(wanted) == _plain(rows_of(log, sessions))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError):
        bucketed(log, 0)


def test_catalog_tables(spark, log, tmp_path):
    table = catalog_partitions(log, "actions_by_day", str(tmp_path / "by_day"))
    assert table.columns == log.columns and _plain(table) == _plain(log)
    assert "PartitionFilters: [isnotnull(date" in final_plan(table.where("date = '2024-01-11'"))
    saved = save_bucketed(log, "actions_by_session", 3, str(tmp_path / "by_session"))
    assert _plain(saved) == _plain(log)
    for name in ("actions_by_day", "actions_by_session"):
        drop_table(spark, name)
        assert not spark.catalog.tableExists(name)
