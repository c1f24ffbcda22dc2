import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from visitloom.functions import numbers, texts, times

RECORD = (
    "sessionId=c0ffee|searchKeywords=|clickCategoryIds=5,81|visitLength=77|"
    "stepLength=6|startTime=2024-03-05 07:08:09"
)


@pytest.fixture(scope="module")
def one(spark):
    def value(build, *given):
        df = spark.createDataFrame([tuple(given)], ", ".join(f"c{i} string" for i in range(len(given))))
        return df.select(build(*(F.col(f"c{i}") for i in range(len(given)))).alias("v")).first()["v"]

    return value


@pytest.mark.parametrize(
    "field,expected",
    [
        ("sessionId", "c0ffee"),
        ("searchKeywords", None),
        ("clickCategoryIds", "5,81"),
        ("startTime", "2024-03-05 07:08:09"),
        ("age", None),
    ],
)
def test_record_field(one, field, expected):
    assert one(lambda r: texts.record_field(r, field), RECORD) == expected


def test_record_field_forms(one):
    assert one(lambda r: texts.record_field(r, "k"), "k=1|k=2") == "1"
    assert one(lambda r: texts.record_field(r, "k"), "k=a=b|k=2") == "2"
    assert one(lambda r: texts.record_field(r, "k"), "k=v==") == "v"


def test_set_record_field(one):
    def changed(record, field="k"):
        return one(lambda r: texts.set_record_field(r, field, F.lit("new")), record)

    assert changed("a=1|k=2|k=3") == "a=1|k=new|k=3"
    assert changed("k=|a=1") == "k=new|a=1"
    assert changed("a=1|b=2|") == "a=1|b=2"
    assert changed(RECORD, "searchKeywords") == RECORD.replace("Keywords=|", "Keywords=new|")


def test_small_texts(one):
    assert one(texts.trim_comma, ",1,2,") == "1,2"
    assert one(texts.trim_comma, "1,2") == "1,2"
    assert [one(texts.two_digits, s) for s in ("7", "17", "117")] == ["07", "17", "0117"]
    assert [one(texts.is_empty, s) for s in ("", "a")] == [True, False]
    assert one(lambda c: texts.is_empty(F.when(c == "x", c)), "a") is True
    assert one(texts.id_list, "12,x,3,") == [12, 3]
    assert one(texts.words, "a  b ") == ["a", "", "b"]
    assert one(texts.words, "  ") == []
    assert one(texts.words, "") == [""]
    assert one(lambda t, p: texts.contains(t, p), "abc", "bc") is True


def test_times(one):
    assert one(times.date_hour, "2020-01-10 15:03:17") == "2020-01-10_15"
    assert one(times.date_hour, "2020-01-10") is None
    parsed = lambda t: times.format_time(times.parse_time(t))
    assert one(parsed, "2020-01-10 15:03:17") == "2020-01-10 15:03:17"
    assert [one(parsed, s) for s in ("2020-13-10 15:03:17", "2020-01-10", "2020-01-10 15:03:17 x")] == [None] * 3
    assert one(times.before, "2020-01-10 15:03:17", "2020-01-10 15:03:18") is True
    assert one(times.after, "2020-01-10 15:03:17", "2020-01-10 15:03:18") is False
    assert one(times.before, "2020-01-10 15:03:17", "later") is False
    assert one(times.after, "later", "2020-01-10 15:03:17") is False
    assert one(times.seconds_between, "2020-01-10 16:00:00", "2020-01-10 15:00:01") == 3599
    assert one(times.seconds_between, "2020-01-10 16:00:00", "") == 0
    today, yesterday, now = (one(lambda _, f=f: f(), "x") for f in (times.today, times.yesterday, times.now))
    assert yesterday < today <= now[:10] and len(now) == 19


@pytest.mark.parametrize(
    "text",
    ["2020-02-30 00:00:00", "2020-01-10T15:03:17", "2020-01-10 1:02:03Z", "2020-01-10 1:2:3.45", "2020-01-10", "x" * 19,
     "", "2020-01-10 24:00:00", "2020-01-10 15:03:17\n"],
)
def test_times_of_another_form_are_null(one, text):
    assert one(times.parse_time, text) is None


def test_times_do_not_depend_on_the_session_zone(spark, one):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # An hour that this zone skips.
        assert one(lambda t: times.format_time(times.parse_time(t)), "2024-03-10 02:30:00") == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _dropped_end(parts):
    """A split leaves out empty parts at the end, unless the whole text is empty."""
    while len(parts) > 1 and parts[-1] == "":
        parts = parts[:-1]
    return parts


def _field(record, name):
    for entry in record.split("|"):
        pair = _dropped_end(entry.split("="))
        if len(pair) == 2 and pair[0] == name:
            return pair[1]
    return None


def _changed(record, name, value):
    entries = _dropped_end(record.split("|"))
    for i, entry in enumerate(entries):
        if entry.split("=")[0] == name:
            entries[i] = f"{name}={value}"
            break
    return "|".join(entries)


def test_records_and_lists_match_plain_python_on_random_texts(spark):
    rng = random.Random(11)
    given = sorted({"".join(rng.choice("aab==||,1 \n") for _ in range(rng.randrange(14))) for _ in range(4000)})
    t = F.col("t")
    df = spark.createDataFrame([(g,) for g in given], "t string").select(
        "t",
        texts.record_field(t, "a").alias("field"),
        texts.set_record_field(t, "a", F.lit("z")).alias("changed"),
        texts.words(t).alias("words"),
        texts.trim_comma(t).alias("trimmed"),
        texts.id_list(t).alias("ids"),
    )
    for row in df.collect():
        text = row["t"]
        assert row["field"] == _field(text, "a"), text
        assert row["changed"] == _changed(text, "a", "z"), text
        blank = text != "" and text.strip(" ") == ""
        assert row["words"] == ([] if blank else _dropped_end(text.split(" "))), text
        once = text[1:] if text.startswith(",") else text
        assert row["trimmed"] == (once[:-1] if once.endswith(",") else once), text
        assert row["ids"] == [int(i) for i in text.split(",") if i.strip(" \n").isdigit()], text


def test_ratio_matches_decimal_rounding(spark):
    df = spark.range(0, 60).select(F.col("id").alias("c")).crossJoin(spark.range(1, 60).select(F.col("id").alias("n")))
    for c, n, r in df.select("c", "n", numbers.ratio_3(F.col("c"), F.col("n"))).collect():
        exact = (Decimal(c) / Decimal(n)).quantize(Decimal("0.001"), ROUND_HALF_UP)
        assert r == float(exact)


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (-2.5,), (6.55,)], "x double")
    assert [r[0] for r in df.select(numbers.round_half_up(F.col("x"), 2)).collect()] == [0.13, 2.5, -2.5, 6.55]
    assert [r[0] for r in df.select(numbers.round_half_up(F.col("x"), 0)).collect()] == [0.0, 3.0, -3.0, 7.0]


def test_round_of_large_values_and_nan(spark):
    df = spark.createDataFrame([(1e21,), (float("nan"),), (None,)], "x double")
    large, nan, null = (r[0] for r in df.select(numbers.round_half_up(F.col("x"), 2)).collect())
    assert large == 1e21 and nan != nan and null is None
