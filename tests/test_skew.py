"""Joins with a hot key: AQE splits it, whichever join it is."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import final_plan
from visitloom.operators.categories import category_counts
from visitloom.operators.joins import full_join, inner_join, rows_of
from visitloom.operators.sessions import with_users
from visitloom.schemas import USER_VISIT_ACTION
from visitloom.sources.tables import typed_by_name

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(shuffled):
    """A third of 60,000 rows with key 7."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    return shuffled.range(0, 60_000, 1, 8).select(key.alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def test_inner_join(shuffled, hot):
    keys = shuffled.range(4000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    joined = inner_join(hot, keys, "key")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == hot.where("key < 4000").count()


def test_full_join(shuffled, hot):
    keys = shuffled.range(4000, 6000).select(F.col("id").alias("key"), F.lit("x").alias("name"))
    hot_side = keys.unionByName(shuffled.range(7, 8).select(F.col("id").alias("key"), F.lit("x").alias("name")))
    joined = full_join(hot, hot_side, "key")
    assert "skew=true" in final_plan(joined)
    expected = hot.join(hot_side, "key", "full")
    assert joined.exceptAll(expected).count() == expected.exceptAll(joined).count() == 0


def test_sessions_of_a_hot_user(shuffled, hot):
    sessions = hot.select(
        F.col("key").alias("user_id"),
        F.col("v").alias("session_id"),
        *(F.lit("x").alias(n) for n in ("start_time", "end_time", "visit_length", "step_length")),
    )
    users = shuffled.range(5000).select(
        F.col("id").alias("user_id"), *(F.lit("x").alias(n) for n in ("age", "professional", "city", "sex"))
    )
    joined = with_users(sessions, users)
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


def test_actions_of_a_hot_session(shuffled, hot):
    actions = typed_by_name(
        hot.select(
            F.col("key").cast("string").alias("session_id"),
            F.col("v").alias("search_keyword"),
            F.pmod(F.xxhash64("v"), F.lit(50)).alias("click_category_id"),
        ),
        USER_VISIT_ACTION,
    )
    sessions = shuffled.range(3000).select(F.col("id").cast("string").alias("session_id"))
    chosen = rows_of(actions, sessions)
    assert "skew=true" in final_plan(category_counts(chosen.withColumn("order_category_ids", F.col("search_keyword"))))
    assert chosen.count() == hot.where("key < 3000").count()
