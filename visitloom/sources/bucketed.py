"""The action log as a table bucketed and sorted by session, so that work on sessions needs no shuffle of actions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.session import scratch_path


def save_bucketed(actions: DataFrame, name: str, buckets: int, path: str | None = None, key: str = "session_id") -> DataFrame:
    """`actions` saved as the catalog table `name`, in `buckets` files by a hash of `key`, each sorted by it; the table.

    Rows are dealt out once, here, so that a bucket is one file. A session with very many actions makes its bucket as large; the
    number of buckets is for the caller to choose: tables of one number of buckets are joined bucket by bucket.
    """
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    writer = actions.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(name)
    return actions.sparkSession.table(name)


def bucketed(actions: DataFrame, buckets: int, key: str = "session_id") -> DataFrame:
    """`actions` as a bucketed table of a name of its own, in the scratch folder."""
    name = f"bucketed_{uuid.uuid4().hex}"
    return save_bucketed(actions, name, buckets, scratch_path(actions.sparkSession, name), key)


def catalog_partitions(actions: DataFrame, name: str, path: str | None = None, by: str = "date") -> DataFrame:
    """`actions` saved as the catalog table `name`, a folder for each value of `by`; the table, its columns as in `actions`."""
    writer = actions.repartition(by, F.pmod(F.xxhash64("session_id"), F.lit(8))).write.mode("overwrite").partitionBy(by)
    if path is not None:
        writer = writer.option("path", path)
    writer.format("parquet").saveAsTable(name)
    return actions.sparkSession.table(name).select(*actions.columns)


def drop_table(spark: SparkSession, name: str) -> None:
    """Forget a table; of one with a path of its own the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
