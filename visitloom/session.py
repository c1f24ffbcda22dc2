"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, cores: int) -> int:
    """Partitions for a shuffle of this size: about 200 MB each, at least one per core."""
    return max(cores, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))


def build_session(
    app_name: str, master: str | None = None, partitions: int | None = None, **settings: str
) -> SparkSession:
    """A session with the settings the operators are written for.

    AQE merges small shuffle partitions, so `partitions` is an upper bound to be
    taken from `shuffle_partitions`; it also splits skewed join sides.
    """
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Without a stack trace per column expression plans are built twice as fast.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if partitions is not None:
        defaults["spark.sql.shuffle.partitions"] = str(partitions)
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under spark.checkpoint.dir, or under the warehouse where that is unset.

    Both are storage that the deployment has set up for driver and executors alike.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def through_storage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the scratch folder and read it back, which ends its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
