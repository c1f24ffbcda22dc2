"""Result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class TableSink:
    """Where result tables are appended.

    A file format writes `location/table`; format `jdbc` takes all connection
    options from the caller and writes the table of that name, `batchsize` rows
    per statement batch. File appends are committed as a whole; a JDBC
    partition whose task is lost after its commit may be written again, so JDBC
    tables need a key that refuses repeats.
    """

    location: str | None = None
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)

    def append(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        writer = df.write.mode("append").format(self.format).options(**self.options)
        if self.format == "jdbc":
            writer.option("dbtable", table).save()
        else:
            writer.partitionBy(*partition_by).save(f"{self.location}/{table}")

    def replace(self, df: DataFrame, table: str, task_id: int) -> None:
        """Write the rows of one task in place of those it has written before.

        Each task has a folder of its own; a JDBC table has none, so there rows are appended.
        """
        if self.format == "jdbc":
            self.append(df, table)
        else:
            writer = df.write.mode("overwrite").format(self.format).options(**self.options)
            writer.save(f"{self.location}/{table}/task_id={task_id}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.format == "jdbc":
            return reader.option("dbtable", table).load()
        return reader.load(f"{self.location}/{table}")
