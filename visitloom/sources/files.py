"""JSON, text and in-program sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitloom.operators.observed import store_observed
from visitloom.session import scratch_path


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines; a field missing from a line is NULL.

    Without a schema Spark reads the data once more to infer it.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_people_lines(spark: SparkSession, path: str) -> DataFrame:
    """`name, age` lines as (name string, age int); an age that is no number is NULL."""
    parts = F.split("value", ",")
    return spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("name"),
        F.trim(F.get(parts, F.lit(1))).try_cast("int").alias("age"),
    )


def split_by_reason(df: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows without a `reason`, and the others as (line, reason); `df` is worked out once and stored under a folder for each kind."""
    path = scratch_path(df.sparkSession, name)
    df.withColumn("accepted", F.col("reason").isNull()).write.partitionBy("accepted").parquet(path)
    stored = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("accepted", T.BooleanType())]))
    rows = stored.parquet(path)
    good = rows.where("accepted").drop("line", "reason", "accepted")
    return good, rows.where("NOT accepted").select("line", "reason")


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """JSON lines as typed rows, and the lines that are not such rows as (line, reason), from one read.

    Reasons: `empty` (nothing but blanks), `not JSON`, `not an object`, `wrong type` (a field's value is none of its type). A field
    missing from a line is NULL, further fields are left out. Both frames together have a row for each line.
    """
    whole = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    parsed = lines.select("line", F.from_json("line", whole, options).alias("row"), F.try_parse_json("line").alias("any"))
    reason = (
        F.when(F.trim("line") == "", "empty")
        .when(F.col("any").isNull(), "not JSON")
        .when(~F.schema_of_variant("any").startswith("OBJECT"), "not an object")
        .when(F.col("row._broken").isNotNull() | F.col("row").isNull(), "wrong type")
    )
    rows = parsed.select("line", reason.alias("reason"), *(F.col(f"row.`{n}`").alias(n) for n in schema.names))
    return split_by_reason(rows, "json-lines")


def read_people_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """`name, age` lines as (name string, age int), and the lines that are none as (line, reason), from one read.

    Reasons: `too few values`, `too many values`, `no name`, `no number` (the age is none, or none of 32 bits).
    """
    parts = F.split("line", ",")
    name, age = F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1))).try_cast("int")
    reason = (
        F.when(F.size(parts) < 2, "too few values")
        .when(F.size(parts) > 2, "too many values")
        .when(name == "", "no name")
        .when(age.isNull(), "no number")
    )
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    rows = lines.select("line", reason.alias("reason"), F.get(parts, F.lit(0)).alias("name"), age.alias("age"))
    return split_by_reason(rows, "people-lines")


def json_columns(df: DataFrame, column: str) -> DataFrame:
    """`df` with a column for each field of the JSON objects in a text column, typed by what all of them hold.

    The texts are parsed once: the schema of all values is gathered while the parsed ones are stored. A text that is no JSON is NULL
    throughout; a field of several types gets their common one, or VARIANT. Fields are sorted by name; a field
    with the name of a column of `df` takes another.
    """
    names = {c.lower() for c in df.columns}
    parsed = next(n for n in (f"{column}_parsed{'_' * k}" for k in range(len(names) + 1)) if n.lower() not in names)
    stored, seen = store_observed(
        df.withColumn(parsed, F.try_parse_json(column)), "parsed-json", F.schema_of_variant_agg(F.try_parse_json(column)).alias("schema")
    )
    kind = seen["schema"]
    if not kind or not kind.startswith("OBJECT<"):
        return stored.drop(parsed)
    ddl = kind.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    fields = df.sparkSession.range(0).select(F.from_json(F.lit("{}"), ddl).alias("v")).schema["v"].dataType.fields
    columns = []
    for field in sorted(fields, key=lambda f: f.name):
        name = field.name
        while name.lower() in names:
            name += "_"
        names.add(name.lower())
        place = "$['{}']".format(field.name.replace("\\", "\\\\").replace("'", "\\'"))
        columns.append(F.try_variant_get(parsed, place, field.dataType.simpleString()).alias(name))
    return stored.select("*", *columns).drop(parsed)


def read_text_columns(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """Comma lines as text columns, named by a text such as `name age`.

    The first column is taken as it is, the others without surrounding spaces.
    """
    schema = T.StructType([T.StructField(name, T.StringType(), True) for name in columns.split(" ")])
    parts = F.split("value", ",")
    return spark.read.text(path).select(
        *(
            (F.get(parts, F.lit(i)) if i == 0 else F.trim(F.get(parts, F.lit(i))))
            .cast(field.dataType)
            .alias(field.name)
            for i, field in enumerate(schema.fields)
        )
    )


def local_rows(spark: SparkSession, rows: Sequence, schema, slices: int | None = None) -> DataFrame:
    """A collection held by the program as a DataFrame, in `slices` partitions if given."""
    df = spark.createDataFrame(rows, schema)
    return df if slices is None else df.repartition(slices)
