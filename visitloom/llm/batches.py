"""Small helpers of the operators that run Python on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Rows handled at a time, so that a task holds a small part of its input.
PIECE_ROWS = 512

# Bytes of a word: digits, a-z and all that is not ASCII; everything else parts words.
_PLAIN = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b > 127 else 32 for b in range(256))


def share_code(spark: SparkSession) -> SparkSession:
    """Python workers started from now on find this package where the driver found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark


def in_python(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """`df` through a function of an iterator of Arrow batches."""
    share_code(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_pieces(
    df: DataFrame, start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str | StructType
) -> DataFrame:
    """Rows of `df` through a function of small Arrow batches; `start` makes that function once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = start()
        for batch in batches:
            for first in range(0, batch.num_rows, PIECE_ROWS):
                result = handle(batch.slice(first, PIECE_ROWS))
                if result is not None:
                    yield result

    return in_python(df, run, schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For actions inside: Python is given at most so many rows at a time, as the rows are large."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def plain_words(text: str | None) -> list[bytes]:
    """Words of digits, letters and non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return plain_bytes(text).split()


def plain_bytes(text: str | None) -> bytes:
    """The text with A-Z lower-cased and every byte between words made a blank."""
    return (text or "").encode().lower().translate(_PLAIN)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` has not, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
