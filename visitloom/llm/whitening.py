"""Whitening of embeddings, each distinct vector once.

Vectors are put on a grid of whole numbers; equal ones form a group. The covariance is that of the groups, each weighed
by one or by its rows: sums are exact, centred products are summed as matrix products of batches. Each group is whitened once,
and rows find their group again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import in_python, map_pieces, share_code
from visitloom.session import through_storage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Groups with a larger share of the rows than one in so many; there are fewer of them than that.
HOT = 1000
# Numbers of the grid have to be smaller, so that their differences are exact.
_LARGEST = 2**53


def on_grid(embeddings: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x, h1, h2): x has floor(64 * c) + 1000000 for each entry c; h1 and h2 are hashes of x.

    Rows are left out whose vector is null or empty, or has an entry that is null, not finite, or 2^53 or more on the grid.
    Vectors have to be of one length: of several lengths that of most rows is kept, of equally many the greatest.
    """
    rows = embeddings.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"))
    fits = F.expr(f"size(s) > 0 AND forall(s, v -> v IS NOT NULL AND abs(v) < {_LARGEST - SHIFT})")
    finite = F.expr("forall(e, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")
    kept = rows.where(finite).select("vec_id", F.expr(f"transform(e, c -> floor({SCALE} * double(c)))").alias("s"))
    kept = kept.where(fits).select("vec_id", F.expr(f"transform(s, v -> v + {SHIFT}L)").alias("x"))
    sizes = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    kept = kept.where(F.size("x") == (size[0]["d"] if size else 0))
    return kept.withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit(SCALE), F.col("x"))})


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), -1)


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of the matrices whose rows (row, numbers) the tasks give, by row; the result is `size` wide and high at most."""

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        # Sorted, so that the sum does not depend on which task ends first.
        stacked = np.stack(rows["numbers"].to_numpy())
        return pd.DataFrame({"row": rows["row"][:1], "numbers": [np.sort(stacked, axis=0).sum(axis=0)]})

    result = np.zeros((size, size))
    for row in parts.groupBy("row").applyInPandas(total, "row int, numbers array<double>").toLocalIterator():
        result[row["row"]] = row["numbers"]
    return result


def sums(groups: DataFrame) -> tuple[int, list[int]]:
    """Weight of all groups (x, weight), and the weighed sum of each entry, both exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            x, weight = _matrix(batch.column(0), np.int64), batch.column(1).to_numpy()
            if not len(x):
                continue
            if int(np.abs(x).max()) * int(weight.sum()) < 2**62:
                part = (weight @ x).astype(object)
            else:
                part = weight.astype(object) @ x.astype(object)
            part = np.append(part, int(weight.sum()))
            total = part if total is None else total + part
        if total is not None:
            places = np.arange(len(total), dtype=np.int32)
            yield pa.record_batch([pa.array(places), pa.array(list(map(str, total)))], ["place", "part"])

    share_code(groups.sparkSession)
    parts = in_python(groups.select("x", "weight"), run, "place int, part string")
    rows = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    totals = [int(r["total"]) for r in sorted(rows, key=lambda r: r["place"])]
    return (totals[-1], totals[:-1]) if totals else (0, [])


def _centred(x: np.ndarray, n: int, totals: list[int]) -> np.ndarray:
    """x less its mean; the difference n * x - S is exact before it is rounded."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 2**62:
        return (n * x - np.array(totals, np.int64)) / n
    return ((n * x.astype(object) - np.array(totals, object)) / n).astype(np.float64)


def covariance(groups: DataFrame, n: int, totals: list[int]) -> np.ndarray:
    """Weighed covariance of x of the groups (x, weight), divisor n; centred before it is multiplied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(totals), len(totals)))
        for batch in batches:
            if batch.num_rows:
                x = _centred(_matrix(batch.column(0), np.int64), n, totals)
                total += (x * batch.column(1).to_numpy()[:, None]).T @ x
        rows = pa.array(np.arange(len(totals), dtype=np.int32))
        numbers = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), len(totals)).cast(pa.list_(pa.float64()))
        yield pa.record_batch([rows, numbers], ["row", "numbers"])

    parts = in_python(groups.select("x", "weight"), run, "row int, numbers array<double>")
    return _summed(parts, len(totals)) / n


def components(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as columns; those that rounding cannot tell from 0 are left out."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = values > 1e-11 * max(values.max(initial=0.0), 0.0)
    return values[real], vectors[:, real]


def _deviations(x: np.ndarray, n: int, totals: list[int]) -> list[int | None]:
    """Sum of (n * x - S)^2 of each row, exact; None where it is no long."""
    reach = n * (int(np.abs(x).max(initial=0)) + 1)
    if reach < 2**62:
        apart = n * x - np.array(totals, np.int64)
        most = int(np.abs(apart).max(initial=0))
        if most * most * max(1, x.shape[1]) < 2**63:
            return (apart * apart).sum(axis=1).tolist()
    exact = ((n * x.astype(object) - np.array(totals, object)) ** 2).sum(axis=1)
    return [int(v) if v < 2**63 else None for v in exact]


def _whitened(groups: DataFrame, n: int, totals: list[int], values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """(h1, h2, copies, weight, deviation, z) of each group (x, h1, h2, copies, weight)."""
    # One row or thousands, a matrix of d rows and at most COMPONENTS columns: it goes with the task.
    turn = vectors / np.sqrt(values)

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = _matrix(batch.column(0), np.int64)
            z = _centred(x, n, totals) @ turn
            deviation = pa.array(_deviations(x, n, totals), pa.int64())
            columns = [*batch.columns[1:], deviation, pa.array(list(z), pa.list_(pa.float64()))]
            return pa.record_batch(columns, ["h1", "h2", "copies", "weight", "deviation", "z"])

        return handle

    schema = "h1 bigint, h2 bigint, copies bigint, weight bigint, deviation bigint, z array<double>"
    return map_pieces(groups.select("x", "h1", "h2", "copies", "weight"), start, schema)


def _identity_error(whitened: DataFrame, size: int, n: int) -> float:
    """The largest absolute entry of the weighed covariance of z, less the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            if batch.num_rows:
                z, weight = _matrix(batch.column(0), np.float64), batch.column(1).to_numpy()
                with_one = np.column_stack([z, np.ones(len(z))])
                total += (with_one * weight[:, None]).T @ with_one
        numbers = pa.array(list(total), pa.list_(pa.float64()))
        yield pa.record_batch([pa.array(np.arange(size + 1, dtype=np.int32)), numbers], ["row", "numbers"])

    parts = in_python(whitened.select("z", "weight"), run, "row int, numbers array<double>")
    total = _summed(parts, size + 1) / n
    mean = total[:size, size]
    return float(np.abs(total[:size, :size] - np.outer(mean, mean) - np.eye(size)).max())


def whiten(
    embeddings: DataFrame,
    most: int = COMPONENTS,
    weights: str = "one",
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row for each row of `on_grid` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    The fit is over the distinct vectors x, each weighed by 1 (`weights` "one") or by its rows ("count"); n is their weight and S
    the weighed sum of x. deviation is the sum over entries of (n * x - S)^2, exact, or null if it is no long. whitened
    is x - S / n along a unit eigenvector of the covariance of x (divisor n), over the root of its eigenvalue; components are
    numbered from 1 by falling eigenvalue. explained is the eigenvalue's share of all variance, identity_error the largest
    absolute entry of whitened's covariance less the identity. There are at most `most` components, and none for an eigenvalue
    that is 0 in double precision: fewer distinct vectors than entries give fewer components, a single one gives no rows.
    Repeated rows each give their rows; a null vec_id stays null. What on_grid leaves out gives none. Other
    columns play no part; an empty table gives an empty result.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights are 'one' or 'count'")
    spark = embeddings.sparkSession
    rows = on_grid(embeddings, vec_id, embedding)
    weight = F.lit(1).cast("bigint") if weights == "one" else F.col("copies")
    groups = rows.groupBy("x", "h1", "h2").agg(F.count(F.lit(1)).alias("copies")).withColumn("weight", weight)
    groups = through_storage(groups, "vector-groups")
    n, totals = sums(groups)
    values, vectors = np.zeros(0), np.zeros((0, 0))
    if n:
        matrix = covariance(groups, n, totals)
        values, vectors = components(matrix, most)
    if not len(values):
        schema = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, {schema}")
    whitened = through_storage(_whitened(groups, n, totals, values, vectors), "whitened-vectors")
    error, explained = _identity_error(whitened, len(values), n), values / np.trace(matrix)

    # A group with many rows is sent to all tasks, of which there are fewer than HOT; other groups are joined by their hashes.
    every = whitened.agg(F.sum("copies")).first()[0]
    hot = whitened.where(F.col("copies") * HOT > every).select("h1", "h2", "deviation", "z")
    cold = whitened.where(F.col("copies") * HOT <= every).select("h1", "h2", "deviation", "z")
    named = rows.select("vec_id", "h1", "h2")
    rest = named.join(F.broadcast(hot.select("h1", "h2")), ["h1", "h2"], "left_anti")
    found = named.join(F.broadcast(hot), ["h1", "h2"]).unionByName(rest.join(cold.hint("merge"), ["h1", "h2"]))
    shares = F.array(*(F.lit(float(v)) for v in explained))
    return found.select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
