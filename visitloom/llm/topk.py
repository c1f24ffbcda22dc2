"""Exact top-k search by inner product in a bit-sliced index.

Vectors of integers are packed, up to BLOCK_ROWS of what a task reads, into blocks that hold, for each dimension and
each binary digit, a bitmap of the rows that have it set. For a query, the bitmaps are added with bitwise full adders into
the bitmaps of the scores' digits; the best rows are then found from the most significant digit downward, and of rows
that are equal at the boundary those of the smallest ids are taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitloom.llm.batches import arrow_rows, in_python
from visitloom.session import through_storage

BLOCK_ROWS = 16_384
# Queries are broadcast so many at a time, each block of them for one pass over the index.
QUERY_ROWS = 8_192
SCALE = 1024


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, q): floor(SCALE * x) of each component. Rows without id, or with a null vector or a component that is
    null or not finite, are left out."""
    finite = f"forall({embedding}, x -> x IS NOT NULL AND abs(CAST(x AS double)) < double('infinity'))"
    rows = vectors.where(f"{vec_id} IS NOT NULL AND {embedding} IS NOT NULL AND {finite}")
    values = F.expr(f"transform({embedding}, x -> CAST(floor({SCALE} * CAST(x AS double)) AS bigint)) AS q")
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), values)


def _packed(rows: np.ndarray) -> np.ndarray:
    """Bitmaps (words of 64 rows) of the rows of a 0/1 array."""
    words = -(-rows.shape[-1] // 64)
    out = np.zeros((*rows.shape[:-1], words * 8), np.uint8)
    packed = np.packbits(rows, axis=-1, bitorder="little")
    out[..., : packed.shape[-1]] = packed
    return out.view(np.uint64)


class SlicedBlock:
    """The bit-sliced index of some vectors of one dimension."""

    def __init__(self, ids: np.ndarray, least: np.ndarray, slices: np.ndarray):
        self.ids, self.least, self.slices = ids, least, slices  # slices: dimension x digit x words
        self.all_rows = _packed(np.ones(len(ids), np.uint8))

    @classmethod
    def build(cls, ids: np.ndarray, values: np.ndarray) -> SlicedBlock:
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], values[order]
        least = values.min(axis=0) if values.size else np.zeros(values.shape[1], np.int64)
        above = (values - least).T
        digits = int(above.max()).bit_length() if above.size else 0
        shifts = np.arange(digits)[None, :, None]
        return cls(ids, least, _packed((above[:, None, :] >> shifts & 1).astype(np.uint8)))

    def sums(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the digits of each row's score, and the number to add to all scores."""
        dimensions, digits, words = self.slices.shape
        weights = np.abs(query)
        # Digits of a negative weight count from the largest value downward: their bitmaps are inverted.
        slices = np.where((query < 0)[:, None, None], ~self.slices, self.slices)
        places = int(weights.max()).bit_length() if dimensions else 0
        chosen = [np.flatnonzero(weights >> j & 1) for j in range(places)]
        planes: list[np.ndarray] = []
        carries = np.zeros((0, words), np.uint64)
        place = 0
        while place < places + digits or len(carries):
            parts = [carries] + [
                slices[chosen[j], place - j] for j in range(places) if 0 <= place - j < digits and len(chosen[j])
            ]
            rows, carried = np.concatenate(parts), []
            while len(rows) > 2:
                n = len(rows) // 3
                a, b, c = rows[:n], rows[n : 2 * n], rows[2 * n : 3 * n]
                either = a ^ b
                carried.append(a & b | c & either)
                rows = np.concatenate([either ^ c, rows[3 * n :]])
            if len(rows) == 2:
                carried.append(rows[:1] & rows[1:])
                rows = rows[:1] ^ rows[1:]
            planes.append(rows[0] if len(rows) else np.zeros(words, np.uint64))
            carries = np.concatenate(carried) if carried else np.zeros((0, words), np.uint64)
            place += 1
        base = sum(int(q) * int(m) for q, m in zip(query, self.least))
        base -= sum(-int(q) for q in query if q < 0) * ((1 << digits) - 1)
        return planes, base

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the k best rows but those of the query's id."""
        first, end = np.searchsorted(self.ids, [query_id, query_id + 1])
        open_ = self.all_rows.copy()
        if end > first:
            own = np.zeros(len(self.ids), np.uint8)
            own[first:end] = 1
            open_ &= ~_packed(own)
        planes, base = self.sums(query)
        taken, count = np.zeros_like(open_), 0
        for plane in reversed(planes):
            higher = open_ & plane
            n = int(np.bitwise_count(higher).sum())
            if count + n > k:
                open_ = higher
            else:
                taken, count = taken | higher, count + n
                open_ = open_ & ~plane
                if count == k:
                    break
        rows, equal = self._rows(taken), self._rows(open_)
        rows = np.concatenate([rows, equal[: k - len(rows)]])
        digits = [(plane[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).tolist() for plane in planes]
        scores = [base + sum(digit[i] << place for place, digit in enumerate(digits)) for i in range(len(rows))]
        return self.ids[rows], scores

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def build_index(vectors: DataFrame) -> DataFrame:
    """The stored index of rows (vec_id, q): one row a block. Nothing is shuffled: a task packs what it reads."""

    def pack(ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        block = SlicedBlock.build(ids, values)
        columns = [values.shape[1], block.slices.shape[1], *(x.tobytes() for x in (block.ids, block.least, block.slices))]
        return pa.record_batch([[x] for x in columns], schema=_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            lengths = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == size))
                ids, values = held.pop(size, (np.zeros(0, np.int64), np.zeros((0, size), np.int64)))
                ids = np.concatenate([ids, part.column(0).to_numpy()])
                values = np.concatenate([values, part.column(1).flatten().to_numpy().reshape(len(part), size)])
                while len(ids) >= BLOCK_ROWS:
                    yield pack(ids[:BLOCK_ROWS], values[:BLOCK_ROWS])
                    ids, values = ids[BLOCK_ROWS:], values[BLOCK_ROWS:]
                if len(ids):
                    held[size] = (ids, values)
        for ids, values in held.values():
            yield pack(ids, values)

    schema = "dimensions int, digits int, ids binary, least binary, slices binary"
    return through_storage(in_python(vectors, run, schema), "bit-slices")


_INDEX = pa.schema(
    [("dimensions", pa.int32()), ("digits", pa.int32()), ("ids", pa.binary()), ("least", pa.binary()), ("slices", pa.binary())]
)
_FOUND_SCHEMA = "query_id long, query long, vec_id long, score long"
_FOUND = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def top_k(index: DataFrame, queries: DataFrame, k: int = 10, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best vectors of `index` for each row (vec_id, q) of `queries`.

    A query is compared with vectors of its number of components, but for those of its own id; ties go to the smaller
    vec_id. With fewer vectors there are fewer rows. Repeated queries count once; repeated vectors each have a rank. Scores
    must fit a long. Without queries or vectors the result is empty.
    """
    spark = index.sparkSession
    queries = queries.select("vec_id", "q").distinct()
    rounds = max(1, -(-queries.count() // query_rows))
    found = []
    for number in range(rounds):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == number).toArrow()  # about query_rows
        given = [(i, np.array(q, np.int64)) for i, q in zip(rows["vec_id"].to_pylist(), rows["q"].to_pylist())]
        shared = spark.sparkContext.broadcast(given)
        with arrow_rows(spark, 1):
            found.append(through_storage(in_python(index, _search(shared, k), _FOUND_SCHEMA), "best"))
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(shared, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dimensions = row["dimensions"]
                ids = np.frombuffer(row["ids"], np.int64)
                slices = np.frombuffer(row["slices"], np.uint64).reshape(dimensions, row["digits"], -(-len(ids) // 64))
                block = SlicedBlock(ids, np.frombuffer(row["least"], np.int64), slices)
                columns: list[list] = [[], [], [], []]
                for number, (query_id, query) in enumerate(shared.value):
                    if len(query) == dimensions:
                        vec_ids, scores = block.best(query_id, query, k)
                        columns[0] += [query_id] * len(scores)
                        columns[1] += [number] * len(scores)
                        columns[2] += vec_ids.tolist()
                        columns[3] += scores
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_FOUND)

    return run
