"""Benchmark decontamination: windows of benchmark items are looked up in an FM-index of each training shard.

A shard is what a task has read, up to SHARD_WORDS words. Words that occur in no benchmark item can be in no
window; they only part the runs between them, and runs shorter than the shortest window are not indexed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from visitloom.llm.batches import PIECE_ROWS, in_python, plain_words
from visitloom.llm.fm_index import FMIndex

WINDOW = 10
SHARD_WORDS = 1_000_000
# A larger benchmark is broadcast in several blocks, one after the other, of about this many characters.
BLOCK_CHARS = 8_000_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, n_words long, spans array<struct<first: long, end: long>>, item_ids array<string>"


class Windows:
    """The distinct windows of a block of items, by length, as rows of word numbers from 1."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in plain_words(text)]
            size = min(window, len(words))
            for first in range(len(words) - size + 1 if words else 0):
                ids = owners.setdefault(tuple(words[first : first + size]), set())
                if item_id is not None:
                    ids.add(item_id)
        self.owners: list[set[str]] = []
        self.by_length: list[tuple[int, int, np.ndarray]] = []  # length, number of the first window, windows
        for length in sorted({len(w) for w in owners}):
            same = [w for w in owners if len(w) == length]
            self.by_length.append((length, len(self.owners), np.array(same, np.int64)))
            self.owners += [owners[w] for w in same]

    def find(self, shard: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, set[str]]]:
        """For each hit document of a shard, given as word numbers (0: in no window): its number, first words and
        ends of the occurrences, items."""
        if not self.by_length:
            return
        shortest = self.by_length[0][0]
        text = np.concatenate([x for doc in shard for x in (doc, _GAP)]) if shard else _GAP
        starts = np.cumsum([0] + [len(doc) + 1 for doc in shard])
        inside = np.append(False, text > 0)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        if len(edges) % 2:
            edges = np.append(edges, len(text))
        run_first, run_end = edges[::2], edges[1::2]
        long_enough = run_end - run_first >= shortest
        run_first, run_end = run_first[long_enough], run_end[long_enough]
        if not len(run_first):
            return
        # The runs, one after the other, each followed by the 0 that ends it.
        sizes = run_end - run_first + 1
        run_at = np.cumsum(sizes) - sizes
        index = FMIndex(text[np.repeat(run_first - run_at, sizes) + np.arange(sizes.sum())], len(self.numbers) + 1)
        hits = []
        for length, number, windows in self.by_length:
            first, end = index.search(windows)
            occurring = np.flatnonzero(end > first)
            counts = (end - first)[occurring]
            rows = np.repeat(first[occurring] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            at = index.locate(rows)
            run = np.searchsorted(run_at, at, "right") - 1
            place = run_first[run] + at - run_at[run]
            hits.append(np.stack([place, place + length, number + np.repeat(occurring, counts)]))
        place, end, window = np.concatenate(hits, axis=1)
        doc = np.searchsorted(starts, place, "right") - 1
        by_doc = np.argsort(doc, kind="stable")
        for part in np.split(by_doc, np.flatnonzero(np.diff(doc[by_doc])) + 1):
            if len(part):
                number = int(doc[part[0]])
                items = set().union(*(self.owners[w] for w in np.unique(window[part])))
                yield number, place[part] - starts[number], end[part] - starts[number], items


_GAP = np.zeros(1, np.int32)


def merge_spans(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans, as spans that do not touch, in order."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(end[order])
    opens = np.append(True, first[1:] > reach[:-1])
    return list(zip(first[opens].tolist(), reach[np.append(opens[1:], True)].tolist()))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words first..end - 1 of each span, nor what stands between them."""
    places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    kept, at = [], 0
    for first, end in spans:
        kept.append(text[at : places[first][0]])
        at = places[end - 1][1]
    return "".join([*kept, text[at:]])


def _benchmark_blocks(benchmark: DataFrame, window: int, item_id: str, text: str, block_chars: int) -> list:
    """Broadcast windows of the distinct items, in blocks of about `block_chars` characters, or one longer item."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).distinct()
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-chars // block_chars)
    shared = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = part.toArrow().to_pydict()  # bounded by block_chars
        shared.append(items.sparkSession.sparkContext.broadcast(Windows(list(zip(rows["item_id"], rows["text"])), window)))
    return shared


def _by_shard(documents: DataFrame, blocks: list, text_at: int, result, schema) -> DataFrame:
    """Rows of `documents` through `result(batch, words, spans, items)`, shard by shard."""

    def handle(shard: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [[plain_words(value.as_py()) for value in batch.column(text_at)] for batch in shard]
        words = [w for part in words for w in part]
        spans: list[list[np.ndarray]] = [[] for _ in words]
        items: list[set[str]] = [set() for _ in words]
        for block in blocks:
            windows = block.value
            numbers = [np.fromiter(map(windows.numbers.get, w, repeat(0)), np.int32, len(w)) for w in words]
            for doc, first, end, found in windows.find(numbers):
                spans[doc].append(np.stack([first, end]))
                items[doc] |= found
        merged = [merge_spans(*np.concatenate(x, axis=1)) if x else [] for x in spans]
        at = 0
        for batch in shard:
            part = slice(at, at + batch.num_rows)
            yield result(batch, [len(w) for w in words[part]], merged[part], [sorted(x) for x in items[part]])
            at += batch.num_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, PIECE_ROWS):
                piece = batch.slice(first, PIECE_ROWS)
                shard.append(piece)
                held += piece.column(text_at).nbytes
                if held >= SHARD_WORDS * 6:
                    yield from handle(shard)
                    shard, held = [], 0
        if shard:
            yield from handle(shard)

    return in_python(documents, run, schema)


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row a document: n_words, the merged spans of words inside occurrences of windows, and item_ids.

    A window is `window` consecutive words of an item, or all words of a shorter one. A span goes from word `first`
    to before word `end`, words counted from 0. item_ids, as sorted texts, are of the items that have an occurring
    window; an item without id marks words but is not listed. Null texts have no words. Repeated rows of documents
    each give a row, repeated items count once. Other columns play no part; without documents the result is
    empty, without items nothing is hit.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    blocks = _benchmark_blocks(benchmark, window, item_id, item_text, block_chars)
    span = pa.struct([("first", pa.int64()), ("end", pa.int64())])

    def result(batch: pa.RecordBatch, n_words, spans, items) -> pa.RecordBatch:
        spans = [[{"first": first, "end": end} for first, end in x] for x in spans]
        columns = [
            batch.column(0),
            pa.array(n_words, pa.int64()),
            pa.array(spans, pa.list_(span)),
            pa.array(items, pa.list_(pa.string())),
        ]
        return pa.record_batch(columns, ["doc_id", "n_words", "spans", "item_ids"])

    return _by_shard(rows, blocks, 1, result, SCHEMA)


def remove_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """`documents` with the spans of `find_contamination` cut out of their texts.

    Documents without an occurrence are unchanged; those of which no word is left go. All columns stay.
    """
    at = documents.columns.index(text)
    blocks = _benchmark_blocks(benchmark, window, item_id, item_text, block_chars)

    def result(batch: pa.RecordBatch, n_words, spans, items) -> pa.RecordBatch:
        column = batch.column(at)
        texts = [cut_words(v.as_py(), x) if x else v.as_py() for v, x in zip(column, spans)]
        kept = [not x or sum(end - first for first, end in x) < n for n, x in zip(n_words, spans)]
        columns = list(batch.columns)
        columns[at] = pa.array(texts, column.type)
        return pa.record_batch(columns, batch.schema.names).filter(pa.array(kept, pa.bool_()))

    nullable = StructType(
        [StructField(f.name, StringType()) if f.name == text else f for f in documents.schema.fields]
    )
    return _by_shard(documents, blocks, at, result, nullable)
