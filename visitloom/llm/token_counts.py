"""Token counts by a map-side lookup in two tiers.

A text is cut into pre-tokens, and its count is the sum of their lengths in tokens. The first tier is a
table of frequent pre-tokens, broadcast; what it lacks is encoded once and kept in a cache of the worker.
No pre-token is ever shuffled but those of the bounded sample that the table is made of. The table and
the caches decide on speed only: the counts are the library's own.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import in_python, map_pieces

# Bounds of the broadcast table (at most TABLE_ROWS * LONGEST characters) and of a worker's cache.
TABLE_ROWS = 50_000
LONGEST = 64
CACHE_ROWS = 400_000
# Documents, at about this number, whose pre-tokens are counted for the table.
SAMPLE_ROWS = 20_000

_SPACE, _LETTER, _NUMBER = r"\t-\r \x85\xa0", r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: The pre-token pattern of byte-level vocabularies for texts of characters up to U+00FF.
_LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)


class PieceLengths(dict):
    """Tokens of a pre-token; those not in the table are encoded when first asked for."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        steps = spec.get("pre_tokenizer") or {}
        # Whether pre-tokens are cut by the fixed pattern and nothing is done to a text before.
        self.by_pattern = (
            steps.get("type") == "ByteLevel"
            and steps.get("use_regex", True)
            and not steps.get("add_prefix_space")
            and spec.get("normalizer") is None
        )
        self.table: dict[str, int] = {}

    def start_from(self, table: dict[str, int]) -> None:
        if table is not self.table:
            self.table = table
            self.clear()
            self.update(table)

    def __missing__(self, piece: str) -> int:
        n = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= LONGEST:
            if len(self) >= CACHE_ROWS + len(self.table):
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n

    def pieces(self, text: str) -> list[str] | None:
        """Pre-tokens of a text; None if it has to be encoded as a whole."""
        if not self.by_pattern or any(special in text for special in self.specials):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            # Only the library knows its classes of the other characters.
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
            return [text[first:end] for _, (first, end) in found]
        return _LATIN.findall(text)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = self.pieces(text)
        if pieces is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return sum(map(self.__getitem__, pieces))


@cache
def _lengths(path: str) -> PieceLengths:
    """One for each worker process, so that its cache outlives a task."""
    return PieceLengths(path)


def frequent_pieces(
    documents: DataFrame, tokenizer: str, text: str = "text", sample_rows: int = SAMPLE_ROWS, rows: int = TABLE_ROWS
) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a sample of about `sample_rows` documents.

    The sample is taken by a hash of the text; at most `rows` pre-tokens of at most LONGEST characters return.
    """
    total = max(documents.count(), 1)
    part = F.pmod(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), F.lit(1_000_000)) / 1_000_000
    sample = documents.select(F.col(text).alias("text")).where(part < sample_rows / total)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, seen = _lengths(tokenizer), Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                seen.update(x for x in lengths.pieces(value or "") or () if len(x) <= LONGEST)
        common = seen.most_common(2 * rows)
        yield pa.record_batch([[x for x, _ in common], [n for _, n in common]], ["piece", "n"])

    counted = in_python(sample, count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "piece").limit(rows).select("piece")

    def measure() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        lengths = _lengths(tokenizer)
        return lambda batch: pa.record_batch(
            [batch.column(0), pa.array([lengths[x] for x in batch.column(0).to_pylist()], pa.int64())], ["piece", "n"]
        )

    table = map_pieces(top, measure, "piece string, n long").toArrow().to_pydict()
    return dict(zip(table["piece"], table["n"]))


def token_counts(
    documents: DataFrame,
    tokenizer: str,
    limit: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row a document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `tokenizer` is the place of a tokenizer file of the tokenizers library. Counts are without begin, end and
    other added tokens; special strings inside a text count as the library takes them by default; nothing is cut
    or padded. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows, also of one doc_id, and null ids
    each give a row. Other columns of `documents` play no part. An empty table gives an empty result.
    """
    table = documents.sparkSession.sparkContext.broadcast(frequent_pieces(documents, tokenizer, text, sample_rows))

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        lengths = _lengths(tokenizer)
        lengths.start_from(table.value)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            tokens = [lengths.count(x) for x in texts]
            return pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len((x or "").encode()) for x in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return handle

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_pieces(rows, start, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
