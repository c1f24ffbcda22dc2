"""Toxicity: nearest labelled examples by exact TF-IDF cosine.

Terms are all words of the examples. Document frequencies are of all documents; a word that labelled toxic texts hold
more often than others weighs more, none is left out. A word of no example adds to the length of a text. Examples with
the same vector are one entry with its numbers of texts and of toxic ones. Entries are held in an inverted index, and
many texts are compared with it at once. The words of few and of most entries are added up first; the others are bounded
by blocks of entries, which know the largest weight of each such word, and by the length of each entry's part of such
words. Only entries whose bound reaches the nearest ones found are added up in full. The nearest entries vote by distance,
and votes are calibrated by those that each example gets from the others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import in_python, map_pieces, plain_bytes, plain_words

# Bounds of what the model is made of: distinct examples, and bytes of their texts (one text more at most).
EXAMPLES = 8_000
EXAMPLE_BYTES = 32 << 20
# A word weighs 1 + CLASS_WEIGHT * sqrt(log-likelihood ratio above LEAST_RATIO) times as much if toxic texts favour it.
CLASS_WEIGHT = 3.0
LEAST_RATIO = 8.0
NEIGHBOURS = 15
BLOCK = 16
# Terms of more than one in so many entries are bounded before they are added up; those of more than one in DENSE are
# added up for all entries and many texts at once, as a product of matrices.
COMMON, DENSE = 32, 16
TEXTS = 256  # of such a product
# Bytes of texts whose words are counted at once (one text more at most), and postings that are added up at once.
GROUP_BYTES = 2 << 20
POSTINGS = 1 << 16
BOUNDED = 16  # texts whose entries are bounded at once
LIKELY = 4  # times the nearest entries: those of the largest bounds, which are added up first
THRESHOLD = 0.3
EVIDENCE = 3


@dataclass(frozen=True)
class Vectors:
    """Unit vectors: the terms of each in order and their weights, one vector after another."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def some(self, first: int, end: int) -> Vectors:
        starts = self.starts[first : end + 1]
        inside = slice(starts[0], starts[-1])
        return Vectors(starts - starts[0], self.terms[inside], self.weights[inside])

    def dense(self, places: np.ndarray, columns: int) -> np.ndarray:
        """Vectors x columns: the weights of the terms whose place, the number of a column, is not below 0."""
        given, held = np.zeros((len(self), columns)), places >= 0
        given[self.owners[held], places[held]] = self.weights[held]
        return given

    @property
    def owners(self) -> np.ndarray:
        """The number of the vector of each term."""
        return np.repeat(np.arange(len(self)), np.diff(self.starts))


@dataclass(frozen=True)
class Entries:
    """Distinct unit vectors of examples: (first doc_id, texts, toxic texts), and the index."""

    ids: np.ndarray
    texts: np.ndarray
    toxic: np.ndarray
    starts: np.ndarray  # by term: where its postings start
    numbers: np.ndarray  # postings: entries in order, weights
    values: np.ndarray
    dense: np.ndarray  # by term: its row in dense_values, or -1
    dense_values: np.ndarray  # terms of more than one in DENSE entries x entries
    common: np.ndarray  # by term: its number among the other common ones, or -1
    block_most: np.ndarray  # common terms x blocks
    common_lengths: np.ndarray  # blocks x entries of each: the length of an entry's part of common terms
    common_starts: np.ndarray  # by entry: where that part starts
    common_terms: np.ndarray
    common_values: np.ndarray

    @property
    def postings(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By term: entries in order, weights."""
        return list(zip(np.split(self.numbers, self.starts[1:-1]), np.split(self.values, self.starts[1:-1])))

    def _add_postings(self, scores: np.ndarray, owners: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> None:
        """Adds to the row of each owner, which are in order, what its terms give to each entry."""
        first, width = self.starts[terms], scores.shape[1]
        lengths = self.starts[terms + 1] - first
        ends = np.cumsum(lengths)
        at = 0
        while at < len(owners):
            # Rows of about POSTINGS postings, one row more at most.
            last = min(np.searchsorted(ends, ends[at] - lengths[at] + POSTINGS), len(owners) - 1)
            end = np.searchsorted(owners, owners[last], "right")
            some, low, high = slice(at, end), owners[at], owners[last] + 1
            held = _ranges(first[some], lengths[some])
            place = np.repeat((owners[some] - low) * width, lengths[some]) + self.numbers.take(held)
            given = np.repeat(weights[some], lengths[some]) * self.values.take(held)
            scores[low:high] += np.bincount(place, given, (high - low) * width).reshape(-1, width)
            at = end

    def _common_part(self, given: np.ndarray, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """What the common terms of some rows of `given` give to an entry each."""
        lengths = self.common_starts[entries + 1] - self.common_starts[entries]
        held = _ranges(self.common_starts[entries], lengths)
        weights = given.ravel().take(np.repeat(rows * given.shape[1], lengths) + self.common_terms.take(held))
        return np.bincount(np.repeat(np.arange(len(rows)), lengths), weights * self.common_values.take(held), len(rows))

    def _bounded(
        self, scores: np.ndarray, blocks: np.ndarray, given: np.ndarray, postings: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, entries that can be among their k nearest, the scores of these, and whether a row is one of them.

        `scores`: what the other terms give; `blocks`: bounds of what the common terms give to the entries of each block;
        `given`: the weights of common terms; `postings`: how many these have. Rows with less of them are left out.
        """
        n, width = scores.shape
        lengths = np.linalg.norm(given, axis=1)[:, None, None] * self.common_lengths
        bounds = np.minimum(blocks[:, :, None], lengths).reshape(n, -1)[:, :width] + scores
        likely = np.argpartition(bounds, -min(LIKELY * k, width), axis=1)[:, -min(LIKELY * k, width) :]
        rows, entries = np.repeat(np.arange(n), likely.shape[1]), likely.ravel()
        sums = scores[rows, entries] + self._common_part(given, rows, entries)
        kth = np.partition(sums.reshape(likely.shape), -k, axis=1)[:, -k]
        rows, entries = np.nonzero(bounds >= _within_rounding(kth)[:, None])
        # The entries left are added up one by one, or all by the postings if that is less work.
        of_entries = np.bincount(rows, self.common_starts[entries + 1] - self.common_starts[entries], n)
        bounded = of_entries <= postings
        inside = bounded[rows]
        rows, entries = rows[inside], entries[inside]
        return rows, entries, scores[rows, entries] + self._common_part(given, rows, entries), bounded

    def nearest_of_all(self, vectors: Vectors, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The k entries of the largest cosine above 0 to each vector, ties to the earlier entry: numbers and cosines."""
        for first in range(0, len(vectors), TEXTS):
            some = vectors.some(first, min(first + TEXTS, len(vectors)))
            if len(self.ids):
                yield from self._nearest_of_some(some, k)
            else:
                yield from [(np.zeros(0, np.int64), np.zeros(0))] * len(some)

    def _nearest_of_some(self, vectors: Vectors, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        owners, terms, weights = vectors.owners, vectors.terms, vectors.weights
        dense, common = self.dense[terms], self.common[terms]
        scores = vectors.dense(dense, len(self.dense_values)) @ self.dense_values
        rare, held = (dense < 0) & (common < 0), common >= 0
        self._add_postings(scores, owners[rare], terms[rare], weights[rare])
        given = vectors.dense(common, len(self.block_most))
        blocks = given @ self.block_most
        owners, terms, weights = owners[held], terms[held], weights[held]
        postings = np.bincount(owners, self.starts[terms + 1] - self.starts[terms], len(vectors))
        for first in range(0, len(vectors), BOUNDED):
            inside = slice(first, first + BOUNDED)
            some = scores[inside]
            found, bounded = [], np.zeros(len(some), bool)
            if len(self.ids) > k:
                *near, bounded = self._bounded(some, blocks[inside], given[inside], postings[inside], k)
                found.append(near)
            if not bounded.all():
                own = np.flatnonzero((owners >= first) & (owners < first + len(some)))
                own = own[~bounded[owners[own] - first]]
                self._add_postings(some, owners[own] - first, terms[own], weights[own])
                others = np.flatnonzero(~bounded)
                sums = some[others]
                least = np.partition(sums, -k, axis=1)[:, -k] if len(self.ids) > k else np.zeros(len(others))
                rows, entries = np.nonzero(sums >= _within_rounding(least)[:, None])
                found.append((others[rows], entries, sums[rows, entries]))
            rows, entries, cosines = (np.concatenate(x) for x in zip(*found))
            above = np.flatnonzero(cosines > 0)
            # Equal cosines differ by rounding, as their sums are of other orders.
            order = above[np.lexsort((entries[above], -cosines[above].round(12), rows[above]))]
            ends = np.searchsorted(rows[order], np.arange(len(some) + 1))
            for low, high in zip(ends[:-1].tolist(), ends[1:].tolist()):
                best = order[low : min(high, low + k)]
                yield entries[best], cosines[best]

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """`nearest_of_all` of one vector."""
        (found,) = self.nearest_of_all(Vectors(np.array([0, len(terms)]), terms, weights), k)
        return found


def _within_rounding(sums: np.ndarray) -> np.ndarray:
    """Bounds and cosines are float sums: what reaches this may be equal to the sums."""
    return sums * (1 - 1e-9) - 1e-12


def _ranges(first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of some ranges, one range after another."""
    ends = np.cumsum(lengths)
    return np.repeat(first - ends + lengths, lengths) + np.arange(lengths.sum())


@dataclass(frozen=True)
class ToxicityModel:
    ids: dict[bytes, int]
    weights: np.ndarray  # of the terms, and last that of a word which no example has
    entries: Entries
    rate: float  # of toxic examples
    steps: np.ndarray  # votes and what they stand for
    values: np.ndarray

    def vectors(self, texts: list[bytes]) -> Vectors:
        """The known words of some texts, as `plain_bytes` gives them, all words being of length 1."""
        owners, terms, counts = _term_counts(texts, self.ids)
        unknown = len(self.ids)
        given = (1 + np.log(counts)) * self.weights[np.minimum(terms, unknown)]
        lengths = np.sqrt(np.bincount(owners, given**2, len(texts)))
        known = terms < unknown
        owners, terms = owners[known], terms[known]
        starts = np.append(0, np.cumsum(np.bincount(owners, minlength=len(texts))))
        return Vectors(starts, terms, given[known] / lengths[owners])

    def voted(
        self,
        nearest: tuple[np.ndarray, np.ndarray],
        without: int | None = None,
    ) -> tuple[float, list[tuple[int, float, float]]]:
        """The weighted share of toxic texts among the nearest entries, and the evidence.

        `without`: the label of an example whose own part in its entry is left out.
        """
        entries = self.entries
        found, cosines = nearest
        texts, toxic = entries.texts[found].astype(float), entries.toxic[found].astype(float)
        if without is not None:
            own = cosines > 1 - 1e-9
            if own.any():
                texts[own.argmax()] -= 1
                toxic[own.argmax()] -= without
        near = np.log2(1 + texts) / (0.05 + np.maximum(0, 1 - cosines))
        share = (near @ (toxic / np.maximum(texts, 1)) + self.rate) / (near.sum() + 1)
        seen = zip(entries.ids[found], cosines, entries.toxic[found] / entries.texts[found])
        return float(share), [(int(i), float(c), float(t)) for i, c, t in list(seen)[:EVIDENCE]]

    def calibrated(self, vote: float) -> float:
        return float(np.clip(np.interp(vote, self.steps, self.values), 0, 1)) if len(self.steps) else self.rate


def _unit(ids: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Known ids in order and their weights; ids of -1 are unknown words, which count for the length only."""
    given = (1 + np.log(counts)) * weights[ids] if len(ids) else np.zeros(0)
    order = np.argsort(ids, kind="stable")[np.count_nonzero(ids < 0) :]
    return ids[order], given[order] / np.linalg.norm(given) if len(order) else np.zeros(0)


def _groups(texts: list[str | None]) -> Iterator[list[bytes]]:
    """`plain_bytes` of the texts in order, in lists of about GROUP_BYTES; a longer text is in a list that ends with it."""
    group, size = [], 0
    for text in texts:
        group.append(plain_bytes(text))
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _term_counts(texts: list[bytes], ids: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, term, how often) of each distinct word of each text, in order; words between blanks.

    Words that are not in `ids` get numbers of their own from len(ids) on.
    """
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = np.append(False, joined != 32)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    places = np.append(0, np.cumsum(lengths)).astype(np.int32)
    buffers = [None, pa.py_buffer(places), pa.py_buffer(joined[inside[1:]])]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), buffers).dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    terms = np.fromiter(map(ids.get, words, repeat(-1)), np.int64, len(words))
    terms = np.where(terms < 0, len(ids) + np.arange(len(words)), terms)
    bits = (len(ids) + len(words)).bit_length()
    ends = np.cumsum([len(text) + 1 for text in texts])
    keys = np.searchsorted(ends, starts, "right") << bits | terms[coded.indices.to_numpy()]
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first] >> bits, keys[first] & ((1 << bits) - 1), np.diff(np.append(first, len(keys)))


def _ratio(a, p, b, n):
    """Log-likelihood ratio of a term in a of p toxic and b of n other texts."""

    def part(observed, expected):
        return np.where(observed > 0, observed * np.log(np.maximum(observed, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    with_, total = a + b, p + n
    return 2 * (
        part(a, with_ * p / total)
        + part(b, with_ * n / total)
        + part(p - a, (total - with_) * p / total)
        + part(n - b, (total - with_) * n / total)
    )


def _document_frequencies(documents: DataFrame, text: str, ids: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many of all documents each term is, and how many documents there are."""
    shared = documents.sparkSession.sparkContext.broadcast(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = shared.value, 0
        held = np.zeros(len(ids), np.int64)
        for batch in batches:
            for group in _groups(batch.column(0).to_pylist()):
                terms = _term_counts(group, ids)[1]
                held += np.bincount(terms[terms < len(ids)], minlength=len(ids))
            rows += batch.num_rows
        at = np.flatnonzero(held)
        yield pa.record_batch([pa.array(np.append(at, len(ids))), pa.array(np.append(held[at], rows))], ["id", "n"])

    found = np.zeros(len(ids) + 1, np.int64)
    counted = in_python(documents.select(text), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = counted.toArrow()  # no more rows than terms, and one
    shared.destroy()  # the driver has little memory
    found[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return found[:-1], int(found[-1])


def _numbered(words: pa.ChunkedArray) -> tuple[dict[bytes, int], np.ndarray]:
    """The distinct words of lists of words, numbered in order, and the number of each word of each list."""
    seen, parts = {}, [np.zeros(0, np.int32)]
    # Some lists at a time: as many words at once would take several times the memory of what they become.
    for first in range(0, len(words), TEXTS):
        coded = words.slice(first, TEXTS).combine_chunks().flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        numbers = np.fromiter((seen.setdefault(word, len(seen)) for word in distinct), np.int32, len(distinct))
        parts.append(numbers[coded.indices.to_numpy()])
    terms, rank, ordered = np.concatenate(parts), np.zeros(len(seen), np.int32), sorted(seen)
    rank[np.fromiter(map(seen.__getitem__, ordered), np.int32, len(seen))] = np.arange(len(seen), dtype=np.int32)
    del parts, seen
    return {word: i for i, word in enumerate(ordered)}, rank[terms]


def _build_entries(
    vectors: list[tuple[int, int, np.ndarray, np.ndarray]], terms: int, texts: list[int] | None = None
) -> Entries:
    """The index of examples (doc_id, toxic, term ids, weights); `texts`: how many each stands for, if not one."""
    grouped: dict[tuple, list] = {}
    for (doc_id, toxic, ids, weights), n in zip(vectors, texts or [1] * len(vectors)):
        key = xxhash.xxh3_128_digest(ids.astype(np.int64).tobytes() + np.round(weights, 12).tobytes())
        entry = grouped.setdefault(key, [doc_id, 0, 0, ids, weights, key])
        entry[0] = min(entry[0], doc_id)
        entry[1] += n
        entry[2] += toxic
    # Entries of the same heaviest terms stand together, so that bounds of blocks are close.
    order = sorted(grouped.values(), key=lambda e: (e[3][np.argsort(-e[4], kind="stable")[:16]].tolist(), e[5]))
    held = np.zeros(terms, np.int64)
    for _, _, _, ids, _, _ in order:
        held[ids] += 1
    dense, common = np.full((2, terms), -1, np.int32)
    of_most = np.flatnonzero(held > len(order) / DENSE)
    dense[of_most] = np.arange(len(of_most))
    of_many = np.flatnonzero((held > len(order) / COMMON) & (dense < 0))
    common[of_many] = np.arange(len(of_many))
    starts = np.append(0, np.cumsum(held))
    blocks = -(-max(len(order), 1) // BLOCK)
    # A row has a posting in each DENSE numbers at least.
    dense_values, most = np.zeros((len(of_most), len(order))), np.zeros((len(of_many), blocks))
    common_lengths, common_starts = np.zeros(blocks * BLOCK), np.zeros(len(order) + 1, np.int64)
    common_terms, common_values = np.zeros(held[of_many].sum(), np.int32), np.zeros(held[of_many].sum())
    # The driver has little memory: what is made is filled one entry after another, and no copy of it is made.
    numbers, values, free = np.zeros(starts[-1], np.int32), np.zeros(starts[-1]), starts[:-1].copy()
    for i, (_, _, _, ids, weights, _) in enumerate(order):
        places = free[ids]
        numbers[places], values[places] = i, weights
        free[ids] += 1
        in_most, in_many = dense[ids] >= 0, common[ids] >= 0
        dense_values[dense[ids[in_most]], i] = weights[in_most]
        ids, weights = common[ids[in_many]], weights[in_many]
        most[ids, i // BLOCK] = np.maximum(most[ids, i // BLOCK], weights)
        common_lengths[i] = np.linalg.norm(weights)
        common_starts[i + 1] = common_starts[i] + len(ids)
        own = slice(common_starts[i], common_starts[i + 1])
        common_terms[own], common_values[own] = ids, weights
    return Entries(
        np.array([e[0] for e in order], np.int64),
        np.array([e[1] for e in order], np.int64),
        np.array([e[2] for e in order], np.int64),
        starts,
        numbers,
        values,
        dense,
        dense_values,
        common,
        most,
        common_lengths.reshape(blocks, BLOCK),
        common_starts,
        common_terms,
        common_values,
    )


def _rising(
    votes: np.ndarray, labels: np.ndarray, texts: np.ndarray, bins: int = 100
) -> tuple[np.ndarray, np.ndarray]:
    """Mean votes and shares of toxic texts of up to `bins` bins, merged until the shares rise; `texts` of each vote."""
    place = np.minimum((votes * bins).astype(int), bins - 1)
    pools: list[list[float]] = []
    for b in np.unique(place):
        inside = place == b
        n = texts[inside]
        pools.append([votes[inside] @ n, labels[inside] @ n, float(n.sum())])
        while len(pools) > 1 and pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return np.array([v / n for v, _, n in pools]), np.array([t / n for _, t, n in pools])


def _sampled(examples: DataFrame, labels: DataFrame | None, max_examples: int, max_bytes: int) -> DataFrame:
    """(doc_id, text, texts, toxic) of each distinct text of a sample: its smallest doc_id, its examples, the toxic ones.

    Drawn are at most `max_examples` pairs (doc_id, text), by the smallest hashes of both, and none after the one with
    which their distinct texts reach `max_bytes`. Copies of a text under other ids are drawn apart. Examples have a label,
    toxic, or get it from `labels` by doc_id. Only hashes are shuffled for that, and then the texts that are drawn.
    """
    hashed = examples.withColumn("drawn", F.xxhash64("doc_id", "text"))
    sizes = hashed.select("*", F.xxhash64("text").alias("of"), F.octet_length("text").alias("size")).drop("text")
    sizes = sizes if labels is None else sizes.join(labels, "doc_id")
    sizes = sizes.where("toxic IS NOT NULL").groupBy("drawn")
    sizes = sizes.agg(F.min("of").alias("of"), F.min("size").alias("size"), F.max("toxic").alias("toxic"))
    picked, held, size = [], set(), 0
    for row in sizes.orderBy("drawn").limit(max_examples).collect():
        if size >= max_bytes:
            break
        if row["of"] not in held:
            held.add(row["of"])
            size += row["size"]
        picked.append((row["drawn"], row["toxic"]))
    # At most max_examples rows of two numbers.
    chosen = examples.sparkSession.createDataFrame(picked, "drawn long, toxic int")
    texts = hashed.select("doc_id", "text", "drawn").join(F.broadcast(chosen), "drawn")
    pairs = texts.groupBy("doc_id", "text").agg(F.max("toxic").alias("toxic"))
    return pairs.groupBy("text").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("texts"), F.sum("toxic").alias("toxic")
    )


def fit_toxicity(
    documents: DataFrame,
    examples: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    max_examples: int = EXAMPLES,
    max_bytes: int = EXAMPLE_BYTES,
    labels: DataFrame | None = None,
) -> ToxicityModel:
    """A model of the examples (doc_id, text, toxic 0 or 1), with the frequencies of all `documents`.

    With `labels` (doc_id, toxic), one row a doc_id, they are the examples' labels, and examples need no column for them.
    Repeated rows of one doc_id and text are one example, toxic if one of them is. Of more than `max_examples`, or than
    `max_bytes` of distinct texts, those of the smallest hashes of doc_id and text are taken. Examples without a label
    are left out. Without examples, and without toxic ones, every score is 0.
    """
    number, label = F.col(doc_id).cast("long").alias("doc_id"), F.col(toxic).cast("int").alias("toxic")
    given = examples.select(number, F.coalesce(F.col(text), F.lit("")).alias("text"), *([label] if labels is None else []))
    labels = labels if labels is None else labels.select(number, label)

    def count() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [Counter(plain_words(x.as_py())) for x in batch.column(1)]
            return pa.record_batch(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int32())),
                ],
                ["doc_id", "texts", "toxic", "words", "counts"],
            )

        return handle

    schema = "doc_id long, texts long, toxic long, words array<binary>, counts array<int>"
    sample = _sampled(given, labels, max_examples, max_bytes).select("doc_id", "text", "texts", "toxic")
    rows = map_pieces(sample, count, schema).toArrow()  # distinct texts, bounded by the sample
    doc_ids = pc.fill_null(rows.column("doc_id"), 0).to_pylist()
    texts, toxic_texts = rows.column("texts").to_numpy(), rows.column("toxic").to_numpy()
    sizes = pc.list_value_length(rows.column("words")).to_numpy()
    ids, terms = _numbered(rows.column("words"))
    numbers = pc.list_flatten(rows.column("counts")).to_numpy()
    del rows
    pa.default_memory_pool().release_unused()

    p, n = int(toxic_texts.sum()), int((texts - toxic_texts).sum())
    a = np.bincount(terms, np.repeat(toxic_texts, sizes), minlength=len(ids))
    b = np.bincount(terms, np.repeat(texts - toxic_texts, sizes), minlength=len(ids))
    favoured = np.where(a * n > b * p, np.maximum(_ratio(a, p, b, n) - LEAST_RATIO, 0), 0) if p and n else np.zeros(len(ids))
    frequencies, documents_in_all = _document_frequencies(documents, text, ids)
    weights = (np.log((documents_in_all + 1) / (frequencies + 1)) + 1) * (1 + CLASS_WEIGHT * np.sqrt(favoured))
    # A word of no example is weighed as one of a single document.
    weights = np.append(weights, np.log((documents_in_all + 1) / 2) + 1)

    ends = np.cumsum(sizes)
    # All vectors lie in two arrays; small ones of their own would leave gaps in the driver's memory.
    places, values = [slice(e - m, e) for e, m in zip(ends.tolist(), sizes.tolist())], np.zeros(len(terms))
    for place in places:
        terms[place], values[place] = _unit(terms[place], numbers[place], weights)
    vectors = [(terms[place], values[place]) for place in places]
    del numbers, a, b, favoured
    held = [i for i, m in enumerate(sizes.tolist()) if m]
    entries = _build_entries(
        [(doc_ids[i], int(toxic_texts[i]), *vectors[i]) for i in held], len(ids), [int(texts[i]) for i in held]
    )
    model = ToxicityModel(ids, weights, entries, p / max(p + n, 1), np.zeros(0), np.zeros(0))
    if not vectors:
        return model
    found = entries.nearest_of_all(Vectors(np.append(0, ends), terms, values), NEIGHBOURS)
    votes = [
        (model.voted(nearest, label)[0], label, of_label)
        for nearest, n, t in zip(found, texts.tolist(), toxic_texts.tolist())
        for label, of_label in ((0, n - t), (1, t))
        if of_label
    ]
    return replace(model, **dict(zip(("steps", "values"), _rising(*np.array(votes, float).T))))


def score_toxicity(documents: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: doc_id, score (0 to 1), predicted (1 from THRESHOLD on), evidence.

    evidence has the nearest entries: the smallest doc_id of their examples, the cosine, and their share of toxic
    texts. A null or empty text has no neighbours and gets the calibrated share of all examples. Repeated rows and rows with
    null ids each give a row; other columns play no part; an empty table gives an empty result.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = shared.value

        def scored(texts: list[str | None]) -> Iterator[tuple[float, list[dict]]]:
            for group in _groups(texts):
                for nearest in model.entries.nearest_of_all(model.vectors(group), NEIGHBOURS):
                    vote, evidence = model.voted(nearest)
                    yield model.calibrated(vote), [{"doc_id": i, "similarity": c, "toxic": t} for i, c, t in evidence]

        entry = pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("toxic", pa.float64())])

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = list(scored(batch.column(1).to_pylist()))
            return pa.record_batch(
                [
                    batch.column(0),
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array([int(s >= THRESHOLD) for s, _ in found], pa.int32()),
                    pa.array([e for _, e in found], pa.list_(entry)),
                ],
                ["doc_id", "score", "predicted", "evidence"],
            )

        return handle

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    evidence = "array<struct<doc_id: long, similarity: double, toxic: double>>"
    return map_pieces(rows, start, f"doc_id long, score double, predicted int, evidence {evidence}")
