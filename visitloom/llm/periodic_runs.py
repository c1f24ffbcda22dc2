"""Periodic runs of words: a recompression grammar whose LCE queries extend candidates of a harmonic grid.

A run is a stretch of words with smallest period q, at least LEAST words and EXPONENT periods long, that no neighbouring
word extends. For each period p a grid of places is looked at, so wide that each run of period p holds one; over all
p these are n log n places. A place whose word comes again p words later is a candidate, and its stretch
ends where the words at both places and the words p later differ: the longest common extensions to either side.
They are read off a grammar of the words: blocks of equal symbols and pairs of symbols are replaced in turn by new symbols.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import map_pieces

LEAST, EXPONENT = 24, 3  # words and periods of the shortest run
# Words of the texts that share a grammar; a longer text has one of its own.
GRAMMAR_WORDS = 200_000
# Symbols that are left at the top of a grammar.
TOP = 8
_GRID_PLACES = 1 << 20
_WORDS_KEPT = 200_000

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class _WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _ends(starts: np.ndarray, n: int) -> np.ndarray:
    return np.append(starts[1:], n) - 1


class Grammar:
    """A run-length grammar of a sequence of numbers whose first and last numbers are found nowhere else in it.

    Nodes are numbered level by level, the sequence itself first. A node of the next level stands for a block of equal
    nodes, if the level has one; else for a pair, or for a single node. Two nodes of a level have the same symbol if,
    and only if, they stand for the same numbers by the same rules. What becomes a pair depends on its two symbols alone,
    so equal stretches become equal nodes but for a few at their ends.
    """

    def __init__(self, numbers: np.ndarray):
        symbols = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
        lengths = np.ones(len(symbols), np.int64)
        first_child = last_child = np.zeros(len(symbols), np.int64)
        alphabet, below, self.leaves = int(symbols.max()) + 1, 0, len(symbols)
        levels = []
        while True:
            n, places = len(symbols), np.arange(len(symbols))
            opens = np.ones(n, bool)
            opens[1:] = symbols[1:] != symbols[:-1]
            block = np.flatnonzero(opens)
            number = np.cumsum(opens) - 1
            right, left = _ends(block, n)[number] - places + 1, places - block[number] + 1
            top = n <= TOP
            if opens.all() and not top:
                opens = self._pair_starts(symbols, alphabet, len(levels))
            starts = np.flatnonzero(opens)
            ends = _ends(starts, n)
            closes = np.zeros(n, bool)
            closes[ends] = True
            above = below + n + np.cumsum(opens) - 1
            if top:
                opens, closes = np.zeros((2, n), bool)
            levels.append((symbols, lengths, above, opens, closes, right, left, first_child, last_child))
            if top:
                break
            # Single nodes keep their symbol, blocks and pairs get new ones.
            symbols, many, key = symbols.copy(), starts < ends, len(block) < n
            other = ends - starts + 1 if key else symbols[ends]
            pairs, new = np.unique(symbols[starts[many]] * (n + alphabet) + other[many], return_inverse=True)
            symbols = symbols[starts]
            symbols[many] = alphabet + new
            alphabet += len(pairs)
            sums = np.cumsum(lengths)
            lengths = sums[ends] - sums[starts] + lengths[starts]
            first_child, last_child = below + starts, below + ends
            below += n
        (self.symbol, self.length, self.above, self.opens, self.closes, self.right, self.left, self.first_child,
         self.last_child) = (np.concatenate(x) for x in zip(*levels))

    @staticmethod
    def _pair_starts(symbols: np.ndarray, alphabet: int, level: int) -> np.ndarray:
        """Where nodes of the next level start: a symbol of the left side and one of the right side after it are a pair."""
        sides = np.random.default_rng(level).integers(0, 2, (2, alphabet), np.int8)
        options = []
        for side in sides:
            change = np.diff(side[symbols])
            options += [change == 1, change == -1]
        joined = max(options, key=np.count_nonzero)
        return np.concatenate(([True], ~joined))

    def extensions(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many numbers from place a on equal those from place b on, to the right (step 1) or to the left (step -1).

        Two nodes that start (or end) above nodes with the same symbol are left for those; else, nodes with the same symbol
        are passed, as many as blocks of both still have; else their first (or last) children are compared.
        """
        edge, run, child = (
            (self.opens, self.right, self.first_child) if step > 0 else (self.closes, self.left, self.last_child)
        )
        found, live = np.zeros(len(a), np.int64), np.arange(len(a))
        while len(live):
            up = edge[a] & edge[b]
            above_a, above_b = np.where(up, self.above[a], a), np.where(up, self.above[b], b)
            up &= self.symbol[above_a] == self.symbol[above_b]
            same = self.symbol[a] == self.symbol[b]
            passed = np.where(same & ~up, np.minimum(run[a], run[b]), 0)
            found[live] += passed * self.length[a]
            going = same | (a >= self.leaves)
            next_a = np.where(up, above_a, np.where(same, a + step * passed, child[a]))
            next_b = np.where(up, above_b, np.where(same, b + step * passed, child[b]))
            a, b, live = next_a[going], next_b[going], live[going]
        return found


class RunFinder:
    """Runs of sequences of numbers, at least `least` numbers and `exponent` periods long."""

    def __init__(self, least: int = LEAST, exponent: int = EXPONENT):
        if exponent < 2 or least < 1:
            raise ValueError("a run has at least two periods and one word")
        self.least, self.exponent = least, exponent
        widths = self._width(np.arange(1, least + 2))
        # The places of a run that are equal to those a period later are at least so many; half of them lie on one side.
        self.half = int(widths.min()) // 2
        self._small_grid = lru_cache(32)(self._whole_grid)

    def _width(self, period: np.ndarray) -> np.ndarray:
        return np.maximum(self.least - period, (self.exponent - 1) * period)

    def _grid(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces of the grid of a sequence of n: (place, period)."""
        first, last = 1, n // self.exponent
        while first <= last:
            # A period has no more places than n / width(first); so many periods at a time.
            size = int(max(1, _GRID_PLACES * self._width(np.array([first]))[0] // n))
            periods = np.arange(first, min(last, first + size - 1) + 1)
            width = self._width(periods)
            counts = -(-(n - periods) // width)
            starts = np.cumsum(counts) - counts
            nth = np.arange(counts.sum()) - np.repeat(starts, counts)
            yield nth * np.repeat(width, counts), np.repeat(periods, counts)
            first = int(periods[-1]) + 1

    def _whole_grid(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """All pieces as one, for a sequence of some thousand numbers."""
        return tuple(np.concatenate(x) for x in zip(*self._grid(n)))

    def candidates(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, period) of the grid with `half` equal numbers on one side, which every run has at one place of its grid."""
        n = len(numbers)
        if n < max(self.least, self.exponent):
            return np.zeros((2, 0), np.int64)
        rounded = 1 << n.bit_length()
        pieces = [self._small_grid(rounded)] if rounded <= 1 << 14 else self._grid(n)
        found = [self._equal_places(numbers, *piece) for piece in pieces]
        return tuple(np.concatenate(x) for x in zip(*found))

    def _equal_places(self, numbers: np.ndarray, place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(numbers)
        inside = np.flatnonzero((place + period < n) & (period * self.exponent <= n))
        place, period = place[inside], period[inside]
        equal = np.flatnonzero(numbers[place] == numbers[place + period])
        place, period = place[equal], period[equal]
        sides = []
        for step in (1, -1):
            left = np.arange(len(place))
            for k in range(1, self.half + (step < 0)):
                at = place[left] + step * k
                left, at = (x[(at >= 0) & (at + period[left] < n)] for x in (left, at))
                left = left[numbers[at] == numbers[at + period[left]]]
            sides.append(left)
        either = np.union1d(*sides)
        return place[either], period[either]

    def find(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """For each sequence its runs as rows (start, length, period), by start, then period."""
        runs = [np.zeros((0, 3), np.int64)] * len(texts)
        held, words = [], 0
        for i, numbers in enumerate(texts):
            place, period = self.candidates(numbers)
            if len(place):
                held.append((i, place, period))
                words += len(numbers)
            if held and (words >= GRAMMAR_WORDS or i == len(texts) - 1):
                self._extended(texts, held, runs)
                held, words = [], 0
        if held:
            self._extended(texts, held, runs)
        return runs

    def _extended(self, texts: list[np.ndarray], held: list, runs: list[np.ndarray]) -> None:
        """The stretches of all candidates, on one grammar; each of the sequences stands between numbers of its own."""
        parts, offsets, at = [np.array([-1])], [], 1
        for k, (i, _, _) in enumerate(held):
            offsets.append(at)
            parts += [texts[i], np.array([-2 - k])]
            at += len(texts[i]) + 1
        grammar = Grammar(np.concatenate(parts))
        owner = np.repeat(np.arange(len(held)), [len(x[1]) for x in held])
        place, period = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
        a = place + np.array(offsets)[owner]
        ahead = grammar.extensions(a, a + period, 1)
        behind = grammar.extensions(a - 1, a + period - 1, -1)
        start, length = place - behind, behind + period + ahead
        long = np.flatnonzero((length >= self.least) & (length >= self.exponent * period))
        order = long[np.lexsort((period[long], length[long], start[long], owner[long]))]
        # Of one stretch the smallest period; others are its multiples.
        stretch = np.stack([owner, start, length])[:, order]
        order = order[np.append(True, (stretch[:, 1:] != stretch[:, :-1]).any(axis=0))] if len(order) else order
        order = order[np.lexsort((period[order], start[order], owner[order]))]
        rows = np.stack([start, length, period], axis=1)[order]
        bounds = np.searchsorted(owner[order], np.arange(len(held) + 1))
        for k, (i, _, _) in enumerate(held):
            runs[i] = rows[bounds[k] : bounds[k + 1]]


def _kept(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run repeats: all of a run after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def periodic_runs(
    documents: DataFrame, least: int = LEAST, exponent: int = EXPONENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row a document: doc_id, n_words, runs (start, length, period: words, from 0), collapsed.

    Words stand between blanks and the control characters 9 to 13, as they are written. runs are sorted by start, then period; they may overlap.
    collapsed is the text's words, joined by one blank, without those that a run holds after its first period.
    A null or empty text has no words, no runs and an empty collapsed text. Repeated rows each give a row, a null
    doc_id stays null. Other columns play no part; an empty table gives an empty result.
    """

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        finder, numbers = RunFinder(least, exponent), _WordNumbers()

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            if len(numbers) > _WORDS_KEPT:
                numbers.clear()
            words = [(x.as_py() or "").encode().split() for x in batch.column(1)]
            runs = finder.find([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words])
            sizes = np.array([len(w) for w in words], np.int64)
            collapsed = [b" ".join(_kept(w, r) if len(r) else w) for w, r in zip(words, runs)]
            rows = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            fields = pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])
            offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
            return pa.record_batch(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(offsets), fields),
                    pa.array(collapsed, pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

        return handle

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_pieces(rows, start, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")
