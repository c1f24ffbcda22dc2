"""An FM-index over a sequence of numbers: a wavelet matrix of its Burrows-Wheeler transform, and sampled
suffix positions. All steps work on arrays of many patterns or rows at a time."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 16


class Bits:
    """A bit vector that tells the number of ones before a place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, place: np.ndarray) -> np.ndarray:
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def at(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, values: np.ndarray, size: int):
        """`size`: all values are below it."""
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(max(1, (size - 1).bit_length()))):
            bits = (values >> shift & 1).astype(bool)
            self.levels.append((shift, Bits(bits), len(values) - int(bits.sum())))
            values = np.concatenate([values[~bits], values[bits]])
        self.start = self._down(np.arange(size), np.zeros(size, np.int64))

    def _down(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(place)
            place = np.where(value >> shift & 1, zeros + ones, place - ones)
        return place

    def rank(self, value: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each value occurs before its place."""
        return self._down(value, place) - self.start[value]

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at the places, and how often each occurs before."""
        value = np.zeros(len(place), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.at(place), bits.ones(place)
            value |= one.astype(np.int64) << shift
            place = np.where(one, zeros + ones, place - ones)
        return value, place - self.start[value]


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order; in each round the ordered length doubles, and only suffixes that
    are still equal to a neighbour are sorted again."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, np.int64)

    def ranked(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ranks the suffixes at `places` of the order, whose sorted keys are given; which are not alone."""
        first = np.append(True, keys[1:] != keys[:-1])
        rank[order[places]] = places[first][np.cumsum(first) - 1]
        return ~(first & np.append(first[1:], True))

    places = np.arange(n)
    places = places[ranked(places, values[order])]
    length = 1
    while len(places):
        suffixes = order[places]
        following = suffixes + length
        key = rank[suffixes] * (n + 1)
        inside = following < n
        key[inside] += rank[following[inside]] + 1
        by_key = np.argsort(key, kind="stable")
        order[places] = suffixes[by_key]
        places = places[ranked(places, key[by_key])]
        length *= 2
    return order


class FMIndex:
    def __init__(self, values: np.ndarray, size: int):
        """`values`: numbers from 0 to size - 1."""
        # An end that is below all values and occurs once keeps the order of suffixes under steps back.
        values, size = np.append(values.astype(np.int64) + 1, 0), size + 1
        suffixes = suffix_array(values)
        self.n = len(values)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=size))])[:size]
        self.transform = WaveletMatrix(values[suffixes - 1], size)
        sampled = suffixes % SAMPLE_EVERY == 0
        self.sampled, self.positions = Bits(sampled), suffixes[sampled]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows first..end of the suffixes that begin with each pattern (a row of the array)."""
        first, end = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        alive = np.arange(len(patterns))
        for column in reversed(range(patterns.shape[1])):
            value = patterns[alive, column] + 1
            lower = self.before[value] + self.transform.rank(value, first[alive])
            upper = self.before[value] + self.transform.rank(value, end[alive])
            first[alive], end[alive] = lower, upper
            alive = alive[lower < upper]
            if not len(alive):
                break
        return first, np.maximum(first, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of these rows start: walks back to the next sampled one."""
        found = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            known = self.sampled.at(rows)
            found[open_[known]] = self.positions[self.sampled.ones(rows[known])] + steps
            open_, rows = open_[~known], rows[~known]
            value, rank = self.transform.access(rows)
            rows = self.before[value] + rank
            steps += 1
        return found
