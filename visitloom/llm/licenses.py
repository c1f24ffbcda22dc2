"""License scan: phrases in the text, and an exact set-similarity join of text blocks with templates.

A block is BLOCK_WORDS consecutive words, a new one starting every BLOCK_STEP words. A template is found in a
block if the share of its distinct words that the block holds reaches a threshold. Words are ordered by the
number of documents of the whole table that hold them, rarest first; a block is compared with a template only
if it holds one of the template's first words in that order (prefix filter), enough words (length filter), and
enough words after the one they met at (positional filter). The templates are a short fixed list, so the join
is done beside the blocks, without a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitloom.llm.batches import in_python, map_pieces, plain_words

BLOCK_WORDS = 96
BLOCK_STEP = 48
THRESHOLD = 0.95
# Bound of what is broadcast.
MAX_TEMPLATE_WORDS = 100_000

# Phrases, and statements by which works are put under public licenses.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, blocks array<struct<first_word: long, label: string, containment: double>>"
)


class TemplateIndex:
    """The first words of each template in the order of frequency, by word."""

    def __init__(self, templates: Iterable[tuple[str, frozenset[bytes]]], order: dict[bytes, int], threshold: float):
        self.templates = list(templates)
        self.order = order
        self.least = [math.ceil(round(threshold * len(words), 9)) for _, words in self.templates]
        self.first: dict[bytes, list[tuple[int, int]]] = {}
        for i, (_, words) in enumerate(self.templates):
            for place, word in enumerate(sorted(words, key=order.get)[: len(words) - self.least[i] + 1]):
                self.first.setdefault(word, []).append((i, place))
        self.probes = frozenset(self.first)

    def matches(self, block: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, words in common) of the templates found in a block."""
        held = sorted(self.order.keys() & set(block), key=self.order.get)
        met: dict[int, int] = {}
        pruned: set[int] = set()
        for at, word in enumerate(held):
            for i, place in self.first.get(word, ()):
                size, least = len(self.templates[i][1]), self.least[i]
                if len(held) < least or i in pruned:
                    continue
                if met.get(i, 0) + min(size - place, len(held) - at) >= least:
                    met[i] = met.get(i, 0) + 1
                else:
                    pruned.add(i)
        for i in met.keys() - pruned:
            common = sum(word in self.templates[i][1] for word in held)
            if common >= self.least[i]:
                yield i, common


def _word_documents(documents: DataFrame, text: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """How many documents of the whole table hold each word of the templates."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(vocabulary & set(plain_words(value.as_py())))
        yield pa.record_batch(
            [pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
        )

    counted = in_python(documents.select(text), count, "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return {row["word"].encode(): row["n"] for row in counted.collect()}  # no more rows than template words


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    found, at = [], -1
    for _ in range(words.count(phrase[0])):
        at = words.index(phrase[0], at + 1)
        if words[at : at + len(phrase)] == phrase:
            found.append(at)
    return found


def license_scan(
    documents: DataFrame,
    templates: Iterable[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row a document, with its license phrases and the blocks in which templates are found.

    n_words: its words; n_base: places of phrases; first_word, last_word: the smallest and largest start of such
    a place, words counted from 0, null without one; base_labels: labels of its phrases; labels: also those of its
    templates (both distinct, sorted, comma-joined, empty without any); score: 1 with a phrase, else the largest
    containment found, else 0; blocks: (first_word, label, containment) of every block and template that meet.
    A null text counts as empty. Repeated rows and rows with null ids each give a row; other columns of
    `documents` play no part; an empty table gives an empty result.
    """
    sets = [(label, frozenset(plain_words(statement))) for label, statement in templates]
    sets = [(label, words) for label, words in sets if words]
    vocabulary = frozenset().union(*(words for _, words in sets))
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words")
    counts = _word_documents(documents, text, vocabulary)
    ranked = sorted(vocabulary, key=lambda word: (counts.get(word, 0), word))
    index = TemplateIndex(sets, {word: i for i, word in enumerate(ranked)}, threshold)
    shared = documents.sparkSession.sparkContext.broadcast(index)
    base = [(plain_words(phrase), label) for phrase, label in phrases.items()]

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        index = shared.value

        def row(words: list[bytes]) -> tuple:
            held = set(words)
            starts, labels = [], set()
            for phrase, label in base:
                if held.issuperset(phrase) and (found := _places(words, phrase)):
                    starts += found
                    labels.add(label)
            blocks = []
            if held & index.probes:
                for first in range(0, len(words), BLOCK_STEP):
                    for i, common in sorted(index.matches(words[first : first + BLOCK_WORDS])):
                        label, template = index.templates[i]
                        blocks.append({"first_word": first, "label": label, "containment": common / len(template)})
            return (
                len(words),
                len(starts),
                min(starts, default=None),
                max(starts, default=None),
                ",".join(sorted(labels)),
                ",".join(sorted(labels | {b["label"] for b in blocks})),
                1.0 if starts else max((b["containment"] for b in blocks), default=0.0),
                blocks,
            )

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = [row(plain_words(value.as_py())) for value in batch.column(1)]
            block = pa.struct([("first_word", pa.int64()), ("label", pa.string()), ("containment", pa.float64())])
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(block)]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            return pa.record_batch([batch.column(0), *columns], [x.split()[0] for x in SCHEMA.split(", ")[:8]] + ["blocks"])

        return handle

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_pieces(rows, start, SCHEMA)
