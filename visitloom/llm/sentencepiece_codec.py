"""SentencePiece encoding and decoding with the tokenizers library.

The model file is a protocol buffer; it is parsed here, and its normaliser, space marker, pieces with their scores
and byte fallback are rebuilt as a tokenizer of the tokenizers library, which encodes batches in several threads. Its ids
are the result; each is compared with the sentencepiece library's own, which takes its place where the two differ.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from visitloom.llm.batches import map_pieces

MARKER = "▁"
THREADS = 2
CACHE_WORDS = 500_000
# One of so many texts, drawn by a hash of the text, is also encoded and decoded as a whole and compared.
WHOLE = 64
_WORDS = re.compile(f"{MARKER}+[^{MARKER}]*|[^{MARKER}]+")
# Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _fields(buffer: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = buffer[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(buffer):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield key >> 3, buffer[at : at + size]
        at += size


@dataclass(frozen=True)
class PieceModel:
    pieces: list[tuple[str, float, int]]  # text, score, kind
    kind: int
    unknown: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    remove_extra_spaces: bool
    escape_spaces: bool


def parse_model(data: bytes) -> PieceModel:
    pieces, trainer, normaliser = [], {}, {}
    for field, value in _fields(data):
        if field == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normaliser = dict(_fields(value))
    unknown = next((i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN), 0)
    return PieceModel(
        pieces,
        trainer.get(3, UNIGRAM),
        unknown,
        bool(trainer.get(35, 0)),
        normaliser.get(2, b""),
        bool(normaliser.get(3, 1)),
        bool(normaliser.get(4, 1)),
        bool(normaliser.get(5, 1)),
    )


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """All pairs of pieces that make a piece, best score first; of equal scores those that grow the longest left part."""
    known = {text: score for text, score, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    found = [
        (-score, -i, text[:i], text[i:])
        for text, score in known.items()
        for i in range(1, len(text))
        if text[:i] in known and text[i:] in known
    ]
    return [(left, right) for _, _, left, right in sorted(found)]


def build_tokenizer(model: PieceModel) -> Tokenizer:
    """The model as a tokenizer of the tokenizers library."""
    if model.kind == BPE:
        vocabulary = {text: i for i, (text, _, _) in enumerate(model.pieces)}
        backend = models.BPE(
            vocabulary,
            _merges(model),
            unk_token=model.pieces[model.unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
            cache_capacity=50_000,
        )
    elif model.kind == UNIGRAM:
        scored = [(text, score) for text, score, _ in model.pieces]
        backend = models.Unigram(scored, model.unknown, model.byte_fallback)
    else:
        raise ValueError(f"a model of kind {model.kind}")
    tokenizer = Tokenizer(backend)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_extra_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARKER if model.escape_spaces else " "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARKER))
    tokenizer.normalizer = normalizers.Sequence(steps)
    # Where no piece goes on past a marker that follows other characters, words can be encoded one by one.
    if not any(MARKER in text.lstrip(MARKER) for text, _, _ in model.pieces):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARKER}+[^{MARKER}]*"), "isolated")
    strip = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    fallback = [decoders.ByteFallback()] if model.byte_fallback else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARKER, " "), *fallback, decoders.Fuse(), *strip])
    return tokenizer


class Codec:
    """Encodes and decodes with the tokenizers library.

    Where no piece crosses words, each distinct word is encoded, compared with sentencepiece and decoded once, and kept,
    CACHE_WORDS at most; what holds for all words of a text then holds for the text, which is tested on one of WHOLE texts.
    Other models work on whole texts.
    """

    def __init__(self, path: str, threads: int = THREADS):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        with open(path, "rb") as file:
            data = file.read()
        model = parse_model(data)
        self.tokenizer = build_tokenizer(model)
        self.by_word = (
            self.tokenizer.pre_tokenizer is not None
            and model.dummy_prefix
            and model.escape_spaces
            and not (model.charsmap or model.remove_extra_spaces)
        )
        # Encodes words that are normalised already.
        self.words = build_tokenizer(model)
        self.words.normalizer = normalizers.Sequence([])
        self.words.pre_tokenizer = None
        self.original = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.ids: dict[str, bytes] = {}
        self.unlike: set[str] = set()  # words on which the libraries differ
        self.lossy: set[str] = set()  # words that do not come back

    def _learn(self, words: set[str]) -> None:
        new = list(words - self.ids.keys())
        if len(self.ids) + len(new) > CACHE_WORDS:
            self.ids, self.unlike, self.lossy = {}, set(), set()
            new = list(words)
        own = [x.ids for x in self.words.encode_batch_fast(new, add_special_tokens=False)]
        # A word begins with a marker, which sentencepiece puts before a text itself.
        texts = [word[1:].replace(MARKER, " ") for word in new]
        original = self.original.encode(texts, num_threads=1)
        # The marker alone ends a text; by itself it would be an empty one.
        original = [x if text else [self.original.piece_to_id(MARKER)] for x, text in zip(original, texts)]
        self.unlike.update(word for word, a, b in zip(new, own, original) if a != b)
        ids = [b if word in self.unlike else a for word, a, b in zip(new, own, original)]
        self.ids.update((word, np.array(x, np.int32).tobytes()) for word, x in zip(new, ids))
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        self.lossy.update(word for word, a, b in zip(new, texts, decoded) if a != b)

    def _whole(self, texts: list[str]) -> Iterator[tuple[list[int], str, bool]]:
        """Whole texts through the tokenizers library, compared with sentencepiece."""
        # An empty text has no pieces, not even a marker.
        own = [x.ids if t else [] for x, t in zip(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), texts)]
        original = self.original.encode(texts, num_threads=1)
        ids = [a if a == b else b for a, b in zip(own, original)]
        decoded = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        yield from zip(ids, decoded, (a == b for a, b in zip(own, original)))

    def code(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str, bool]]:
        """Ids, their text, and whether both libraries agree; if not, the ids are those of sentencepiece."""
        if not self.by_word:
            for ids, back, alike in self._whole(texts):
                yield np.array(ids, np.int32), back, alike
            return
        cut = [_WORDS.findall(MARKER + text.replace(" ", MARKER)) if text else [] for text in texts]
        distinct = set(chain.from_iterable(cut))
        self._learn(distinct)
        unlike, lossy = distinct & self.unlike, distinct & self.lossy
        sample = [i for i, text in enumerate(texts) if not xxhash.xxh64_intdigest(text.encode()) % WHOLE]
        whole = dict(zip(sample, self._whole([texts[i] for i in sample])))
        for i, words in enumerate(cut):
            ids = np.frombuffer(b"".join(map(self.ids.__getitem__, words)), np.int32)
            if lossy and not lossy.isdisjoint(words):
                text = self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
            else:
                text = "".join(words).replace(MARKER, " ")[1:]
            alike = not unlike or unlike.isdisjoint(words)
            if i in whole and whole[i] != (ids.tolist(), text, alike):
                given, text, _ = whole[i]
                ids, alike = np.array(given, np.int32), False
            yield ids, text, alike


@cache
def _codec(path: str, threads: int) -> Codec:
    """One for each worker process."""
    return Codec(path, threads)


def encode_and_decode(
    documents: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", threads: int = THREADS
) -> DataFrame:
    """One row a document: doc_id, n_tokens, ids, decoded, parity, round_trip.

    `model` is the place of a sentencepiece model file. ids are those of the tokenizers library, without begin and end;
    parity tells whether sentencepiece gave the same; if not, its ids are returned. decoded is the text of the ids, and round_trip
    tells whether it is the document's. It is not where the model itself loses something, as it writes blanks for its marker.
    A null text has no ids, no decoded text and neither flag; an empty text has an empty list. Repeated rows and rows with
    null ids each give a row; other columns play no part; an empty table gives an empty result.
    """

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        codec = _codec(model, threads)

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            null = pa.array([x is None for x in texts], pa.bool_())
            ids, decoded, parity = zip(*codec.code([x or "" for x in texts])) if texts else ((), (), ())
            sizes = np.array([len(x) for x in ids], np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            values = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            back = pa.array([a == b for a, b in zip(decoded, texts)], pa.bool_())
            columns = [
                _unless(null, pa.array(sizes)),
                pa.ListArray.from_arrays(offsets, values, mask=null),
                _unless(null, pa.array(decoded, pa.string())),
                _unless(null, pa.array(parity, pa.bool_())),
                _unless(null, back),
            ]
            names = ["doc_id", "n_tokens", "ids", "decoded", "parity", "round_trip"]
            return pa.record_batch([batch.column(0), *columns], names)

        return handle

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "doc_id long, n_tokens long, ids array<int>, decoded string, parity boolean, round_trip boolean"
    return map_pieces(rows, start, schema)


def _unless(null: pa.Array, values: pa.Array) -> pa.Array:
    return pc.if_else(null, pa.scalar(None, values.type), values)
