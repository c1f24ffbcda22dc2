"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts hashed n-grams of each language inside the tasks and sums them by (language, bucket). The
matrix of log-probabilities, languages x BUCKETS, is broadcast; batches of texts are scored as sparse counts times it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from visitloom.llm.batches import free_name, in_python, map_pieces

UNKNOWN = "und"
BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
SMOOTHING = 0.5
# Bound of the model, and so of what is broadcast and fetched: MAX_LANGUAGES * BUCKETS numbers.
MAX_LANGUAGES = 256
# Characters of texts that are scored at a time, few enough for the caches of a core.
GROUP_CHARACTERS = 1 << 15
# Labelled rows, at about this number, of which the model is made.
TRAIN_ROWS = 200_000
_LETTER = regex.compile(r"\p{L}")
# Bucket number that stands for the number of training texts.
_TEXTS = -1


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about GROUP_CHARACTERS; a longer text is in a list that ends with it."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= GROUP_CHARACTERS:
            yield group
            group, size = [], 0
    if group:
        yield group


def ngram_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the text, bucket) of each character 1-, 2- and 3-gram of the lower-cased texts; none goes across two."""
    lowered = [text.lower() for text in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lowered), dtype=np.int32), [len(text) for text in lowered])
    grams, owners, buckets = codes, [], []
    for order in range(3):
        if order:
            grams = grams[:-1] * np.uint32(1_000_003) + codes[order:]
        mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(2_654_435_761) + np.uint32(order * 0x9E3779B1 % 2**32)
        bucket = (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)
        inside = owner[: len(owner) - order] == owner[order:]
        owners.append(owner[order:][inside])
        buckets.append(bucket[inside])
    return np.concatenate(owners), np.concatenate(buckets)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probability: np.ndarray  # languages x BUCKETS
    log_prior: np.ndarray

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """The likeliest language of each text, of equal ones the first in the order of names, and its posterior."""
        found = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return found
        known = [i for i, text in enumerate(texts) if text is not None and _LETTER.search(text)]
        at = 0
        for group in _groups([texts[i] for i in known]):
            scores = self._scores(group)
            likely = scores.argmax(axis=1)
            best = scores[np.arange(len(group)), likely]
            posterior = 1 / np.exp(scores - best[:, None]).sum(axis=1)
            for i, language, score in zip(known[at : at + len(group)], likely.tolist(), posterior.tolist()):
                found[i] = self.languages[language], score
            at += len(group)
        return found

    def _scores(self, texts: list[str]) -> np.ndarray:
        """Log of prior times likelihood, texts x languages: sparse counts times the matrix."""
        owner, bucket = ngram_buckets(texts)
        narrow = len(texts) << BUCKET_BITS < 1 << 31
        keys = (owner.astype(np.int32 if narrow else np.int64) << BUCKET_BITS) | bucket
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(first, len(keys)))
        owner, bucket = keys[first] >> BUCKET_BITS, keys[first] & (BUCKETS - 1)
        # A language at a time, so that memory goes with the n-grams of the texts, not with those times languages.
        columns = [np.bincount(owner, counts * row[bucket], len(texts)) for row in self.log_probability]
        return np.stack(columns, axis=1) + self.log_prior


def fit_languages(
    examples: DataFrame, text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS, doc_id: str = "doc_id"
) -> LanguageModel:
    """A model of the rows whose text and language are not null.

    Beyond `train_rows` such rows, about that many are taken by a hash of the text and, if there is one, the doc_id,
    so that copies of a text under other ids are drawn apart. More than MAX_LANGUAGES
    languages are refused with an error. With no row, the model knows no language.
    """
    drawn = F.xxhash64(*([doc_id] if doc_id in examples.columns else []), text).alias("drawn")
    known = examples.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), drawn).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    total = max(known.count(), 1)
    if total > train_rows:
        known = known.where(F.pmod("drawn", F.lit(1_000_000)) < train_rows / total * 1_000_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        texts: dict[str, int] = defaultdict(int)
        for batch in batches:
            of_language: dict[str, list[str]] = defaultdict(list)
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of_language[language].append(value)
            for language, values in of_language.items():
                texts[language] += len(values)
                for group in _groups(values):
                    sums[language] += np.bincount(ngram_buckets(group)[1], minlength=BUCKETS)
        for language, counts in sums.items():
            used = np.flatnonzero(counts)
            yield pa.record_batch(
                [
                    pa.array([language] * (len(used) + 1), pa.string()),
                    pa.array(np.append(used, _TEXTS), pa.int32()),
                    pa.array(np.append(counts[used], texts[language]), pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    summed = in_python(known, count, "lang string, bucket int, n long")
    summed = summed.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most (MAX_LANGUAGES + 1) * (BUCKETS + 1) rows come to the driver, before more are refused.
    rows = summed.limit((MAX_LANGUAGES + 1) * (BUCKETS + 1)).toArrow()
    languages = sorted(rows.column("lang").unique().to_pylist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    where = {language: i for i, language in enumerate(languages)}
    column = np.array([where[x] for x in rows.column("lang").to_pylist()], np.int64)
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    counts, texts = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    grams = bucket != _TEXTS
    counts[bucket[grams], column[grams]] = n[grams]
    texts[column[~grams]] = n[~grams]
    counts += SMOOTHING
    probability = np.ascontiguousarray((counts / counts.sum(axis=0)).T)
    return LanguageModel(languages, np.log(probability), np.log(texts / max(texts.sum(), 1)) if languages else texts)


def identify_languages(
    documents: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """`documents` with the predicted language and its posterior probability, 0 to 1.

    The language is `und`, with score 0, where the text is null or has no letter, and everywhere if the model
    knows no language. Every row is kept, repeated rows and rows with null ids too. The names `lang_pred` and
    `score` must not be columns of `documents`.
    """
    for name in (lang_pred, score):
        if free_name(documents, name) != name:
            raise ValueError(f"documents has a column {name}")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index(text)

    def start() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        model = shared.value

        def handle(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = model.predict(batch.column(at).to_pylist())
            return pa.record_batch(
                [
                    *batch.columns,
                    pa.array([x for x, _ in found], pa.string()),
                    pa.array([x for _, x in found], pa.float64()),
                ],
                [*batch.schema.names, lang_pred, score],
            )

        return handle

    added = [StructField(lang_pred, StringType()), StructField(score, DoubleType())]
    schema = StructType([*documents.schema.fields, *added])
    return map_pieces(documents, start, schema)


def held_out(doc_id: str):
    """Whether a document is kept from training: crc32(doc_id as text) mod 4 is 2. Null ids are."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(True))
