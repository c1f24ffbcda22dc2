"""The pipeline from raw documents to token ids: five stages, each on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written as Parquet to the shared scratch folder and
read again as the next one's docs, which ends its lineage: a lost executor costs at most the work of one stage.
All stages but the last return the columns of documents; n_chars follows a changed text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.llm.batches import free_name, share_code
from visitloom.llm.decontamination import remove_contamination
from visitloom.llm.language_id import UNKNOWN, fit_languages, held_out, identify_languages
from visitloom.llm.line_dedup import dedup_lines
from visitloom.llm.near_dedup import without_near_duplicates
from visitloom.llm.sentencepiece_codec import encode_and_decode
from visitloom.session import through_storage

#: Not all stages can be written in SQL.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now, if there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*(n_chars.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a language. Those without one go: their text is null or has no letter.

    A short text of an unsure language stays. The languages are learned from the labelled documents that are not held
    out; where there are none, only the letters are looked at.
    """
    model = fit_languages(docs.where(~held_out("doc_id")))
    lang_pred, score = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = identify_languages(docs, model, lang_pred=lang_pred, score=score)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return found.where(F.col(lang_pred) != UNKNOWN).drop(lang_pred, score)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has, equal or nearly; those without a line left go."""
    removed = free_name(docs, "lines_removed")
    found = dedup_lines(docs)
    left = (F.col(removed) == 0) | F.col("text").rlike(r"\S")
    return _counted(found.where(left).drop(removed))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark cut out; those without a word left go."""
    benchmark = share_code(spark).read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _counted(remove_contamination(docs, benchmark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they stand for."""
    return encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language", known_language),
    ("lines", unique_lines),
    ("near_duplicates", one_of_each_group),
    ("benchmark", without_benchmark),
    ("tokens", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = share_code(spark).read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = through_storage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
