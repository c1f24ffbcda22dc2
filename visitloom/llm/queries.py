"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitloom.llm.batches import share_code
from visitloom.llm.decontamination import find_contamination
from visitloom.llm.language_id import fit_languages, held_out, identify_languages
from visitloom.llm.licenses import license_scan
from visitloom.llm.line_dedup import dedup_lines
from visitloom.llm.mixing import mix_plan
from visitloom.llm.near_dedup import near_duplicates
from visitloom.llm.periodic_runs import periodic_runs
from visitloom.llm.pii import pseudonymise
from visitloom.llm.sentencepiece_codec import encode_and_decode
from visitloom.llm.token_counts import token_counts
from visitloom.llm.toxicity import fit_toxicity, score_toxicity
from visitloom.llm.topk import build_index, quantised, top_k
from visitloom.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return share_code(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(_table(spark, folder, "documents")).drop("blocks")


def op2_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = quantised(_table(spark, folder, "embeddings"))
    return top_k(build_index(vectors), vectors.where("vec_id % 100 = 0"), k=10)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    labels = _table(spark, folder, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    model = fit_toxicity(documents, documents.where(~held_out("doc_id")), labels=labels.where("toxic IS NOT NULL"))
    scored = score_toxicity(documents, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "evidence")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(_table(spark, folder, "documents").select("doc_id", "text"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    model = fit_languages(documents.where(~held_out("doc_id")))
    rows = documents.select("doc_id", held_out("doc_id").alias("held_out"), "text")
    return identify_languages(rows, model).drop("text")


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = find_contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode_and_decode(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    # The key of a real run comes from where its secrets are kept.
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return pseudonymise(documents, key="registered-query")


def op11_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mix_plan(_table(spark, folder, "documents"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_table(spark, folder, "embeddings"))


def _with_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the texts, chosen by doc_id, repeat some of their words from a word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = documents.select("doc_id", "text", h.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    chosen = chosen.withColumn("words", words).withColumn("n", F.size("words"))
    chosen = chosen.withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    period = F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)")
    chosen = chosen.withColumn("p", period).withColumn("a", F.col("a").cast("int"))
    repeated = F.expr("array_join(transform(words, (w, i) -> IF(i < a, w, words[a + (i - a) % p])), ' ')")
    return chosen.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(_with_repeats(_table(spark, folder, "documents")))
    best = F.expr("""aggregate(runs, CAST(NULL AS struct<start: bigint, length: bigint, period: bigint>),
        (b, r) -> IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_decontamination": op7_decontamination,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_near_dedup": op9_near_dedup,
    "op10_pii": op10_pii,
    "op11_source_mix": op11_source_mix,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}
