"""From raw documents to token ids in five stages, each of which works on what the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.llm import byte_bpe, decontaminate, language_id, minhash, personal_data
from ratingloom.llm.common import row_key, table
from ratingloom.sources.durable import durable

LEAST_SCORE = 0.5
LEAST_SIMILARITY = 80  # percent


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that was learned, told with a score of at least ``LEAST_SCORE``; ``lang`` becomes the language found."""
    found = language_id.language_of(F.col("text"), language_id.fit(docs), spark)
    judged = docs.withColumn("judged", found).filter(
        (F.col("judged.lang") != language_id.UNKNOWN) & (F.col("judged.score") >= LEAST_SCORE)
    )
    return judged.withColumn("lang", F.col("judged.lang")).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near-duplicates; equal rows once."""
    kept = minhash.near_duplicates(docs, LEAST_SIMILARITY).filter("kept").select("doc_id").distinct()
    named = docs.withColumn("row_key", row_key())
    stay = named.join(kept.withColumnRenamed("doc_id", "kept_id"), F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return stay.dropDuplicates(["doc_id", "row_key"]).select(*docs.columns)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no item of the benchmark contaminates."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; ``n_chars`` is counted again."""
    clean = personal_data.without_spans(F.col("text"), personal_data.fit(docs), spark)
    masked = docs.withColumn("text", clean)
    return masked.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the bytes decoded from them."""
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.digests(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontaminate", remove_benchmark_passages),
    ("personal_data", mask_personal_data),
    ("byte_bpe", encode_tokens),
]

# Trained models, hashed buckets and token merges are no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
