"""The registered queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratingloom.llm import byte_bpe, decontaminate, language_id, license_scan, minhash, packing, personal_data, preferences, spelling, substring_dedup, suffix_dedup, vectors, whitening
from ratingloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.digests(table(spark, d, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op4_language_id(spark: SparkSession, d: str) -> DataFrame:
    return language_id.identify(table(spark, d, "documents"))


@query
def op2_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return license_scan.report(table(spark, d, "documents"))


SQL["op2_license_scan"] = license_scan.sql()


@query
def op3_minhash(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, d, "documents"), percent=85)


@query
def op8_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op10_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return personal_data.report(table(spark, d, "documents"))


@query
def op9_vector_dedup(spark: SparkSession, d: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, d, "embeddings"), least=0.95)


@query
def op7_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.digests(table(spark, d, "documents"))


@query
def op1_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, d, "documents"))


@query
def op6_preferences(spark: SparkSession, d: str) -> DataFrame:
    return preferences.neighbour_pairs(table(spark, d, "conversations"))


SQL["op6_preferences"] = preferences.SQL


@query
def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.report(table(spark, d, "documents"))


SQL["op13_spelling_variants"] = spelling.sql()


@query
def op11_packing(spark: SparkSession, d: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    return packing.pack(table(spark, d, "documents"), vocabulary)


@query
def op12_whitening(spark: SparkSession, d: str) -> DataFrame:
    return whitening.whiten(table(spark, d, "embeddings"))
