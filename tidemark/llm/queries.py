"""Registered queries of the training-data operators, and their DuckDB twins.

Each query applies its operator with production parameters to the whole table
and derives the digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (alignment, decontaminate, fingerprints, jaccard_join, licenses, mixing, packing, quality,
                          secrets, suffix_dedup, toxicity, variants, warc)
from tidemark.llm._common import read_table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")).drop("starts", "ends")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents")).drop("kinds", "starts", "ends")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("passes", "part", "key", "key2")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages")).drop("url", "payload")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(variants.noisy_words(read_table(spark, sf_dir, "documents")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.scan(read_table(spark, sf_dir, "documents"),
                                                   read_table(spark, sf_dir, "benchmark"))).drop("longest")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_toxicity": op4_toxicity,
    "op5_secrets": op5_secrets,
    "op6_licenses": op6_licenses,
    "op7_mixing": op7_mixing,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_alignment": op12_token_alignment,
    "op13_decontamination": op13_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op6_licenses": licenses.oracle_sql(),
    "op9_warc": warc.oracle_sql(),
    "op13_decontamination": decontaminate.oracle_sql(),
}
