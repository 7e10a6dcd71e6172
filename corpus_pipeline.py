"""The corpus pipeline: quality, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir), where docs is what its predecessor kept, and
works on all of it. All but the last return the columns of ``documents``.
``run`` writes each stage's rows as Parquet below the shared checkpoint
folder and hands on what it reads back.

Every stage decides row by row: rows that share a doc_id, or have none, are judged each by
itself, and extra columns of any name are handed on. Null and empty texts fail the quality rules (too few
words); of equal rows near_duplicates keeps one; very long texts are handled whole; an empty table
stays empty. ``run`` needs the shared folder that ``spark.checkpoint.dir`` names, and leaves only the last
stage's rows there.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import jaccard_join, mixing, packing, quality, secrets
from tidemark.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.kept_rows(docs)


#: Near duplicates of the pipeline: five words, similarity 0.8 or more.
NEAR = jaccard_join.Join(k=5, percent=80)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that of the smallest doc_id (nulls last)."""
    return jaccard_join.one_per_component(docs, NEAR)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; every document stays."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target weights."""
    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in training sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]

#: Tokenization, quantile sketches and connected components are beyond SQL; a test holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    shared = checkpoint_dir(spark)
    if not shared:
        raise RuntimeError("the pipeline writes its stages to a shared folder: set spark.checkpoint.dir")
    docs, last = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    folder = f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if last:
            _remove(spark, last)
        last = f"{folder}/{name}"
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a stage's folder that nothing reads any more, by the file system it is on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
