"""Stages that clean and pack `documents`; each one's result is written and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelftrail.llm import exact_dedup, jaccard_join, packing, quality, secret_scan
from shelftrail.llm.tables import written


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on `docs`, accepts. Null and blank ones stay."""
    return quality.accepted(docs, quality.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal normalised texts stays; null and blank texts are one group."""
    return exact_dedup.kept_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-equal shingle sets (five words, similarity 0.8 or more) stays."""
    return jaccard_join.kept_documents(docs, size=5, least=80, of=100)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with secrets replaced in text and n_chars counted again."""
    return secret_scan.redacted(docs, secret_scan.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, bucket, boundary, batch and slot of all rows."""
    return packing.pack(docs, budget=32768, buckets=8)


STAGES = [
    ("quality_classifier", good),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("secret_scans", redacted),
    ("packing", packed),
]

#: Fitted models decide in the first and fourth stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table `documents`; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
