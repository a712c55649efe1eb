"""Canonical tables and pages at rest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelftrail.schema import CANONICAL, CANONICAL_COLUMNS
from shelftrail.sinks import versions


def read_stocks(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table; a filter on import_date reads only those days' folders.

    Of a table of `versions.create` the latest version is read.
    """
    if versions.versions(spark, path):
        return versions.read(spark, path, CANONICAL)
    return spark.read.schema(CANONICAL).parquet(path).select(*CANONICAL_COLUMNS)


def named(spark: SparkSession, name: str) -> DataFrame:
    """A catalogue table or a temporary view."""
    return spark.table(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    """A table from `save_bucketed`, in a session of its own that joins bucket with bucket.

    Spark shuffles for a join on code and day unless both keys made the buckets; that code
    alone did is enough, as equal keys then share a bucket as well.
    """
    bucketed = spark.newSession()
    # Catalogue and settings of the caller's session, but for those that keep buckets from being used.
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and bucketed.conf.isModifiable(key):
            bucketed.conf.set(key, value)
    bucketed.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    bucketed.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    return bucketed.table(name)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("url", "html")
