"""Positions of rows in a global order, without a task that sees them all."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelftrail.llm.tables import Scratch

#: Rows per partition of a sorted table, and the fewest that are worth one.
PART_ROWS, LEAST_ROWS = 500_000, 1000


def parts_of(df: DataFrame, rows: int) -> int:
    """Partitions for so many rows: the session's number, more for large tables and fewer for small ones."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(rows / PART_ROWS), min(usual, math.ceil(rows / LEAST_ROWS)))


def numbered(df: DataFrame, steps: Scratch, name: str, *by: str) -> DataFrame:
    """The rows of the written table `df` with `place`: 0, 1, ... in rising order of `by`, nulls first.

    Rows are dealt out by ranges of `by` and, where that is equal, of their stored place, so
    neither a frequent value nor repeated rows fill a partition; equal rows are numbered in
    any order. Each partition numbers its own rows; what comes before it is one sum per
    partition.
    """
    tie, part, at = f"{name}_tie", f"{name}_part", f"{name}_at"
    ranged = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(parts_of(df, df.count()), *by, tie)
    sorted_ = ranged.sortWithinPartitions(*by, tie).drop(tie).withColumns({at: F.monotonically_increasing_id(), part: F.spark_partition_id()})
    sorted_ = steps.written(sorted_, f"{name}-sorted")
    # A row per partition, so one task may add them up and every task may have them.
    sizes = sorted_.groupBy(part).agg(F.count("*").alias(f"{name}_size"))
    before = F.sum(f"{name}_size").over(Window.orderBy(part)) - F.col(f"{name}_size")
    before = sizes.select(part, before.alias(f"{name}_before"))
    local = F.col(at).bitwiseAND((1 << 33) - 1)
    placed = sorted_.join(F.broadcast(before), part).withColumn("place", F.col(f"{name}_before") + local)
    return placed.drop(part, at, f"{name}_before")
