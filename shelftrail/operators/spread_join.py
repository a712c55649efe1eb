"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# Rows of a key that one reducer should carry; None is an even share of all rows.
SHARE: int | None = None

# Narrow rows that one task sorts or groups in a step that is dealt out by volume.
TASK_ROWS = 250_000

# Longest run of equal rows produced from one row in one step.
_RUN = 4096
_SALT = "__salt"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_tasks(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df` dealt out by `keys` over as many tasks as so many rows ask for; a small one is left to Spark."""
    if rows <= TASK_ROWS:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS)), *keys)


def sorted_in_tasks(df: DataFrame, rows: int, *order: Column) -> DataFrame:
    """`df.orderBy(*order)` with as many ranges as so many rows ask for."""
    if rows <= TASK_ROWS:
        return df.orderBy(*order)
    ranges = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))
    return df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)


def hot_keys(rows: DataFrame, *keys: str, share: int | None = None) -> DataFrame:
    """The hot keys of `counted_keys` alone."""
    return counted_keys(rows, *keys, share=share)[0]


def counted_keys(rows: DataFrame, *keys: str, share: int | None = None) -> tuple[DataFrame, int]:
    """The hot keys and the number of all rows.

    Hot are the keys with more rows than one reducer should carry; `__splits` is how many
    should. They are counted when this is called, in one scan of the keys, so that without any
    (`hot.isEmpty()`) callers can plan as if there were no such thing. With an even share as
    the bar, or TASK_ROWS if that is less, there are fewer such keys than shuffle partitions,
    or than tasks that so many rows ask for, so the list may come to the driver and be sent to
    every task. A `share` in rows gives no such
    bound; the list then stays a query that Spark joins as its size demands. NULL may be
    among the keys. A list of other rows than those joined is only less balanced.
    """
    share = SHARE if share is None else share
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    whole = counts.agg(F.sum("__rows").alias("__rows"))
    if share is None:
        bar = F.greatest(F.least(F.ceil(whole.scalar() / _partitions(rows)), F.lit(TASK_ROWS)), F.lit(1))
    else:
        bar = F.lit(share)
    hot = counts.where(F.col("__rows") > bar).select(*keys, F.ceil(F.col("__rows") / bar).cast("int").alias("__splits"))
    if share is not None:
        return hot, whole.first()[0] or 0
    # The sum of all rows comes along as a row of its own, so the keys are counted once.
    found = hot.unionByName(whole, allowMissingColumns=True).toArrow()
    is_hot = found["__splits"].is_valid()
    total = max(n or 0 for n in found["__rows"].to_pylist())
    return F.broadcast(rows.sparkSession.createDataFrame(found.filter(is_hot).select(hot.columns), hot.schema)), total


def spread_join(
    rows: DataFrame, other: DataFrame, keys: list[str], how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """`rows.join(other, keys, how)` for inner, left, left_semi and left_anti.

    Rows whose first key is hot are spread over as many reducers as their number asks
    for, by a salt taken from their content, and the other side's rows of that key (only
    those) are repeated per salt. Rows without that key match nothing and are spread as
    well. `hot` lists the hot values of the first key; by default they are counted on
    `rows`. Equal rows share a salt, so merge them before (`with_copies`,
    `merge_hot_copies`).
    """
    key = keys[0]
    hot = hot_keys(rows, key) if hot is None else hot
    added = [] if how in ("left_semi", "left_anti") else [c for c in other.columns if c not in keys]
    if hot.isEmpty():
        return rows.join(other, keys, how).select(*rows.columns, *added)
    # Salts hash to reducers unevenly; more of them even that out. With a single key the
    # other side has few rows per key, which are cheap to repeat.
    more = 4 if len(keys) == 1 else 1
    splits = F.when(F.col(key).isNull(), _partitions(rows) * more).otherwise(F.col("__splits") * more)
    salt = F.when(splits.isNotNull(), F.pmod(F.xxhash64(*rows.columns), splits)).otherwise(0)
    salted = rows.join(hot, key, "left").withColumn(_SALT, salt.cast("int"))
    salts = F.sequence(F.lit(0), F.coalesce(F.col("__splits") * more, F.lit(1)) - 1)
    repeated = other.join(hot, key, "left").withColumn(_SALT, F.explode(salts)).drop("__splits")
    return salted.join(repeated, [*keys, _SALT], how).select(*rows.columns, *added)


def with_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Equal rows as one row with their number, combined before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


def merge_hot_copies(rows: DataFrame, key: str, hot: DataFrame, copies: str = "copies") -> DataFrame:
    """`with_copies` for the rows of hot keys only; every other row counts as one.

    Spares the ordinary rows a shuffle.
    """
    if hot.isEmpty():
        return rows.withColumn(copies, F.lit(1).cast("bigint"))
    few = hot.select(F.col(key).alias("__key"))
    is_hot = F.col(key).eqNullSafe(F.col("__key"))
    ordinary = rows.join(few, is_hot, "left_anti").withColumn(copies, F.lit(1).cast("bigint"))
    return ordinary.unionByName(with_copies(rows.join(few, is_hot, "left_semi"), copies))


def repeat_rows(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as often as its `copies` column says, in runs of bounded length.

    Keeps the order of the rows, so a sort may come before it.
    """
    runs = F.sequence(F.lit(0).cast("bigint"), F.expr(f"({copies} - 1) div {_RUN}"))
    run_length = F.least(F.lit(_RUN).cast("bigint"), F.col(copies) - F.col("__run") * _RUN)
    return (
        df.withColumn("__run", F.explode(runs))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), run_length)))
        .drop(copies, "__run", "__copy")
    )
