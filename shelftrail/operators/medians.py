"""Medians per group, exact or approximate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelftrail.operators import spread_join
from shelftrail.operators.spread_join import counted_keys, hot_keys, in_tasks

# 0-based positions of the two middle values among `__known` ordered values.
_LOWER = "(__known - 1) div 2"
_UPPER = "__known div 2"


# The middle is sought between two approximate quantiles this far from it, which is ten
# times as far as they may be wrong.
_MARGIN, _ACCURACY = 0.001, 10_000


def _running(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Adds `__upto`, the known values up to and with this row, and the group's `__known`."""
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        df.withColumn("__upto", F.sum("__valid").over(upto))
        .withColumn("__known", F.sum("__valid").over(whole))
    )


def _at(position: str, value: Column) -> Column:
    """`value` where the row covers the position, for use inside max()."""
    place = F.expr(position)
    return F.when((place >= F.col("__upto") - F.col("__valid")) & (place < F.col("__upto")), value)


def _middle() -> Column:
    return F.col("__lower") * 0.5 + F.col("__upper") * 0.5


def _same(left: list[str], right: list[str]) -> Column:
    same = F.lit(True)
    for a, b in zip(left, right):
        same &= F.col(a).eqNullSafe(F.col(b))
    return same


def exact_median(
    df: DataFrame,
    keys: list[str],
    value: str,
    sums: dict[str, Column] | None = None,
    large_groups: bool = False,
    hot: DataFrame | None = None,
    volume: int | None = None,
) -> DataFrame:
    """One row per group: keys, `median`, `highest`, `row_count` and the given sums.

    The median is that of the known values, interpolated. Ordinary groups are shuffled
    once, over as many tasks as their number (`volume`, or counted) asks for, and the middle
    is found by running counts in value order, which sort and spill instead of holding a
    group in memory. Groups with more rows than one reducer should
    carry are found by counting the first key (or are among the frequent ones listed in
    `hot`, see `hot_keys`), and the whole key only where the first is frequent. They go
    through `_median_by_bracket`; without any, that branch isn't planned at all.
    `large_groups` is for one group per calendar day at most, each a large part of the
    table: all go through that branch.
    """
    sums = sums or {}
    rows = df.select(
        *keys, F.col(value).cast("double").alias("__value"), *[e.alias(n) for n, e in sums.items()]
    )
    if large_groups:
        return _median_by_bracket(rows, keys, list(sums), bounded=True)
    if hot is None:
        hot, volume = counted_keys(df, keys[0])
    elif volume is None:
        volume = df.count()
    if hot.isEmpty():
        return _median_in_order(rows, keys, list(sums), volume)
    names = [f"__key_{k}" for k in keys]
    frequent = hot.select(F.col(keys[0]).alias(names[0]))
    of_frequent = rows.join(frequent, _same(keys[:1], names[:1]), "left_semi")
    # As few as the first keys are; see counted_keys.
    large = hot_keys(of_frequent, *keys)
    if large.isEmpty():
        return _median_in_order(rows, keys, list(sums), volume)
    large = large.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
    ordinary, of_large = (rows.join(large, _same(keys, names), how) for how in ("left_anti", "left_semi"))
    return _median_in_order(ordinary, keys, list(sums), volume).unionByName(
        _median_by_bracket(of_large, keys, list(sums), spread_join.SHARE is None)
    )


def _median_in_order(rows: DataFrame, keys: list[str], sums: list[str], volume: int) -> DataFrame:
    """`exact_median` with one shuffle of all rows, each group put in order."""
    known = in_tasks(rows, volume, *keys).withColumn("__valid", F.col("__value").isNotNull().cast("int"))
    per_group = _running(known, keys, "__value").groupBy(*keys).agg(
        F.max(_at(_LOWER, F.col("__value"))).alias("__lower"),
        F.max(_at(_UPPER, F.col("__value"))).alias("__upper"),
        F.max("__value").alias("highest"),
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(n).alias(n) for n in sums],
    )
    return per_group.select(*keys, _middle().alias("median"), "highest", "row_count", *sums)


def _median_by_bracket(rows: DataFrame, keys: list[str], sums: list[str], bounded: bool) -> DataFrame:
    """`exact_median` for few, large groups, without shuffling their values.

    A first pass brackets each group's middle between two approximate quantiles. A second
    pass counts the values below the bracket and each distinct value within it, a few
    thousandths of the group, and puts those in order. Both combine before the shuffle, so
    copies and wide groups cost little, however the values are spread. With `bounded`
    groups (one per calendar day, or as few as hot keys) the brackets are sent
    to every task.
    """
    names = [f"__of_{k}" for k in keys]
    ends = F.percentile_approx("__value", F.array(F.lit(0.5 - _MARGIN), F.lit(0.5 + _MARGIN)), _ACCURACY)
    groups = rows.groupBy(*keys).agg(
        ends.alias("__ends"), F.count("__value").alias("__known"), F.max("__value").alias("highest"),
        F.count(F.lit(1)).alias("row_count"), *[F.sum(n).alias(n) for n in sums],
    )
    carried = ["__known", "highest", "row_count", *sums]
    brackets = groups.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "__ends", *carried)
    low, high = F.col("__ends")[0], F.col("__ends")[1]
    near = rows.select(*keys, "__value").join(F.broadcast(brackets) if bounded else brackets, _same(keys, names))
    # A group without known values has no bracket and keeps its rows, which count nothing.
    counted = near.where((F.col("__value") <= high) | high.isNull()).groupBy(
        *keys, F.when(F.col("__value") >= low, F.col("__value")).alias("__value")  # NULL: below the bracket
    ).agg(F.count(F.lit(1)).alias("__rows"), *[F.max(c).alias(c) for c in carried])
    counted = counted.withColumn("__valid", F.when(F.col("__known") > 0, F.col("__rows")).otherwise(0))
    order = Window.partitionBy(*keys).orderBy(F.col("__value").asc_nulls_first())
    ranked = counted.withColumn("__upto", F.sum("__valid").over(order))
    result = ranked.groupBy(*keys).agg(
        F.max(_at(_LOWER, F.col("__value"))).alias("__lower"),
        F.max(_at(_UPPER, F.col("__value"))).alias("__upper"),
        *[F.max(c).alias(c) for c in carried],
    )
    missed = (F.col("__known") > 0) & (F.col("__lower").isNull() | F.col("__upper").isNull())
    median = F.when(missed, F.raise_error(F.lit("the middle is outside its bracket")).cast("double")).otherwise(_middle())
    return result.select(*keys, median.alias("median"), "highest", "row_count", *sums)


def approximate_median(
    df: DataFrame, keys: list[str], value: str, sums: dict[str, Column] | None = None
) -> DataFrame:
    """Same columns as `exact_median`; the median is an actual value near the middle."""
    sums = sums or {}
    price = F.col(value).cast("double")
    return df.groupBy(*keys).agg(
        F.percentile_approx(price, 0.5).alias("median"),
        F.max(price).alias("highest"),
        F.count(F.lit(1)).alias("row_count"),
        *[F.sum(e).alias(n) for n, e in sums.items()],
    )


def group_medians(
    df: DataFrame,
    keys: list[str],
    value: str,
    method: str = "exact",
    sums: dict[str, Column] | None = None,
    large_groups: bool = False,
    hot: DataFrame | None = None,
    volume: int | None = None,
) -> DataFrame:
    if method == "exact":
        return exact_median(df, keys, value, sums, large_groups, hot, volume)
    if method == "approx":
        return approximate_median(df, keys, value, sums)
    raise ValueError(f"median must be 'exact' or 'approx', not {method!r}")
