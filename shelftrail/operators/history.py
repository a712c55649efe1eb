"""Per-code facts over the whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelftrail.functions.dates import day
from shelftrail.operators.medians import group_medians
from shelftrail.operators.spread_join import counted_keys, in_tasks


def daily_prices(
    products: DataFrame, median: str = "exact", hot: DataFrame | None = None, volume: int | None = None
) -> DataFrame:
    """One row per (code, import_date): median price, highest price, rows. `hot` lists hot codes, of `volume` rows."""
    return group_medians(products, ["code", "import_date"], "price_gbp", median, hot=hot, volume=volume)


def code_history(
    products: DataFrame, median: str = "exact", until=None, hot: DataFrame | None = None, volume: int | None = None
) -> DataFrame:
    """One row per code: price_changes_count and max_price, from a single scan.

    All dates count, also those after the day being reported on, unless `until` ends
    the history. Days without a known price add no change.
    """
    if until is not None:
        products = products.where(F.col("import_date") <= day(until))
    if hot is None and median == "exact":
        hot, volume = counted_keys(products, "code")
    elif volume is None or until is not None:
        volume = products.count()
    return history_of_days(daily_prices(products, median, hot, volume), volume)


def history_of_days(daily: DataFrame, volume: int) -> DataFrame:
    """`code_history` from one row per code and day (code, median, highest), `volume` rows at most."""
    # A code has one row per calendar day by now, so all of them may meet in one task:
    # one shuffle on the code serves both groupings.
    return (
        in_tasks(daily.repartition("code"), volume, "code")
        .groupBy("code", "median").agg(F.max("highest").alias("highest"))
        .groupBy("code").agg(
            F.count("median").alias("price_changes_count"), F.max("highest").alias("max_price")
        )
    )


def price_changes(
    products: DataFrame, median: str = "exact", hot: DataFrame | None = None, volume: int | None = None
) -> DataFrame:
    return code_history(products, median, hot=hot, volume=volume).select("code", "price_changes_count")


def max_prices(products: DataFrame, key: str = "code", until=None) -> DataFrame:
    if until is not None:
        products = products.where(F.col("import_date") <= day(until))
    return products.groupBy(key).agg(F.max(F.col("price_gbp").cast("double")).alias("max_price"))
