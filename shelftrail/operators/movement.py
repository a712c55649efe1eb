"""Stock movement between a day and the calendar day before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelftrail.functions.casts import to_number
from shelftrail.functions.dates import as_date, day
from shelftrail.operators.history import price_changes
from shelftrail.operators.spread_join import (
    counted_keys, hot_keys, merge_hot_copies, repeat_rows, spread_join, with_copies,
)
from shelftrail.operators.views import on_day

# Rows of equal price in a stable order, which also lets a sort split them.
_TIES = ["code", "title", "url", "availability", "units_sold"]


def _units(availability: str, strict: bool) -> Column:
    return F.coalesce(to_number(availability, strict), F.lit(0.0))


def _earlier(products: DataFrame, units: Column) -> DataFrame:
    """Rows as the earlier side: they describe what moves by the next calendar day."""
    return products.select(
        F.date_add("import_date", 1).alias("target_date"),
        "code", "title", "url", "price_gbp", units.alias("earlier_units"),
    )


def _later(products: DataFrame, units: Column) -> DataFrame:
    """Rows as the later side, equal ones counted.

    Only the availability of the later day is used, so rows that agree on it are one
    row with a count. A code listed many times a day is combined before the shuffle
    and meets the earlier rows once per distinct availability.
    """
    return products.groupBy(
        F.col("import_date").alias("target_date"), "code", units.alias("later_units")
    ).agg(F.count(F.lit(1)).alias("copies"))


def _match(
    earlier: DataFrame, later: DataFrame, keys: list[str], how: str, hot: DataFrame | None = None
) -> DataFrame:
    """Earlier rows (with `earlier_copies`) beside the later day, `copies` being pairs."""
    pairs = spread_join(earlier, later, keys, how, hot)
    return pairs.withColumn("copies", F.col("earlier_copies") * F.coalesce("copies", F.lit(1)))


def _sold(pairs: DataFrame) -> DataFrame:
    """Matched days with fewer units on the later one; an absent item has none left."""
    later = F.coalesce("later_units", F.lit(0.0))
    sold = F.col("earlier_units") - later
    return pairs.where(sold > 0).select(
        F.col("target_date").alias("import_date"), "code", "title", "url", "price_gbp",
        later.alias("availability"), sold.alias("units_sold"), "copies",
    )


def _changes(
    products: DataFrame, median: str, history: DataFrame | None, hot: DataFrame | None = None, volume: int | None = None
) -> DataFrame:
    if history is None:
        return price_changes(products, median, hot, volume)
    return history.select("code", "price_changes_count")


def snapshot_days(products: DataFrame) -> DataFrame:
    return products.select(F.col("import_date").alias("target_date")).distinct()


def units_sold_all(
    products: DataFrame,
    median: str = "exact",
    strict: bool = False,
    count_vanished: bool = True,
    as_rows: bool = False,
    history: DataFrame | None = None,
) -> DataFrame:
    """Units sold for every day that has a snapshot, over the whole history.

    Title, address and price are those of the earlier day. An item missing on the
    later day is sold out unless `count_vanished` is off. Listed by day and price.
    A code listed m times and then n times gives up to m * n equal rows in a join. They
    come as one row per distinct row of the earlier and availability of the later day,
    with their number in `copies`; `as_rows` repeats them instead.
    """
    # One row per calendar day: the DATE type bounds this list, so it may be broadcast.
    days = F.broadcast(snapshot_days(products))
    units = _units("availability", strict)
    hot, volume = counted_keys(products, "code")
    earlier = _earlier(products, units).join(days, "target_date", "left_semi")
    pairs = _match(
        merge_hot_copies(earlier, "code", hot, "earlier_copies"), _later(products, units),
        ["code", "target_date"], "left" if count_vanished else "inner", hot,
    )
    counted = spread_join(_sold(pairs), _changes(products, median, history, hot, volume), ["code"], "left", hot)
    listed = counted.orderBy(
        F.col("import_date").desc_nulls_last(), F.col("price_gbp").desc_nulls_last(), *_TIES
    )
    return repeat_rows(listed) if as_rows else listed


def _day_pairs(products: DataFrame, as_of, how: str, units: Column, hot: DataFrame | None = None) -> DataFrame:
    earlier = _earlier(on_day(products, as_of, days_before=1), units).drop("target_date")
    later = _later(on_day(products, as_of), units).drop("target_date")
    pairs = _match(with_copies(earlier, "earlier_copies"), later, ["code"], how, hot)
    return pairs.withColumn("target_date", day(as_of))


def units_sold_by_date(
    products: DataFrame,
    as_of=None,
    median: str = "exact",
    strict: bool = False,
    count_vanished: bool = True,
    with_counts: bool = True,
    history: DataFrame | None = None,
) -> DataFrame:
    """Units sold between the day before `as_of` and `as_of`, dearest first.

    Without a snapshot on `as_of` everything listed the day before counts as sold.
    `history` is a `code_history` computed before, to be shared between reports.
    """
    as_of = as_date(as_of)
    how = "left" if count_vanished else "inner"
    hot = hot_keys(on_day(products, as_of, days_before=1), "code")
    sold = _sold(_day_pairs(products, as_of, how, _units("availability", strict), hot))
    if with_counts:
        sold = spread_join(sold, _changes(products, median, history), ["code"], "left", hot)
    return repeat_rows(sold.orderBy(F.col("price_gbp").desc_nulls_last(), *_TIES))


def stock_label(availability: str) -> Column:
    """Code and availability as one text; NULL when either is missing."""
    return F.concat(F.col("code"), F.lit("-"), F.col(availability))


def units_moved(products: DataFrame, as_of=None, only_sales: bool = False) -> DataFrame:
    """Availability changes of items listed on both days, restocks as negative units."""
    pairs = _day_pairs(products, as_date(as_of), "inner", F.col("availability"))
    changed = pairs.where(stock_label("later_units") != stock_label("earlier_units"))
    moved = changed.select(
        F.col("target_date").alias("import_date"), "code", "title", "url", "price_gbp",
        to_number("later_units").alias("availability"),
        (to_number("earlier_units") - to_number("later_units")).alias("units_sold"),
        "copies",
    )
    if only_sales:
        moved = moved.where(F.col("units_sold") > 0)
    return repeat_rows(moved.orderBy(F.col("price_gbp").desc_nulls_last(), *_TIES))
