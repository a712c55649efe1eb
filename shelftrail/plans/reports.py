"""The reports a shop analyst runs, each a DataFrame in, DataFrame out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window, functions as F

from shelftrail.functions.casts import percent_of, to_number
from shelftrail.functions.dates import day_text
from shelftrail.functions.text import title_age, title_distillery
from shelftrail.operators.filters import code_contains, code_in, text_matches, within
from shelftrail.operators.history import code_history, max_prices
from shelftrail.operators.medians import group_medians
from shelftrail.operators.reshape import fold
from shelftrail.operators.spread_join import counted_keys, in_tasks, repeat_rows, sorted_in_tasks, spread_join, with_copies
from shelftrail.operators.views import today_view


def discounted_items(
    products: DataFrame,
    as_of=None,
    median: str = "exact",
    plain: bool = False,
    until=None,
    history: DataFrame | None = None,
) -> DataFrame:
    """Items listed on `as_of` below their highest price ever, largest discount first.

    The saving is a percentage rounded to 4 places. `plain` rounds the fraction
    before it is turned into a percentage and leaves out the number of price changes.
    `history` is a `code_history` computed before, to be shared between reports.
    """
    if history is None:
        history = max_prices(products, until=until) if plain else code_history(products, median, until)
    offers = spread_join(with_copies(today_view(products, as_of)), history, ["code"], "inner")
    price = F.col("price_gbp").cast("double")
    discount = F.col("max_price") - price
    fraction = F.try_divide(discount, F.nullif(F.col("max_price"), F.lit(0.0)))
    saving = F.round(fraction, 4) * 100 if plain else F.round(percent_of(discount, F.col("max_price")), 4)
    items = (
        offers.where(discount > 0)
        .select(
            F.col("import_date").alias("current_date" if plain else "current_import_date"),
            "code", "title", "url",
            price.alias("current_price"),
            F.col("max_price").alias("old_price"),
            discount.alias("discount"),
            saving.alias("perc_saving"),
            *([] if plain else ["price_changes_count"]),
            "copies",
        )
        .orderBy(F.col("discount").desc_nulls_last(), "code", "title", "url")
    )
    return repeat_rows(items)


def discount_screen(
    items: DataFrame, low: float = 100, high: float = 5000, min_percent: float = 10.0, title: str = ""
) -> DataFrame:
    """Discounts within bounds, above a percentage, with a matching title."""
    return items.where(
        within("discount", low, high) & (F.col("perc_saving") > min_percent) & text_matches("title", title)
    ).orderBy(F.col("discount").desc_nulls_last(), "code", "title", "url")


def discount_alert(items: DataFrame, max_price: float = 500) -> DataFrame:
    """Affordable discounts, cheapest first."""
    return items.where(F.col("current_price") <= max_price).orderBy(
        F.col("current_price").asc_nulls_last(), "code", "title", "url"
    )


def daily_stock_summary(
    products: DataFrame, median: str = "exact", strict: bool = False, dates_as_text: bool = False
) -> DataFrame:
    """Rows, median price and total availability per day, largest total first."""
    daily = group_medians(
        products, ["import_date"], "price_gbp", median,
        sums={"total_availability": to_number("availability", strict)}, large_groups=True,
    )
    shown = day_text("import_date") if dates_as_text else F.col("import_date")
    return daily.select(
        F.col("row_count").alias("stock_count"),
        F.col("median").alias("median_price"),
        "total_availability",
        shown.alias("import_date"),
    ).orderBy(F.col("total_availability").desc_nulls_last())


def daily_counts_and_medians(products: DataFrame, median: str = "exact") -> DataFrame:
    """The two-measure form, latest day first."""
    return daily_stock_summary(products, median).select(
        "stock_count", "median_price", "import_date"
    ).orderBy(F.col("import_date").desc_nulls_last())


def daily_long(summary: DataFrame) -> DataFrame:
    """Daily summary as one row per day and measure."""
    return fold(summary, ["import_date"], ["stock_count", "median_price"])


def code_series(
    products: DataFrame,
    codes: Iterable[str] | None = None,
    median: str = "exact",
    strict: bool = False,
    contains: bool = False,
    state: DataFrame | None = None,
) -> DataFrame:
    """Median price and availability per day and code, with each code's price changes.

    `codes` limits the scan to exact codes, or with `contains` to codes in which one
    of the texts occurs; None means all. Latest day first. With a `state` (see
    `operators.state`) the products aren't read.
    """
    rows = products if state is None else state
    if codes is not None:
        rows = rows.where(code_contains(codes) if contains else code_in(codes))
    hot, volume = counted_keys(rows, "code") if state is None and median == "exact" else (None, rows.count())
    series = (rows if state is not None else group_medians(
        rows, ["code", "import_date"], "price_gbp", median,
        sums={"total_availability": to_number("availability", strict)}, hot=hot, volume=volume,
    )).where(F.col("code").isNotNull())
    # A code has one row per day here. The distinct medians of a code are the ranks
    # without gaps that its known medians take.
    by_price = Window.partitionBy("code").orderBy(F.col("median").asc_nulls_last())
    rank = F.when(F.col("median").isNotNull(), F.dense_rank().over(by_price))
    ranked = (
        in_tasks(series, volume, "code").withColumn("__rank", rank)
        .withColumn("price_changes_count", F.coalesce(F.max("__rank").over(Window.partitionBy("code")), F.lit(0)).cast("bigint"))
        .select(F.col("median").alias("median_price"), "total_availability", "import_date", "code", "price_changes_count")
    )
    return sorted_in_tasks(ranked, volume, F.col("import_date").desc_nulls_last(), F.col("code").asc())


def price_search(
    products: DataFrame,
    as_of=None,
    median: str = "exact",
    with_counts: bool = True,
    history: DataFrame | None = None,
) -> DataFrame:
    """What is listed on `as_of`, with the number of price changes so far."""
    listed = today_view(products, as_of).select("import_date", "code", "title", "price_gbp", "url")
    if not with_counts:
        return listed
    if history is None:
        history = code_history(products, median)
    counts = history.select("code", "price_changes_count")
    return repeat_rows(spread_join(with_copies(listed), counts, ["code"], "left")).select(
        *listed.columns, "price_changes_count"
    )


def price_screen(rows: DataFrame, low: float, high: float, title: str = "") -> DataFrame:
    return rows.where(within("price_gbp", low, high) & text_matches("title", title)).orderBy(
        F.col("price_gbp").desc_nulls_last(), "title"
    )


def max_price_by_title(products: DataFrame) -> DataFrame:
    return (
        products.groupBy("title").agg(F.max("price_gbp").alias("price_gbp"))
        .orderBy(F.col("price_gbp").desc_nulls_last(), "title")
    )


def title_features(rows: DataFrame, trailing_number: bool = True) -> DataFrame:
    """Rows with the distillery and age (or year) read off the title."""
    return rows.withColumns({
        "distillery": title_distillery(F.col("title")),
        "year_age": title_age(F.col("title"), trailing_number),
    })


def totals(products: DataFrame) -> DataFrame:
    return products.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum("price_gbp").alias("price_sum"),
        F.avg("price_gbp").alias("price_avg"),
    )
