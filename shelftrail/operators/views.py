"""The canonical table seen as one product type, or as one day of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelftrail.functions.dates import day
from shelftrail.schema import CANONICAL_COLUMNS


def unified_price() -> Column:
    """The older layout's price, or the newer one's price with VAT."""
    return F.coalesce("price_gbp", "price_incl_vat")


def product_view(stocks: DataFrame, product_type: str) -> DataFrame:
    """Rows of one product type with a single price column and no missing VAT prices."""
    return (
        stocks.where(F.col("type") == product_type)
        .select(*CANONICAL_COLUMNS)
        .withColumns({
            "price_gbp": unified_price(),
            "price_ex_vat": F.coalesce("price_ex_vat", F.lit(0.0)),
            "price_incl_vat": F.coalesce("price_incl_vat", F.lit(0.0)),
        })
    )


def on_day(products: DataFrame, as_of=None, days_before: int = 0) -> DataFrame:
    return products.where(F.col("import_date") == F.date_sub(day(as_of), days_before))


def today_view(products: DataFrame, as_of=None) -> DataFrame:
    return on_day(products, as_of).select("import_date", "code", "title", "price_gbp", "url")


def register_views(spark: SparkSession, stocks: DataFrame, product_type: str, as_of=None) -> None:
    """Create or replace the temporary views that SQL users query by name."""
    from shelftrail.operators.movement import units_sold_all

    products = product_view(stocks, product_type)
    for name, frame in {
        "stocks_view": stocks.select(*CANONICAL_COLUMNS),
        "product_stocks_view": products,
        "product_stocks_view_today": today_view(products, as_of),
        "product_units_sold_all_time": units_sold_all(products, as_rows=True),
    }.items():
        frame.createOrReplaceTempView(name)


def drop_views(spark: SparkSession) -> None:
    for name in (
        "product_units_sold_all_time", "product_stocks_view_today", "product_stocks_view", "stocks_view",
    ):
        spark.catalog.dropTempView(name)
