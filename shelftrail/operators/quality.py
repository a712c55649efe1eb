"""Finding and repairing doubtful rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelftrail.functions.casts import to_number
from shelftrail.functions.dates import as_date, day
from shelftrail.operators.spread_join import hot_keys, merge_hot_copies, repeat_rows, spread_join
from shelftrail.operators.views import on_day, unified_price
from shelftrail.schema import CANONICAL_COLUMNS
from shelftrail.sinks.writers import reload_days

# What makes two rows of a code the same item.
IDENTITY = ["code", "title", "size", "style", "country", "type"]


def row_counts(stocks: DataFrame) -> DataFrame:
    return (
        stocks.groupBy("import_date").agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("import_date").desc_nulls_last())
    )


def duplicate_codes(day_rows: DataFrame) -> DataFrame:
    """Codes listed more than once."""
    return (
        day_rows.groupBy("code").agg(F.count(F.lit(1)).alias("duplicate_count"))
        .where(F.col("duplicate_count") > 1)
    )


def averaged_duplicates(day_rows: DataFrame, digits: int | None = None) -> DataFrame:
    """One row per duplicated item: whole-number mean availability and mean price.

    Rows are summed up per item before the duplicated codes are looked up, so a code
    with very many copies reaches the join as one row per item.
    """
    items = day_rows.groupBy(*IDENTITY).agg(
        F.round(F.avg(to_number("availability")), 0).alias("availability"),
        F.avg("price_gbp").alias("price_gbp"),
        F.count(F.lit(1)).alias("__rows"),
    )
    codes = (
        items.groupBy("code").agg(F.sum("__rows").alias("__rows"))
        .where(F.col("__rows") > 1).select("code")
    )
    price = F.col("price_gbp") if digits is None else F.round("price_gbp", digits)
    return spread_join(items, codes, ["code"], "left_semi").select(
        *IDENTITY, "availability", price.alias("price_gbp")
    )


def delete_by_key(rows: DataFrame, keys: DataFrame, key: str = "code") -> DataFrame:
    """Rows whose key is not among `keys`; rows without a key stay."""
    hot = hot_keys(rows, key)
    counted = merge_hot_copies(rows, key, hot)
    return repeat_rows(spread_join(counted, keys.select(key).distinct(), [key], "left_anti", hot))


def repaired_day(stocks: DataFrame, as_of, digits: int | None = None) -> DataFrame:
    """The rows of one day with duplicated items replaced by their averages.

    The replacement rows know only the older layout's columns; the date they lack is
    filled in. Write the result over that day's partition.
    """
    rows = on_day(stocks, as_date(as_of)).select(*CANONICAL_COLUMNS)
    kept = delete_by_key(rows, duplicate_codes(rows))
    averaged = averaged_duplicates(rows, digits).withColumn(
        "availability", F.col("availability").cast("bigint").cast("string")
    )
    return (
        kept.unionByName(averaged, allowMissingColumns=True)
        .withColumn("import_date", F.coalesce("import_date", day(as_of)))
    )


def repair_day(stocks: DataFrame, path: str, as_of, digits: int | None = None) -> None:
    """`repaired_day`, written over that day of the table at `path`."""
    reload_days(repaired_day(stocks, as_of, digits), path, [as_of])


def replace_subset(rows: DataFrame, corrected: DataFrame, key: str = "code") -> DataFrame:
    """`rows` without the keys of `corrected`, plus `corrected`."""
    return delete_by_key(rows, corrected, key).unionByName(corrected, allowMissingColumns=True)


def same_title_different_code(products: DataFrame) -> DataFrame:
    """Distinct code, title, price and address where one title has several codes."""
    offers = products.select("code", "title", "price_gbp", "url").distinct()
    titles = (
        offers.where(F.col("title").isNotNull())
        .groupBy("title").agg(F.count_distinct("code").alias("codes"))
        .where(F.col("codes") > 1).select("title")
    )
    return spread_join(offers, titles, ["title"], "left_semi")


def null_price_audit(stocks: DataFrame) -> DataFrame:
    """Rows without a price with VAT, as they are and as the product view shows them."""
    return stocks.where(F.col("price_incl_vat").isNull()).select(
        "code", "import_date", "price_gbp", "price_incl_vat",
        unified_price().alias("unified_price"),
        F.coalesce("price_incl_vat", F.lit(0.0)).alias("filled_price_incl_vat"),
    )
