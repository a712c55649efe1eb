"""Lowest prices per code, ranked like SQL RANK."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelftrail.functions.dates import day
from shelftrail.operators.views import today_view


def price_ranks(products: DataFrame, max_rank: int = 2) -> DataFrame:
    """One row per (code, price) among the lowest prices of a code.

    `price_rank` is the RANK that every row of that price has: 1 + the rows that are
    cheaper, so ranks have gaps. Rows of equal price are counted before the shuffle;
    of the distinct prices each task passes on only the `max_rank` lowest per code
    (a rank of k or less cannot lie beyond the k-th distinct price). NULL ranks last.
    """
    prices = products.groupBy("code", "price_gbp").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("import_date").alias("first_date")
    )
    lowest_first = Window.partitionBy("code").orderBy(F.col("price_gbp").asc_nulls_last())
    lowest = prices.withColumn("__nth", F.row_number().over(lowest_first)).where(
        F.col("__nth") <= max_rank
    )
    cheaper = F.sum("row_count").over(lowest_first.rowsBetween(Window.unboundedPreceding, -1))
    return (
        lowest.withColumn("price_rank", F.coalesce(cheaper, F.lit(0)) + 1)
        .where(F.col("price_rank") <= max_rank)
        .select("code", "price_gbp", "price_rank", "row_count", "first_date")
    )


def new_lows(products: DataFrame, as_of=None) -> DataFrame:
    """Items whose all-time low is unique and was set on `as_of`.

    Rank 2 exists only where one single row has the lowest price, so the two lowest
    distinct prices of a code, with their counts and first dates, decide everything.
    That one row is then looked up among the day's offers.
    """
    lowest = price_ranks(products, 2)
    columns = F.struct("price_gbp", "first_date")
    per_code = lowest.groupBy("code").agg(
        F.max(F.when(F.col("price_rank") == 1, columns)).alias("now"),
        F.max(F.when(F.col("price_rank") == 2, columns)).alias("before"),
    )
    return listed_lows(per_code, products, as_of)


def listed_lows(per_code: DataFrame, products: DataFrame, as_of=None) -> DataFrame:
    """The offers of `as_of` behind lows set on that day.

    `per_code` has code and the price_gbp and first_date of its unique lowest price (`now`)
    and of the one next to it (`before`).
    """
    diff = F.col("before.price_gbp") - F.col("now.price_gbp")
    lows = per_code.where((F.col("now.first_date") == day(as_of)) & (diff > 0)).select(
        "code",
        F.col("now.price_gbp").alias("price_gbp"),
        F.col("now.first_date").alias("current_date"),
        F.col("before.price_gbp").alias("previous_price"),
        F.col("before.first_date").alias("previous_date"),
        diff.alias("price_diff"),
        (F.try_divide(diff, F.col("before.price_gbp")) * 100).alias("perc_saving"),
    )
    # The matching offer is a single row, so equal rows of the day can be merged first.
    offers = today_view(products, as_of).select("code", "price_gbp", "title", "url").distinct()
    return offers.join(lows, ["code", "price_gbp"]).select(
        "code", "title", "url", F.col("price_gbp").alias("current_minimum_price"),
        "current_date", "previous_price", "previous_date", "price_diff", "perc_saving",
    )
