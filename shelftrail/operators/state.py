"""What the reports need of past days, kept in a table of one row per code and day.

A day's rows are final once its snapshot is in, so its state is computed from that day alone
and only replaced days are computed again. What spans days (numbers of price changes, highest
prices, lowest prices with their counts and first days) is merged from the days' states, each
of which holds a few numbers whatever the number of rows behind it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from shelftrail.functions.casts import to_number
from shelftrail.functions.dates import as_date, day
from shelftrail.operators.history import history_of_days
from shelftrail.operators.medians import group_medians
from shelftrail.operators.ranking import listed_lows
from shelftrail.sinks.writers import reload_days

STATE = (
    "code string, median double, highest double, row_count bigint, total_availability double, "
    "lows array<struct<price:double,rows:bigint>>, import_date date"
)


def day_state(products: DataFrame, median: str = "exact") -> DataFrame:
    """One row per code and day: median, highest, row_count, total_availability and lows.

    lows are the two lowest known prices, ascending, each with its number of rows. Rows are
    counted per price before the shuffle, and tasks pass on the two lowest of a code only.
    Rows without a day aren't part of any state.
    """
    rows = products.where(F.col("import_date").isNotNull())
    keys = ["code", "import_date"]
    daily = group_medians(rows, keys, "price_gbp", median, sums={"total_availability": to_number("availability")})
    prices = rows.where("price_gbp IS NOT NULL").groupBy(*keys, F.col("price_gbp").cast("double").alias("price")).agg(F.count("*").alias("rows"))
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("price"))
    lowest = prices.withColumn("__nth", nth).where("__nth <= 2").groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.array_sort(F.collect_list(F.struct("price", "rows"))).alias("lows")
    )
    same = F.col("code").eqNullSafe(F.col("__code")) & (F.col("import_date") == F.col("__import_date"))
    return daily.join(lowest, same, "left").select(
        "code", "median", "highest", "row_count", "total_availability", "lows", "import_date"
    )


def build_state(products: DataFrame, path: str, median: str = "exact") -> None:
    """The state of all days, in place of whatever is at `path`. Only a finished build has the file _SUCCESS."""
    day_state(products, median).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
        "import_date"
    ).parquet(path)


def update_state(products: DataFrame, path: str, days: Iterable, median: str = "exact") -> None:
    """Compute the state of some days anew and replace them in the table at `path`.

    Nothing but those days is read or written; a day without rows (any more) becomes
    empty. Running it again changes nothing.
    """
    days = sorted({as_date(d) for d in days})
    reload_days(day_state(products.where(F.col("import_date").isin(days)), median), path, days)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def history_from_state(state: DataFrame, until=None) -> DataFrame:
    """`code_history` of the days in a state."""
    days = state if until is None else state.where(F.col("import_date") <= day(until))
    return history_of_days(days, days.count())


def lowest_prices(state: DataFrame) -> DataFrame:
    """code and lows: its two lowest prices ever, each with its rows and the first day it was asked.

    The two lowest of all days are among the two lowest of each day that has them, so
    counts and first days add up without a window over the rows. At most two prices per
    calendar day and code meet in one place.
    """
    prices = state.where("code IS NOT NULL").select("code", "import_date", F.explode("lows").alias("low")).groupBy("code", "low.price").agg(
        F.sum("low.rows").alias("rows"), F.min("import_date").alias("first_date")
    )
    return prices.groupBy("code").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("price", "rows", "first_date"))), 1, 2).alias("lows")
    )


def new_lows_from_state(state: DataFrame, products: DataFrame, as_of=None) -> DataFrame:
    """`new_lows`, reading only the day `as_of` of the products themselves."""
    lows = lowest_prices(state).where((F.size("lows") == 2) & (F.col("lows")[0]["rows"] == 1))

    def known(i: int):
        low = F.col("lows")[i]
        return F.struct(low["price"].alias("price_gbp"), low["first_date"].alias("first_date"))

    return listed_lows(lows.select("code", known(0).alias("now"), known(1).alias("before")), products, as_of)
