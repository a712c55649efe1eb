"""The daily run: take in new snapshots, export the day's sales, list the alerts."""

from __future__ import annotations

import argparse
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession

from shelftrail import session
from shelftrail.functions.dates import as_date, day
from shelftrail.operators.movement import units_sold_by_date
from shelftrail.operators.state import build_state, history_from_state, read_state, update_state
from shelftrail.operators.views import product_view, register_views
from shelftrail.plans.reports import discount_alert, discounted_items
from shelftrail.sinks import versions
from shelftrail.sinks.writers import write_csv, write_dated_csv
from shelftrail.sources.tables import read_stocks
from shelftrail.streaming.incremental import ingest_new_snapshots


def run_day(
    spark: SparkSession, landing: str, lake: str, product_type: str, as_of=None, median: str = "exact"
) -> DataFrame:
    """Runs all steps below the `lake` folder and returns the alert list.

    The state of past days is kept for each product type ever asked for: a run computes it for
    the days that it took in, and for all days only when a type is new.
    """
    as_of = as_date(as_of) or spark.range(1).select(day(None)).first()[0]
    table, states = f"{lake}/stocks", f"{lake}/state"
    name = f"{quote(product_type, safe='')}+{median}"

    def refresh(session_: SparkSession, days: list) -> None:
        for known in session.folder_names(session_, states):
            type_, _, how = known.rpartition("+")
            update_state(product_view(read_stocks(session_, table), unquote(type_)), f"{states}/{known}", days, how)

    if not session.folder_names(spark, table):
        versions.create(spark, table)
    ingest_new_snapshots(spark, landing, table, f"{lake}/ingest_checkpoint", on_days=refresh)
    stocks = read_stocks(spark, table)
    register_views(spark, stocks, product_type, as_of)
    products = product_view(stocks, product_type)
    # A first build that failed leaves a folder, but no sign of success.
    if "_SUCCESS" not in session.folder_names(spark, f"{states}/{name}"):
        build_state(products, f"{states}/{name}", median)
    history = session.materialize(history_from_state(read_state(spark, f"{states}/{name}")), "code-history")
    sales = units_sold_by_date(products, as_of, history=history)
    write_dated_csv(sales, f"{lake}/sales", "sales", as_of)
    alerts = discount_alert(discounted_items(products, as_of, history=history))
    write_csv(alerts, f"{lake}/alerts/alerts_{as_of:%Y_%m_%d}.csv")
    return alerts


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("landing")
    parser.add_argument("lake")
    parser.add_argument("product_type")
    parser.add_argument("--as-of")
    parser.add_argument("--median", choices=["exact", "approx"], default="exact")
    options = parser.parse_args()
    spark = session.build("daily stock run")
    run_day(spark, options.landing, options.lake, options.product_type, options.as_of, options.median)


if __name__ == "__main__":
    main()
