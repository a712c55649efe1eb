"""All reports of one shop under one roof, for interactive use."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from shelftrail import session
from shelftrail.functions.dates import as_date, day, day_text
from shelftrail.operators.history import code_history
from shelftrail.operators.movement import units_sold_all, units_sold_by_date
from shelftrail.operators.views import product_view, today_view
from shelftrail.plans import reports
from shelftrail.sinks.writers import write_dated_csv


def _text_dates(report: DataFrame) -> DataFrame:
    return report.withColumn("import_date", day_text("import_date"))


class StockReports:
    """Reports on one product type as of one day (None: the session's current date).

    The per-code history behind several reports is computed once, on first need, and
    kept as a table in the shared folder until `session.clear_scratch`. Make a new object
    after new data arrived. Method names are fixed values: the reports' public names.
    """

    def __init__(self, stocks: DataFrame, product_type: str, as_of=None, median: str = "exact"):
        self.products = product_view(stocks, product_type)
        self.as_of = as_date(as_of)
        self.median = median
        self._history: DataFrame | None = None

    @property
    def history(self) -> DataFrame:
        if self._history is None:
            self._history = session.materialize(code_history(self.products, self.median), "code-history")
        return self._history

    def today(self) -> DataFrame:
        return today_view(self.products, self.as_of)

    def query_discounted_items(self) -> DataFrame:
        return reports.discounted_items(self.products, self.as_of, history=self.history)

    def stocks_and_median_values(self) -> DataFrame:
        return _text_dates(reports.daily_stock_summary(self.products, self.median))

    def stocks_and_median_values_by_code(self, codes: Iterable[str] | None = None) -> DataFrame:
        return _text_dates(reports.code_series(self.products, codes, self.median))

    def units_sold_by_date(self, target_date, output_folder: str | None = None) -> DataFrame:
        """With `output_folder` also written there as sales_YYYY-MM-DD.csv."""
        sold = units_sold_by_date(self.products, target_date, history=self.history)
        if output_folder:
            target = as_date(target_date) or self.products.sparkSession.range(1).select(day(None)).first()[0]
            write_dated_csv(sold, output_folder, "sales", target, separator="-")
        return _text_dates(sold)

    def previous_day_units_sold(self, output_folder: str | None = None) -> DataFrame:
        return self.units_sold_by_date(self.as_of, output_folder)

    def units_sold_all_time(self) -> DataFrame:
        return units_sold_all(self.products, as_rows=True, history=self.history)

    def price_search(self) -> DataFrame:
        return reports.price_search(self.products, self.as_of, history=self.history)
