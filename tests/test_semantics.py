"""One small case per rule that is easy to get wrong."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelftrail.functions.casts import to_number
from shelftrail.functions.dates import as_date, file_date
from shelftrail.functions.text import drop_punctuation, strip, title_age, title_distillery
from shelftrail.operators import filters, history, movement, quality, ranking, reshape, views
from shelftrail.plans import reports
from shelftrail.plans.shop import StockReports

D1, D2, D3, D4 = (date(2024, 3, d) for d in (1, 2, 3, 4))


def row(code, day, price=10.0, availability="1", **more):
    return {"code": code, "import_date": day, "price_gbp": price, "availability": availability,
            "type": "Whisky", "title": f"title {code}", "url": f"u/{code}", **more}


def column(spark, values, expression, type_="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[1] for r in sorted(df.select("i", expression(F.col("v"))).collect())]


def test_tolerant_numbers(spark):
    got = column(spark, ["1", " 2.5 ", "n/a", "", "3d", "4f", "1e3", None], to_number)
    assert got == [1.0, 2.5, None, None, None, None, 1000.0, None]


def test_strict_number_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(spark, ["n/a"], lambda v: to_number(v, strict=True))
    with pytest.raises(Exception, match="not a number: 1d"):
        column(spark, ["1d"], lambda v: to_number(v, strict=True))
    assert column(spark, ["1", " 2.5 ", None], lambda v: to_number(v, strict=True)) == [1.0, 2.5, None]


def test_file_dates(spark):
    paths = ["/a/full-stock-list_2024_03_28.csv", "/a/x_2024_13_28.csv", "/a/none.csv"]
    assert column(spark, paths, file_date) == [date(2024, 3, 28), None, None]


def test_day_arguments():
    assert as_date(None) is None
    assert as_date("2024-03-01") == as_date(datetime(2024, 3, 1, 9)) == as_date(D1) == D1


def test_strip_and_punctuation(spark):
    assert column(spark, ["\t\xa0a b \n", "", None], strip) == ["a b", "", None]
    assert column(spark, ["Château d'Or, 12!", "`x_y`"], drop_punctuation) == ["Château dOr 12", "x_y"]


def test_title_features(spark):
    titles = ["Oldcastle 29 Year Old", "1984 Vintage", "29 Year Old", "No number", None]
    assert column(spark, titles, title_distillery) == ["Oldcastle", None, "Year", None, None]
    assert column(spark, titles, title_age) == ["29", "1984", "29", None, None]
    leading = column(spark, titles, lambda v: title_age(v, trailing_number=False))
    assert leading == [None, "1984", "29", None, None]


def test_median_interpolates_and_approximation_does_not(stocks_of):
    stocks = stocks_of(*[row("A", D1, p) for p in (10.0, 20.0, 30.0, 40.0)])
    for method, expected in (("exact", 25.0), ("approx", 20.0)):
        assert reports.daily_stock_summary(stocks, method).first()["median_price"] == expected


def test_days_without_a_price_are_no_price_change(stocks_of):
    stocks = stocks_of(row("A", D1), row("A", D2, None), row("A", D3, 11.0), row("B", D1, None))
    assert dict(history.price_changes(stocks).collect()) == {"A": 2, "B": 0}


def test_summary_sorts_by_total_availability(stocks_of):
    stocks = stocks_of(row("A", D1, availability="9"), row("A", D2, availability="1"), row("A", D3, availability="5"))
    assert [r["import_date"] for r in reports.daily_stock_summary(stocks).collect()] == [D1, D3, D2]


def test_dirty_availability(stocks_of):
    stocks = stocks_of(row("A", D1, availability="n/a"), row("B", D1, availability="2"))
    assert reports.daily_stock_summary(stocks).first()["total_availability"] == 2.0
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        reports.daily_stock_summary(stocks, strict=True).collect()


def test_vanished_item_is_sold_out(stocks_of):
    stocks = stocks_of(row("A", D1, availability="3"), row("B", D1), row("B", D2))
    sold = movement.units_sold_by_date(stocks, D2).collect()
    assert [(r["code"], r["availability"], r["units_sold"]) for r in sold] == [("A", 0.0, 3.0)]
    assert movement.units_sold_by_date(stocks, D2, count_vanished=False).isEmpty()


def test_day_without_snapshot(stocks_of):
    stocks = stocks_of(row("A", D1, availability="3"), row("A", D3, availability="3"))
    assert movement.units_sold_by_date(stocks, D2).count() == 1
    # No snapshot on D2 and none the day before D3: the history has nothing to compare.
    assert movement.units_sold_all(stocks).isEmpty()


def test_previous_means_calendar_day(stocks_of):
    stocks = stocks_of(row("A", D1, availability="9"), row("A", D3, availability="1"), row("B", D2))
    sold = {(r["code"], r["import_date"]): r["units_sold"] for r in movement.units_sold_all(stocks).collect()}
    assert sold == {("A", D2): 9.0, ("B", D3): 1.0}


def test_sold_rows_describe_the_earlier_day(stocks_of):
    stocks = stocks_of(
        row("A", D1, 10.0, "3", title="old", url="u1"), row("A", D2, 12.0, "1", title="new", url="u2")
    )
    sold = movement.units_sold_by_date(stocks, D2).first()
    assert (sold["title"], sold["url"], sold["price_gbp"], sold["price_changes_count"]) == ("old", "u1", 10.0, 2)


def test_copies_multiply(stocks_of):
    stocks = stocks_of(*[row("A", D1, availability="3")] * 2, *[row("A", D2, availability="1")] * 3)
    assert movement.units_sold_by_date(stocks, D2).count() == 6
    assert movement.units_sold_all(stocks, as_rows=True).count() == 6
    assert [r["copies"] for r in movement.units_sold_all(stocks).collect()] in ([6], [2, 2, 2], [3, 3])
    assert movement.units_moved(stocks, D2).count() == 6


def test_moves_show_restocks_and_skip_the_unchanged(stocks_of):
    stocks = stocks_of(
        row("A", D1, availability="1"), row("A", D2, availability="4"),
        row("B", D1), row("B", D2), row("C", D1),
        row("D", D1, availability="2"), row("D", D2, availability=None),
    )
    assert [(r["code"], r["units_sold"]) for r in movement.units_moved(stocks, D2).collect()] == [("A", -3.0)]
    assert movement.units_moved(stocks, D2, only_sales=True).isEmpty()


def test_discount_against_later_prices_too(stocks_of):
    stocks = stocks_of(row("A", D1, 50.0), row("A", D2, 40.0), row("A", D3, 80.0), row("B", D2, 5.0))
    item = reports.discounted_items(stocks, D2).collect()
    assert [(r["code"], r["old_price"], r["discount"], r["perc_saving"]) for r in item] == [("A", 80.0, 40.0, 50.0)]
    assert reports.discounted_items(stocks, D2, until=D2).first()["old_price"] == 50.0


def test_plain_discounts_heed_the_end_of_history(stocks_of):
    stocks = stocks_of(row("A", D1, 50.0), row("A", D2, 40.0), row("A", D3, 80.0))
    for plain in (False, True):
        items = reports.discounted_items(stocks, D2, plain=plain, until=D2).collect()
        assert [i["old_price"] for i in items] == [50.0]


def test_order_of_reports(stocks_of):
    """Alerts cheapest first, screens by discount or price, the two-measure summary by day."""
    stocks = stocks_of(*[row(c, d, p) for c, p1, p2 in (("A", 90.0, 30.0), ("B", 90.0, 10.0), ("C", 50.0, 20.0)) for d, p in ((D1, p1), (D2, p2))])
    items = reports.discounted_items(stocks, D2)
    assert [r["code"] for r in items.collect()] == ["B", "A", "C"]
    assert [r["code"] for r in reports.discount_alert(items).collect()] == ["B", "C", "A"]
    assert [r["code"] for r in reports.discount_screen(items, 0, 100).collect()] == ["B", "A", "C"]
    assert [r["code"] for r in reports.price_screen(reports.price_search(stocks, D2), 0, 100).collect()] == ["A", "C", "B"]
    assert [r["import_date"] for r in reports.daily_counts_and_medians(stocks).collect()] == [D2, D1]


def test_shared_history(stocks_of):
    stocks = stocks_of(row("A", D1, 50.0, "3"), row("A", D2, 40.0), row("B", D1), row("B", D2))
    shared = history.code_history(stocks)
    for report in (
        lambda **h: reports.discounted_items(stocks, D2, **h), lambda **h: reports.price_search(stocks, D2, **h),
        lambda **h: movement.units_sold_by_date(stocks, D2, **h), lambda **h: movement.units_sold_all(stocks, **h),
    ):
        assert sorted(report(history=shared).collect()) == sorted(report().collect())


def test_highest_price_of_zero(stocks_of):
    stocks = stocks_of(row("A", D1, 0.0), row("A", D2, -1.0))
    assert reports.discounted_items(stocks, D2).first()["perc_saving"] is None
    assert reports.discounted_items(stocks, D2, plain=True).first()["perc_saving"] is None


def test_screen_bounds(stocks_of):
    stocks = stocks_of(
        row("A", D1, 200.0), row("A", D2, 100.0),                     # discount 100, 50 %
        row("B", D1, 1000.0), row("B", D2, 900.0),                    # discount 100, exactly 10 %
        row("C", D1, 200.0, title=None), row("C", D2, 100.0, title=None),
        row("D", D1, 199.0), row("D", D2, 100.0),                     # discount 99
    )
    items = reports.discounted_items(stocks, D2)
    assert [r["code"] for r in reports.discount_screen(items, 100, 2000, 10.0, "TITLE").collect()] == ["A"]
    assert [r["code"] for r in reports.discount_alert(items, 100).collect()][:1] != ["B"]


def test_price_screen_includes_both_ends(stocks_of):
    rows = views.today_view(stocks_of(*[row(c, D1, p) for c, p in (("A", 1.0), ("B", 2.0), ("C", 3.0))]), D1)
    assert [r["code"] for r in reports.price_screen(rows, 1, 2, "").collect()] == ["B", "A"]


def test_code_filters(stocks_of):
    stocks = stocks_of(*[row(c, D1) for c in ("HED1", "HED12", "hed1x", "A.B", "AxB")])

    def codes(condition):
        return sorted(r["code"] for r in stocks.where(condition).collect())

    assert codes(filters.code_in([" HED1", "HED1", ""])) == ["HED1"]
    assert codes(filters.code_in([])) == []
    assert codes(filters.code_contains(["hed1"])) == ["HED1", "HED12", "hed1x"]
    assert codes(filters.code_contains(["a.b"])) == ["A.B"]
    assert filters.split_codes("A, B,,A ,") == ["A", "B"]
    assert reports.code_series(stocks, []).isEmpty()


def test_rank_has_gaps(stocks_of):
    stocks = stocks_of(
        row("A", D1, 5.0), row("A", D2, 5.0), row("A", D3, 7.0),
        row("B", D1, 5.0), row("B", D2, 7.0), row("B", D3, None), row("C", D1, None),
    )
    ranks = {(r["code"], r["price_gbp"], r["price_rank"], r["row_count"]) for r in ranking.price_ranks(stocks, 3).collect()}
    assert ranks == {("A", 5.0, 1, 2), ("A", 7.0, 3, 1), ("B", 5.0, 1, 1), ("B", 7.0, 2, 1), ("B", None, 3, 1), ("C", None, 1, 1)}


def test_new_low_must_be_unique_and_today(stocks_of):
    stocks = stocks_of(
        row("A", D1, 9.0), row("A", D2, 8.0), row("A", D3, 5.0),      # new low
        row("B", D1, 5.0), row("B", D3, 5.0), row("B", D2, 9.0),      # seen before
        row("C", D1, 5.0), row("C", D3, 9.0),                         # low, but not today
        row("D", D3, 5.0),                                            # no earlier price
        row("E", D1, None), row("E", D3, 5.0),                        # only a NULL beside it
    )
    low = ranking.new_lows(stocks, D3).collect()
    assert [(r["code"], r["previous_price"], r["previous_date"], r["perc_saving"]) for r in low] == [("A", 8.0, D2, 37.5)]


def test_product_view_unifies_prices(stocks_of):
    stocks = stocks_of(
        row("A", D1, None, price_incl_vat=12.0, price_ex_vat=10.0), row("B", D1, 7.0), row("C", D1, type="Wine")
    )
    rows = {r["code"]: r for r in views.product_view(stocks, "Whisky").collect()}
    assert set(rows) == {"A", "B"}
    assert (rows["A"]["price_gbp"], rows["B"]["price_gbp"], rows["B"]["price_incl_vat"]) == (12.0, 7.0, 0.0)


def test_duplicate_repair(stocks_of):
    stocks = stocks_of(
        row("A", D1, 10.0, "1"), row("A", D1, 20.0, "4"), row("B", D1), row("A", D2), row(None, D1), row(None, D1),
    )
    fixed = quality.repaired_day(stocks, D1).collect()
    got = sorted((r["code"] or "", r["availability"], r["price_gbp"], r["import_date"]) for r in fixed)
    assert got == [("", "1", 10.0, D1), ("", "1", 10.0, D1), ("A", "3", 15.0, D1), ("B", "1", 10.0, D1)]


def test_same_title_different_code(stocks_of):
    stocks = stocks_of(
        row("A", D1, title="x"), row("B", D1, title="x"), row("A", D2, title="x"),
        row("C", D1, title="y"), row("C", D2, title="y"), row("D", D1, title=None), row("E", D1, title=None),
    )
    assert sorted(r["code"] for r in quality.same_title_different_code(stocks).collect()) == ["A", "B"]


def test_fold_and_levels(spark):
    df = spark.createDataFrame([("d", 1, 2.0, ["a", "b"])], "day string, n int, m double, c array<string>")
    assert sorted(map(tuple, reshape.fold(df, ["day"], ["n", "m"]).collect())) == [("d", "m", 2.0), ("d", "n", 1.0)]
    assert reshape.with_levels(df, "c", 3, "level").select("level_1", "level_2", "level_3").first()[:] == ("a", "b", None)
    assert reshape.with_levels(df, "c", 0, "level").columns == df.columns


def test_overlay(spark):
    df = spark.createDataFrame([("u", None), ("", "n")], "found_url string, found_name string")
    rows = reshape.overlay(df, {"url": "tu", "kind": "k", "name": "tn"}, {"url": "found_url", "name": "found_name"})
    assert [tuple(r) for r in rows.collect()] == [("u", "k", "tn"), ("tu", "k", "n")]


def test_empty_check(spark):
    assert filters.is_empty(spark.range(0)) and not filters.is_empty(spark.range(5))


def test_reports_of_a_shop(spark, stocks_of, tmp_path):
    stocks = stocks_of(row("A", D1, 50.0, "3"), row("A", D2, 40.0), row("B", D1), row("B", D2), row("C", D1, type="Wine"))
    shop = StockReports(stocks, "Whisky", D2)
    assert [r["code"] for r in shop.query_discounted_items().collect()] == ["A"]
    assert {r["import_date"] for r in shop.stocks_and_median_values().collect()} == {"2024-03-01", "2024-03-02"}
    assert shop.stocks_and_median_values_by_code(["A"]).count() == 2
    assert shop.stocks_and_median_values_by_code([]).isEmpty()
    sold = [("2024-03-02", "A", 2.0, 2)]
    columns = ["import_date", "code", "units_sold", "price_changes_count"]
    assert [tuple(r) for r in shop.previous_day_units_sold(str(tmp_path)).select(*columns).collect()] == sold
    assert (tmp_path / "sales_2024-03-02.csv").is_dir()
    assert shop.units_sold_all_time().count() == 1
    assert shop.price_search().count() == shop.today().count() == 2
    assert StockReports(stocks, "Whisky").query_discounted_items().isEmpty()
