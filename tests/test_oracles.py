"""Every registered query against its DuckDB counterpart, and on random tables."""

import random
from datetime import date, timedelta

import pyarrow as pa
import pytest

import check_oracles
from shelftrail.operators import history, movement, quality, ranking, spread_join, views
from shelftrail.plans import reports
from shelftrail.schema import CANONICAL, CANONICAL_COLUMNS
from workload import oracles
from workload.fixtures import AS_OF, NO_SNAPSHOT
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check_oracles.connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracles.ORACLES)


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, duck, key):
    assert check_oracles.compare(spark, duck, SF, key) == ""


def random_rows(seed):
    """Few codes and prices, so ties, copies, gaps of days and NULLs all occur."""
    rng = random.Random(seed)
    rows = []
    for _ in range(600):
        code = None if rng.random() < 0.03 else f"SKU{int(rng.paretovariate(0.7)) % 12:05d}"
        day = AS_OF - timedelta(days=rng.choice([0, 0, 1, 1, 2, 4, 5, 6, 9]))
        price = rng.choice([None, 0.0, 10.0, 12.5, 12.5, 99.99, rng.randrange(1, 9999) / 100])
        older = rng.random() < 0.5
        rows.append((
            None, None if rng.random() < 0.05 else str(rng.randrange(0, 6)), code, "FR",
            rng.choice(["purchase", "purchase", "view"]), f"u{rng.randrange(3)}",
            price if older else None, None, None if older else price, "70cl", "dry",
            rng.choice([None, "Small cask 12", "Hot ring 7", "Old 1984"]), None, day,
        ))
    return rows


KEYS = {
    "price_changes": history.price_changes,
    "units_sold_all": lambda w: movement.units_sold_all(w, as_rows=True),
    "units_sold_all_present": lambda w: movement.units_sold_all(w, count_vanished=False, as_rows=True),
    "units_sold_by_date": lambda w: movement.units_sold_by_date(w, AS_OF),
    "units_sold_missing_day": lambda w: movement.units_sold_by_date(w, NO_SNAPSHOT),
    "units_moved": lambda w: movement.units_moved(w, AS_OF),
    "units_sold_no_vanished": lambda w: movement.units_moved(w, AS_OF, only_sales=True),
    "discounted_items": lambda w: reports.discounted_items(w, AS_OF),
    "discount_screen": lambda w: reports.discount_screen(
        reports.discounted_items(w, AS_OF), 10, 500, 10.0, "small|hot"
    ),
    "daily_stock_summary": reports.daily_stock_summary,
    "code_series_all": reports.code_series,
    "price_search": lambda w: reports.price_search(w, AS_OF),
    "max_price_by_title": reports.max_price_by_title,
    "price_ranks": ranking.price_ranks,
    "new_low_today": lambda w: ranking.new_lows(w, AS_OF),
    "duplicate_titles": quality.same_title_different_code,
}


@pytest.mark.parametrize("seed, share", [(1, 100_000), (2, None), (3, 3)])
def test_random_tables(spark, duck, monkeypatch, seed, share):
    """With a low bar for hot keys the salted joins carry almost every row."""
    monkeypatch.setattr(spread_join, "SHARE", share)
    rows = random_rows(seed)
    table = pa.Table.from_arrays([pa.array(c) for c in zip(*rows)], names=CANONICAL_COLUMNS)
    duck.register("given", table)
    # NULL-only columns arrive untyped; give every column its canonical type.
    types = {"string": "VARCHAR", "double": "DOUBLE", "date": "DATE"}
    casts = ", ".join(f"CAST({f.name} AS {types[f.dataType.typeName()]}) AS {f.name}" for f in CANONICAL)
    products = views.product_view(spark.createDataFrame(rows, CANONICAL), "purchase").cache()
    for key, fn in KEYS.items():
        df = fn(products)
        got = check_oracles._normal([tuple(r) for r in df.collect()], df.columns)
        answer = duck.execute(oracles.ORACLES[key].replace(oracles._STOCKS, f"SELECT {casts} FROM given"))
        expected = check_oracles._normal(answer.fetchall(), [c[0] for c in answer.description])
        assert got == expected, key
