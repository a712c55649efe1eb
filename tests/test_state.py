"""The state of past days: equal to a full rebuild, at the cost of the days replaced."""

import random
from collections import Counter
from datetime import date, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from shelftrail.operators import history, ranking, state
from shelftrail.operators.views import product_view
from shelftrail.plans import daily, reports
from shelftrail.sinks.writers import write_stocks
from shelftrail.sources.tables import read_stocks

DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(6)]


def random_stocks(stocks_of, seed, days=DAYS):
    rng, rows = random.Random(seed), []
    for day in days:
        for _ in range(60):
            rows.append(dict(
                code=rng.choice([None, "A", "B", "C", "D", "E"]), import_date=day, type=rng.choice(["Gin", "Rum"]), title="t", url="u",
                price_gbp=rng.choice([None, *[float(p) for p in range(40, 60)]]), availability=str(rng.randrange(4)),
            ))
        rows.append(dict(code="F", import_date=day, type="Rum", title="f", url="u", price_gbp=float(100 - day.day), availability="1"))
    return stocks_of(*rows)


def same(a, b):
    return Counter(map(repr, a.select(*b.columns).collect())) == Counter(map(repr, b.collect()))


def test_updates_equal_a_rebuild(spark, stocks_of, tmp_path):
    """Days arrive in runs, one of them again with other rows, one emptied."""
    path, old, new = str(tmp_path / "state"), random_stocks(stocks_of, 1), random_stocks(stocks_of, 2)
    old, new = product_view(old, "Rum"), product_view(new, "Rum")
    state.update_state(old, path, DAYS[:3])
    state.update_state(old, path, DAYS[2:5])
    state.update_state(new, path, [DAYS[1], DAYS[5]])
    state.update_state(new.where("false"), path, [DAYS[0]])
    state.update_state(new, path, [DAYS[1]])
    now = old.where(F.col("import_date").isin([DAYS[2], DAYS[3], DAYS[4]])).unionByName(new.where(F.col("import_date").isin([DAYS[1], DAYS[5]])))
    kept = state.read_state(spark, path)
    assert same(state.history_from_state(kept), history.code_history(now))
    assert same(state.history_from_state(kept, DAYS[3]), history.code_history(now, until=DAYS[3]))
    assert same(reports.code_series(None, state=kept), reports.code_series(now))
    for day in DAYS:
        assert same(state.new_lows_from_state(kept, now, day), ranking.new_lows(now, day))
    assert state.new_lows_from_state(kept, now, DAYS[5]).where("code = 'F'").count() == 1


def test_an_update_reads_and_writes_its_days_only(spark, stocks_of, tmp_path):
    table, path = str(tmp_path / "stocks"), tmp_path / "state"
    write_stocks(random_stocks(stocks_of, 3), table)
    products = product_view(read_stocks(spark, table), "Rum")
    state.update_state(products, str(path), DAYS)
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    state.update_state(products, str(path), [DAYS[4]])
    after = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    assert {f.parent.name for f in set(before.items()) ^ set(after.items()) for f in [f[0]]} == {f"import_date={DAYS[4]}"}
    plan = state.day_state(products.where(F.col("import_date").isin([DAYS[4]])))._jdf.queryExecution().executedPlan().toString()
    scans = plan.split("PartitionFilters: [")[1:]
    assert scans and all("import_date" in s.split("]")[0] and str(DAYS[4]) in s.split("]")[0] for s in scans)


def test_reports_on_a_state_read_one_day_of_products(spark, stocks_of, tmp_path):
    table, path = str(tmp_path / "stocks"), str(tmp_path / "state")
    write_stocks(random_stocks(stocks_of, 4), table)
    products = product_view(read_stocks(spark, table), "Rum")
    state.update_state(products, path, DAYS)
    plan = state.new_lows_from_state(state.read_state(spark, path), products, DAYS[5])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line and "title" in line]
    assert scans and all(f"= {DAYS[5]}" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


OLD = "Code,Title,Size,Style,Country,Group,Available,Price (GBP)\n"


def test_daily_runs_keep_the_states_of_all_types(spark, tmp_path):
    """A run for one type takes the new day into the states of the others as well."""
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")

    def land(day, price):
        landing.mkdir(exist_ok=True)
        rows = "".join(f"{c},{c},70cl,Dry,FR,{t},3,{price}\n" for c, t in (("A", "Gin"), ("B", "Rum 2/3")))
        (landing / f"full-stock-list_{day:%Y_%m_%d}.csv").write_text(OLD + rows)

    land(DAYS[0], 900)
    daily.run_day(spark, str(landing), lake, "Gin", DAYS[0])
    daily.run_day(spark, str(landing), lake, "Rum 2/3", DAYS[0])
    land(DAYS[1], 500)
    assert [r["code"] for r in daily.run_day(spark, str(landing), lake, "Gin", DAYS[1]).collect()] == ["A"]
    land(DAYS[2], 400)
    alerts = daily.run_day(spark, str(landing), lake, "Rum 2/3", DAYS[2]).collect()
    assert [(r["code"], r["old_price"], r["price_changes_count"]) for r in alerts] == [("B", 900.0, 3)]
    # The day's states were added to, not built again.
    sign = Path(lake) / "state" / "Gin+exact" / "_SUCCESS"
    built = sign.stat().st_mtime_ns
    assert [r["price_changes_count"] for r in daily.run_day(spark, str(landing), lake, "Gin", DAYS[2]).collect()] == [3]
    assert sign.stat().st_mtime_ns == built
    sign.unlink()
    assert [r["price_changes_count"] for r in daily.run_day(spark, str(landing), lake, "Gin", DAYS[2]).collect()] == [3]
