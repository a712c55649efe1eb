"""Hot keys, copies, large groups, and the plans behind them."""

import random
import statistics
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from shelftrail.operators import history, medians, movement, quality, ranking, spread_join, views
from shelftrail.plans import reports
from workload.fixtures import AS_OF, event_products, event_stocks, product_pages
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_a_join(spark, how):
    rng = random.Random(5)
    rows = spark.createDataFrame(
        [(None if rng.random() < 0.02 else min(int(rng.paretovariate(0.5)), 9), rng.randrange(4), i % 7) for i in range(500)],
        "k int, d int, v int",
    )
    other = spark.createDataFrame([(k, d, k * 10 + d) for k in range(1, 8) for d in range(3) if (k + d) % 4], "k int, d int, w int")
    for keys, right in ((["k", "d"], other), (["k"], other.where("d = 0").drop("d"))):
        hot = spread_join.hot_keys(rows, "k", share=20)
        assert hot.count() > 1
        got = spread_join.spread_join(rows, right, keys, how, hot)
        expected = rows.join(right, keys, how).select(*got.columns)
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_hot_rows_are_spread(spark):
    """A code with a third of the rows does not reach the join in one partition."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), "id")).alias("code"), "id"
    )
    lookup = rows.select("code").distinct().withColumn("n", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        joined = spread_join.spread_join(rows, lookup, ["code"])
        sizes = joined.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("code") == "hot").alias("n"))
        assert joined.count() == 30_000
        assert max(r["n"] for r in sizes.collect()) < 2_500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_hot_keys_follow_the_volume(spark):
    """With an even share as the bar, fewer keys than partitions are hot; a bar in rows has no such cap."""
    rows = spark.range(6000).select(F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id") % 1500).alias("k"))
    assert [tuple(r) for r in spread_join.hot_keys(rows, "k").collect()] == [(-1, 2)]
    many = spark.range(12_000).select((F.col("id") % 1200).alias("k"))
    hot = spread_join.hot_keys(many, "k", share=4)
    assert hot.count() == 1200 and {r["__splits"] for r in hot.collect()} == {3}
    joined = spread_join.spread_join(many, many.distinct().withColumn("n", F.lit(1)), ["k"], "left", hot)
    assert joined.where("n = 1").count() == 12_000


def test_a_key_gets_as_many_salts_as_it_needs(spark):
    rows = spark.range(200_000).select(F.lit("hot").alias("k"), "id")
    hot = spread_join.hot_keys(rows, "k", share=400)
    assert hot.first()["__splits"] == 500
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        joined = spread_join.spread_join(rows, spark.createDataFrame([("hot", 1)], "k string, n int"), ["k"], "inner", hot)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 200_000
        assert len(sizes) > 450 and max(r["count"] for r in sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repeat_rows(spark):
    counts = [1, 2, 4095, 4096, 4097, 10_000]
    df = spark.createDataFrame([(n, n) for n in counts], "n int, copies bigint")
    assert dict(spread_join.repeat_rows(df).groupBy("n").count().collect()) == {n: n for n in counts}


def test_copies_round_trip(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, None), (None, None)], "x string, y int")
    compact = spread_join.with_copies(df)
    assert compact.count() == 3
    assert Counter(map(tuple, spread_join.repeat_rows(compact).collect())) == Counter(map(tuple, df.collect()))


def test_only_copies_of_hot_keys_are_merged(spark):
    rows = spark.createDataFrame([("a", 1)] * 5 + [("b", 1)] * 2 + [(None, 1)] * 4, "k string, v int")
    merged = spread_join.merge_hot_copies(rows, "k", spread_join.hot_keys(rows, "k", share=2))
    assert Counter(map(tuple, merged.collect())) == Counter({("a", 1, 5): 1, ("b", 1, 1): 2, (None, 1, 4): 1})


def test_median_of_values_close_together(spark):
    """100,000 distinct prices within one pound: few of them reach the ordering."""
    rows = spark.range(100_001).select(F.lit(1).alias("g"), (1000 + F.pmod(F.col("id") * 7919, F.lit(100_001)) / 100_001).alias("v"))
    got = medians.exact_median(rows, ["g"], "v", large_groups=True)
    assert got.first()["median"] == 1000 + 50_000 / 100_001


@pytest.mark.parametrize("large_groups", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_exact_median(spark, monkeypatch, seed, large_groups):
    monkeypatch.setattr(spread_join, "SHARE", 200)
    rng = random.Random(seed)
    rows = []
    for _ in range(3000):
        group = None if rng.random() < 0.05 else min(int(rng.paretovariate(0.6)), 12)
        value = rng.choice([None, -3.5, 0.0, 12.5, 12.5, rng.gauss(0, 1000), rng.lognormvariate(3, 2)])
        rows.append((group, value, rng.randrange(5)))
    rows += [(99, None, 1), (99, None, 2), (98, 7.25, 1)]
    df = spark.createDataFrame(rows, "g int, v double, a int")
    got = medians.exact_median(df, ["g"], "v", {"total": F.col("a")}, large_groups).collect()
    for r in got:
        members = [x for x in rows if x[0] == r["g"]]
        known = sorted(v for _, v, _ in members if v is not None)
        middle = None
        if known:
            middle = known[(len(known) - 1) // 2] * 0.5 + known[len(known) // 2] * 0.5
            assert middle == pytest.approx(statistics.median(known))
        assert r["median"] == middle
        assert r["highest"] == (known[-1] if known else None)
        assert (r["row_count"], r["total"]) == (len(members), sum(a for *_, a in members))
    assert len(got) == len({r[0] for r in rows})


def test_medians_and_history_are_dealt_out_by_volume(spark, monkeypatch):
    """More rows make more tasks, not larger ones, whatever number of partitions the session has."""
    i = F.col("id")
    products = spark.range(6000).select(
        F.when(i % 17 > 0, F.concat(F.lit("c"), (i % 60).cast("string"))).alias("code"),
        F.date_add(F.lit("2024-01-01"), (i % 23).cast("int")).alias("import_date"),
        F.when(i % 13 > 0, (i * 7919 % 101).cast("double")).alias("price_gbp"),
        (i % 5).cast("string").alias("availability"),
        F.lit("t").alias("title"), F.lit("u").alias("url"),
    )
    reports_ = {
        "medians": lambda: history.daily_prices(products),
        "changes": lambda: history.price_changes(products),
        "changes_approx": lambda: history.price_changes(products, "approx"),
        "series": lambda: reports.code_series(products),
        "series_state": lambda: reports.code_series(None, state=reports.code_series(products).select(
            "code", "import_date", F.col("median_price").alias("median"), "total_availability")),
        "discounts": lambda: reports.discounted_items(products, date(2024, 1, 5)),
    }
    usual = {name: report().collect() for name, report in reports_.items()}
    monkeypatch.setattr(spread_join, "TASK_ROWS", 100)
    for name, report in reports_.items():
        got = report()
        if name.startswith("series"):
            assert got.collect() == usual[name]
        assert Counter(got.collect()) == Counter(usual[name])
    assert history.daily_prices(products).rdd.getNumPartitions() >= 60
    assert history.price_changes(products).rdd.getNumPartitions() == 60
    assert reports.code_series(products).rdd.getNumPartitions() == 60
    hot, rows = spread_join.counted_keys(products, "code")
    assert rows == 6000 and [r["code"] for r in hot.collect()] == [None]
    assert spread_join.counted_keys(products.limit(0), "code")[1] == 0


def test_one_code_with_a_third_of_all_rows(spark):
    """Reports on skewed input agree with plain Spark SQL over the same rows."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        code = "HOT" if i % 3 == 0 else f"C{rng.randrange(400)}"
        day = AS_OF - timedelta(days=rng.randrange(4))
        rows.append((code, day, rng.randrange(100, 4000) / 100, str(rng.randrange(4)), f"t{rng.randrange(3)}", "u"))
    df = spark.createDataFrame(rows, "code string, import_date date, price_gbp double, availability string, title string, url string")
    df.createOrReplaceTempView("skewed")
    expected = spark.sql("""
        SELECT t.d AS import_date, y.code, y.title, y.url, y.price_gbp,
               coalesce(double(c.availability), 0) AS availability,
               double(y.availability) - coalesce(double(c.availability), 0) AS units_sold
        FROM skewed y JOIN (SELECT DISTINCT import_date AS d FROM skewed) t ON y.import_date = date_sub(t.d, 1)
        LEFT JOIN skewed c ON c.code = y.code AND c.import_date = t.d
        WHERE double(y.availability) - coalesce(double(c.availability), 0) > 0""")
    got = movement.units_sold_all(df, as_rows=True).drop("price_changes_count")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    merged = movement.units_sold_all(df)
    assert merged.agg(F.sum("copies")).first()[0] == expected.count()
    offers = reports.discounted_items(df, AS_OF)
    assert offers.count() == spark.sql(f"""
        SELECT * FROM skewed s JOIN (SELECT code, max(price_gbp) m FROM skewed GROUP BY code) x USING (code)
        WHERE import_date = DATE '{AS_OF}' AND m > price_gbp""").count()


def test_reports_stay_on_the_jvm_and_without_cross_joins(spark):
    w = event_products(spark, SF)
    for report in (
        history.price_changes(w), movement.units_sold_all(w), movement.units_sold_by_date(w, AS_OF),
        reports.discounted_items(w, AS_OF), reports.daily_stock_summary(w), reports.code_series(w),
        reports.title_features(w), ranking.new_lows(w, AS_OF),
        quality.repaired_day(event_stocks(spark, SF), AS_OF), quality.same_title_different_code(w),
    ):
        plan = plan_of(report)
        assert "Python" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lowest_prices_are_cut_before_the_shuffle(spark):
    plan = plan_of(ranking.price_ranks(event_products(spark, SF)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_code_filter_reaches_the_first_stage(spark, tmp_path):
    event_stocks(spark, SF).write.parquet(str(tmp_path / "stocks"))
    stocks = spark.read.parquet(str(tmp_path / "stocks"))
    plan = plan_of(reports.code_series(views.product_view(stocks, "purchase"), ["SKU00001"]))
    assert "EqualTo(code,SKU00001)" in plan and "EqualTo(type,purchase)" in plan
    schema = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "title" not in schema and "url" not in schema


def test_a_day_reads_its_own_folder(spark, tmp_path):
    from shelftrail.sinks.writers import write_stocks
    from shelftrail.sources.tables import read_stocks

    write_stocks(event_stocks(spark, SF), str(tmp_path / "lake"), even_files=True)
    products = views.product_view(read_stocks(spark, str(tmp_path / "lake")), "purchase")
    for frame in (views.today_view(products, AS_OF), views.on_day(products, AS_OF, days_before=1)):
        filters = plan_of(frame).split("PartitionFilters: [")[1].split("]")[0]
        assert "import_date" in filters and "= 2024-01-" in filters


def test_pages_are_never_shuffled(spark):
    from shelftrail.plans.metadata import page_metadata

    plan = plan_of(page_metadata(product_pages(spark, SF)))
    assert "Exchange" not in plan


def test_queries_are_lazy_about_rows(spark):
    """A registered query hands back a DataFrame with unique column names."""
    for key in ("discounted_items", "line_price_changes"):
        df = QUERIES[key](spark, SF)
        assert len(set(df.columns)) == len(df.columns)
