"""How tables lie in files, and what readers get out of it."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelftrail.operators import movement
from shelftrail.operators.views import product_view
from shelftrail.sinks import writers
from shelftrail.sources import tables
from workload.fixtures import event_products, event_stocks

SF = "/root/testdata/sf0.001"


@pytest.fixture
def many(stocks_of):
    """50,000 rows of one day in ten types, none next to another of its type."""
    one = stocks_of(dict(import_date=__import__("datetime").date(2024, 1, 1), title="t"))
    return one.drop("code", "type", "url").crossJoin(one.sparkSession.range(50_000)).select(
        "*", F.concat(F.lit("T"), F.col("id") % 10).alias("type"), F.concat(F.lit("C"), F.xxhash64("id")).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("url")
    ).drop("id")


def rows_scanned(df):
    """Rows that the scan hands on, as Spark's own plan metrics have it."""
    df.write.format("noop").mode("overwrite").save()
    frame = df._jdf.queryExecution()
    frame.toRdd().count()
    return frame.executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_a_type_is_read_from_a_few_row_groups(spark, many, tmp_path):
    path = str(tmp_path / "t")
    writers.write_stocks(many.coalesce(1), path, row_group_bytes=1 << 16)
    groups = [g for f in glob.glob(f"{path}/*/*.parquet") for m in [pq.ParquetFile(f).metadata] for g in map(m.row_group, range(m.num_row_groups))]
    ranges = [(c.statistics.min, c.statistics.max) for g in groups for c in map(g.column, range(g.num_columns)) if c.path_in_schema == "type"]
    assert len(groups) >= 20 and sum(a <= "T3" <= b for a, b in ranges) <= len(groups) / 5
    stocks = tables.read_stocks(spark, path)
    assert stocks.where("type = 'T3'").count() == 5000
    assert rows_scanned(stocks.where("type = 'T3'").select("url")) < 0.3 * 50_000
    assert rows_scanned(stocks.where("code = 'none' AND type = 'T3'").select("url")) < 0.1 * 50_000


def test_reloaded_days_are_clustered_too(spark, many, tmp_path):
    path = str(tmp_path / "t")
    writers.reload_days(many.coalesce(1), path, ["2024-01-01"])
    found = [r["type"] for f in glob.glob(f"{path}/*/*.parquet") for r in pq.read_table(f, columns=["type"]).to_pylist()]
    assert found == sorted(found) and len(found) == 50_000


def test_bucketed_joins_need_no_shuffle(spark, tmp_path):
    """Neither the days' join nor the history behind the price changes; only the final order does."""
    products = event_products(spark, SF)
    writers.save_bucketed(products, "bucketed_products", 4, str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = tables.read_bucketed(spark, "bucketed_products")
        sold = movement.units_sold_all(read)
        plan = sold._jdf.queryExecution().executedPlan().toString()
        shuffled = [line for line in plan.split("\n") if "Exchange " in line and "Broadcast" not in line]
        assert plan.count("SortMergeJoin") >= 2 and "Bucketed: true" in plan
        assert all("rangepartitioning" in line or "(target_date" in line for line in shuffled), shuffled
        expected = movement.units_sold_all(products)
        assert sorted(map(repr, sold.collect())) == sorted(map(repr, expected.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_products")


def test_bucketed_table_with_a_hot_code(spark, tmp_path):
    products = event_products(spark, SF).withColumn("code", F.when(F.rand(1) < 0.5, "HOT").otherwise(F.col("code")))
    products = spark.createDataFrame(products.toArrow())
    writers.save_bucketed(products, "bucketed_hot", 4, str(tmp_path / "b"))
    sold = movement.units_sold_all(tables.read_bucketed(spark, "bucketed_hot"))
    expected = movement.units_sold_all(products)
    assert sorted(map(repr, sold.collect())) == sorted(map(repr, expected.collect()))
    spark.sql("DROP TABLE bucketed_hot")


def test_buckets_replace_older_ones(spark, tmp_path):
    for last in (50, 10):
        writers.save_bucketed(event_stocks(spark, SF).limit(last), "bucketed_twice", 2, str(tmp_path / "b"))
        assert tables.read_bucketed(spark, "bucketed_twice").count() == last
    spark.sql("DROP TABLE bucketed_twice")
