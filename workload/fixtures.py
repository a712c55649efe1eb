"""Stock tables and pages derived from the driver's tables (FIXTURES.md)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelftrail.operators.reshape import source_layout
from shelftrail.operators.views import product_view
from shelftrail.schema import CURRENT_HEADERS, LEGACY_HEADERS
from shelftrail.session import scratch_path

PRODUCT_TYPE = "purchase"
AS_OF = date(2024, 1, 30)
NO_SNAPSHOT = date(2024, 1, 31)
NEW_LAYOUT_FROM = date(2024, 1, 16)
RELANDED = date(2024, 1, 20)
LINE_TYPE = "line"
LINE_DAY = date(1999, 4, 7)

# Runs unchanged in Spark and DuckDB.
EVENT_STOCKS_SQL = """
SELECT CASE WHEN CAST(e.ts AS DATE) >= DATE '2024-01-16' THEN CAST(40 + e.user_id % 20 AS DOUBLE) END AS abv,
       regexp_extract(e.props, '([0-9]+)', 1) AS availability,
       concat('SKU', lpad(CAST(e.user_id AS STRING), 5, '0')) AS code,
       n.n_name AS country,
       e.event_type AS type,
       CASE WHEN CAST(e.ts AS DATE) >= DATE '2024-01-16' THEN concat('https://shop.example.org/product/', CAST(e.user_id AS STRING)) END AS url,
       CASE WHEN CAST(e.ts AS DATE) <  DATE '2024-01-16' THEN e.value END AS price_gbp,
       CASE WHEN CAST(e.ts AS DATE) >= DATE '2024-01-16' THEN round(e.value * 0.8, 2) END AS price_ex_vat,
       CASE WHEN CAST(e.ts AS DATE) >= DATE '2024-01-16' THEN e.value END AS price_incl_vat,
       '70cl' AS size,
       p.p_brand AS style,
       concat(p.p_name, ' ', CAST(p.p_size AS STRING), ' Year Old') AS title,
       CASE WHEN CAST(e.ts AS DATE) >= DATE '2024-01-16' THEN CAST(1960 + e.user_id % 50 AS STRING) END AS vintage,
       CAST(e.ts AS DATE) AS import_date
FROM {events} e
LEFT JOIN {part} p ON p.p_partkey = e.user_id
LEFT JOIN {nation} n ON n.n_nationkey = e.user_id % 25
"""

LINE_STOCKS_SQL = """
SELECT CAST(NULL AS DOUBLE) AS abv,
       CAST(CAST(l.l_quantity AS BIGINT) AS STRING) AS availability,
       concat('SUP', CAST(l.l_suppkey AS STRING)) AS code,
       l.l_linestatus AS country,
       'line' AS type,
       concat('https://shop.example.org/line/', CAST(l.l_partkey AS STRING)) AS url,
       l.l_extendedprice AS price_gbp,
       CAST(NULL AS DOUBLE) AS price_ex_vat,
       CAST(NULL AS DOUBLE) AS price_incl_vat,
       '70cl' AS size,
       l.l_returnflag AS style,
       concat('Part ', CAST(l.l_partkey AS STRING)) AS title,
       CAST(NULL AS STRING) AS vintage,
       CAST(l.l_shipdate AS DATE) AS import_date
FROM {lineitem} l
"""

# The stock table with its days moved, so that the last one is the current date.
MOVED_UP_SQL = """
SELECT abv, availability, code, country, type, url, price_gbp, price_ex_vat, price_incl_vat, size, style, title, vintage,
       CAST(import_date + {days} AS DATE) AS import_date
FROM {stocks}
"""

# The stock table with unreadable and missing availabilities and missing prices.
DIRTY_SQL = """
SELECT abv, CASE WHEN CAST(availability AS INT) % 7 = 0 THEN 'sold out' WHEN CAST(availability AS INT) % 11 = 0 THEN NULL
                 WHEN CAST(availability AS INT) % 13 = 0 THEN concat(availability, 'd') ELSE availability END AS availability,
       code, country, type, url,
       CASE WHEN CAST(availability AS INT) % 5 = 0 THEN NULL ELSE price_gbp END AS price_gbp, price_ex_vat,
       CASE WHEN CAST(availability AS INT) % 5 = 0 THEN NULL ELSE price_incl_vat END AS price_incl_vat,
       size, style, title, vintage, import_date
FROM {stocks}
"""

_SCRIPT = '<script type="application/ld+json">'
# By page_id % 8: one product; a graph; nothing; a list of products; a malformed block and
# one with entities; a repeated key and NaN; crumbs ending in the name; a nested repeated key.
PAGES_SQL = f"""
SELECT page_id, url, concat(html,
  CASE page_id % 8
    WHEN 0 THEN concat('{_SCRIPT}{{{{"@type":"Product","name":"Item ', CAST(page_id AS STRING),
                       '","sku":"hed', lpad(CAST(page_id AS STRING), 5, '0'), '"}}}}</script>')
    WHEN 1 THEN concat('<SCRIPT id="ld" type="application/ld+json">{{{{"@graph":[{{{{"@type":["BreadcrumbList"],"itemListElement":',
                       '[{{{{"name":"Home"}}}},{{{{"item":{{{{"name":" Spirits "}}}}}}}},{{{{"name":"Cat ', CAST(page_id % 5 AS STRING), '"}}}}]}}}},',
                       '{{{{"@type":"Product","name":"Item ', CAST(page_id AS STRING),
                       '","offers":{{{{"sku":["HED', lpad(CAST(page_id AS STRING), 5, '0'), '"]}}}}}}}}]}}}}</SCRIPT>')
    WHEN 3 THEN concat('{_SCRIPT}[{{{{"@type":"Product","name":"First ', CAST(page_id AS STRING),
                       '"}}}},{{{{"@type":"Product","name":"Second","id":"HED', lpad(CAST(page_id AS STRING), 5, '0'), '"}}}}]</script>')
    WHEN 4 THEN concat('{_SCRIPT}{{{{"@type":"Product",}}}}</script>',
                       '{_SCRIPT}{{{{"@type":"Product","name":"Salt &amp; Sons ', CAST(page_id AS STRING),
                       '","mpn":"HED', lpad(CAST(page_id AS STRING), 5, '0'), '"}}}}</script>')
    WHEN 5 THEN concat('{_SCRIPT}{{{{"@type":"Product","name":"Item ', CAST(page_id AS STRING),
                       '","price":NaN,"sku":"HED1', lpad(CAST(page_id AS STRING), 5, '0'),
                       '","sku":"HED8', lpad(CAST(page_id AS STRING), 5, '0'), '"}}}}</script>')
    WHEN 6 THEN concat('{_SCRIPT}[{{{{"@type":"BreadcrumbList","itemListElement":[{{{{"name":"Shop"}}}},{{{{"name":"ITEM ', CAST(page_id AS STRING),
                       '"}}}}]}}}},{{{{"@type":"Product","name":"Item ', CAST(page_id AS STRING),
                       '","sku":"HED', lpad(CAST(page_id AS STRING), 5, '0'), '"}}}}]</script>')
    WHEN 7 THEN concat('{_SCRIPT}{{{{"@type":"Product","name":"Item ', CAST(page_id AS STRING),
                       '","offers":{{{{"sku":"HED1', lpad(CAST(page_id AS STRING), 5, '0'),
                       '","sku":"HED9', lpad(CAST(page_id AS STRING), 5, '0'), '"}}}}}}}}</script>')
    ELSE '' END) AS html
FROM {{pages}}
"""


_schemas: dict[str, StructType] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is read from the file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _sql(spark: SparkSession, sf_dir: str, text: str, *names: str) -> DataFrame:
    return spark.sql(text, **{n: _table(spark, sf_dir, n) for n in names})


def event_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, EVENT_STOCKS_SQL, "events", "part", "nation")


def line_stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, LINE_STOCKS_SQL, "lineitem")


# Days from the last one of the fixture to the current date.
SPARK_DAYS = "datediff(current_date(), DATE '2024-01-30')"
DUCK_DAYS = "CAST(current_date - DATE '2024-01-30' AS INTEGER)"


def _derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return product_view(spark.sql(text, stocks=event_stocks(spark, sf_dir)), PRODUCT_TYPE)


def current_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, MOVED_UP_SQL.replace("{days}", SPARK_DAYS))


def dirty_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, DIRTY_SQL)


def event_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_view(event_stocks(spark, sf_dir), PRODUCT_TYPE)


def line_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_view(line_stocks(spark, sf_dir), LINE_TYPE)


def product_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, PAGES_SQL, "pages")


def land_csv(stocks: DataFrame, folder: str, headers: dict[str, str], name: str = "full-stock-list") -> None:
    """Snapshots of all days in one write, each below a folder named like its file."""
    snapshot = F.concat(F.lit(f"{name}_"), F.date_format("import_date", "yyyy_MM_dd"), F.lit(".csv"))
    rows = source_layout(stocks.withColumn("snapshot", snapshot), {**headers, "snapshot": "snapshot"})
    rows.hint("rebalance", F.col("snapshot")).write.option("header", True).option("escape", '"').partitionBy(
        "snapshot"
    ).csv(folder)


def land_both_layouts(spark: SparkSession, sf_dir: str) -> str:
    """The whole event stock table as CSV, older days in the older layout."""
    stocks = event_stocks(spark, sf_dir)
    folder = scratch_path(spark, "landing")
    is_new = F.col("import_date") >= F.lit(NEW_LAYOUT_FROM)
    land_csv(stocks.where(~is_new), f"{folder}/older", LEGACY_HEADERS)
    land_csv(stocks.where(is_new), f"{folder}/newer", CURRENT_HEADERS)
    return folder
