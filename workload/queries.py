"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelftrail.functions import jsonld
from shelftrail.functions.casts import to_number
from shelftrail.functions.dates import day_text, file_date
from shelftrail.functions.text import drop_literal, drop_punctuation, slug_url, strip, unescape_all
from shelftrail.operators import filters, history, movement, quality, ranking, reshape, state, views
from shelftrail.plans import metadata, reports
from shelftrail.schema import CURRENT_HEADERS, LEGACY_HEADERS
from shelftrail.session import scratch_path
from shelftrail.sinks import versions, writers
from shelftrail.sources import snapshots, tables
from shelftrail.streaming import incremental
from workload.fixtures import (
    AS_OF, LINE_DAY, NO_SNAPSHOT, PRODUCT_TYPE, RELANDED, current_products, dirty_products, event_products, event_stocks,
    land_both_layouts, land_csv, line_products, product_pages,
)

CODES = ["SKU00001", " SKU00002 ", "SKU00003", "SKU00001", ""]


def _on_products(fn):
    return lambda spark, sf_dir: fn(event_products(spark, sf_dir))


def _on_stocks(fn):
    return lambda spark, sf_dir: fn(event_stocks(spark, sf_dir))


def _on_dirty(fn):
    return lambda spark, sf_dir: fn(dirty_products(spark, sf_dir))


def _on_current(fn):
    return lambda spark, sf_dir: fn(current_products(spark, sf_dir))


def _on_lines(fn):
    return lambda spark, sf_dir: fn(line_products(spark, sf_dir))


# --- ingest ---------------------------------------------------------------------


def ingest_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.build_stocks(spark, land_both_layouts(spark, sf_dir), "by_name")


def ingest_positional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.build_stocks(spark, land_both_layouts(spark, sf_dir), "positional")


def raw_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day and how many have the columns only one layout has."""
    raw = snapshots.read_by_name(spark, land_both_layouts(spark, sf_dir))
    day = file_date(F.col(snapshots.SOURCE_PATH)).alias("import_date")
    return raw.groupBy(day).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("Price (GBP)").alias("old_prices"),
        F.count("Price (inc VAT)").alias("new_prices"),
        F.count("Link").alias("links"),
    )


def legacy_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = snapshots.read_positional(spark, land_both_layouts(spark, sf_dir))
    day = file_date(F.col(snapshots.SOURCE_PATH)).alias("import_date")
    return raw.groupBy(day, snapshots.is_legacy().alias("is_legacy_schema")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def typed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "typed")
    writers.write_csv(
        event_stocks(spark, sf_dir).select("code", "availability", "import_date"), path
    )
    return snapshots.read_typed_csv(spark, path)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First days 1 to 20, then the rest and day 20 once more with nothing in stock."""
    stocks = event_stocks(spark, sf_dir)
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "stocks", "ingest"))
    until = F.col("import_date") <= F.lit(RELANDED)
    land_csv(stocks.where(until), f"{landing}/first", CURRENT_HEADERS)
    incremental.ingest_new_snapshots(spark, landing, table, checkpoint)
    again = reshape.set_cell(
        stocks.where(F.col("import_date") >= F.lit(RELANDED)),
        F.col("import_date") == F.lit(RELANDED), "availability", F.lit("0"),
    )
    land_csv(again, f"{landing}/second", CURRENT_HEADERS, name="full-stock-list-second")
    incremental.ingest_new_snapshots(spark, landing, table, checkpoint)
    incremental.ingest_new_snapshots(spark, landing, table, checkpoint)
    return tables.read_stocks(spark, table)


def _maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after two runs: the first with wrong prices on its last day, the second with all days from there."""
    products, path = event_products(spark, sf_dir), scratch_path(spark, "state")
    days = sorted(r[0] for r in products.select("import_date").distinct().collect())
    wrong = reshape.set_cell(products, F.col("import_date") == F.lit(RELANDED), "price_gbp", F.col("price_gbp") / 7)
    state.update_state(wrong, path, [d for d in days if d <= RELANDED])
    state.update_state(products, path, [d for d in days if d >= RELANDED])
    return state.read_state(spark, path)


def maintained_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.history_from_state(_maintained(spark, sf_dir))


def maintained_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.code_series(None, state=_maintained(spark, sf_dir))


def maintained_new_lows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.new_lows_from_state(_maintained(spark, sf_dir), event_products(spark, sf_dir), AS_OF)


def maintained_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    history_ = state.history_from_state(_maintained(spark, sf_dir))
    return reports.discounted_items(event_products(spark, sf_dir), AS_OF, history=history_)


def versioned_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in versions: all days with wrong prices, then two replaced, one emptied, and a write that fails."""
    stocks, path = event_stocks(spark, sf_dir), scratch_path(spark, "versioned")
    versions.create(spark, path)
    wrong = stocks.withColumn("price_gbp", F.when(F.col("import_date") == F.lit(RELANDED), F.lit(0.5)).otherwise(F.col("price_gbp")))
    writers.reload_days(wrong, path)
    writers.reload_days(stocks.where(F.col("import_date") == F.lit(RELANDED)), path, [RELANDED, AS_OF])
    try:
        writers.reload_days(wrong, path, [RELANDED])
    except ValueError:
        pass
    return tables.read_stocks(spark, path)


def units_sold_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a table bucketed by code, without a shuffle for the joins."""
    path = scratch_path(spark, "bucketed")
    name = path.rpartition("/")[2].replace("-", "_")
    writers.save_bucketed(event_products(spark, sf_dir), name, 8, path)
    return movement.units_sold_all(tables.read_bucketed(spark, name), as_rows=True)


def clustered_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product view of a table written in order of type and code, in small row groups."""
    path = scratch_path(spark, "clustered")
    writers.write_stocks(event_stocks(spark, sf_dir), path, even_files=True, row_group_bytes=1 << 16)
    return views.product_view(tables.read_stocks(spark, path), PRODUCT_TYPE)


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the files that an earlier load of the older layout has not seen."""
    folder = land_both_layouts(spark, sf_dir)
    raw = snapshots.read_positional(spark, folder)
    loaded = snapshots.snapshot_files(spark, f"{folder}/older")
    fresh = snapshots.new_files(snapshots.snapshot_files(spark, folder), loaded)
    rows = raw.join(fresh.select(snapshots.SOURCE_PATH), snapshots.SOURCE_PATH, "left_semi")
    day = file_date(F.col(snapshots.SOURCE_PATH)).alias("import_date")
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))


def late_part_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's snapshot in two part files of one folder, the second landing a run later."""
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "stocks", "ingest"))
    stocks = event_stocks(spark, sf_dir)
    half = F.pmod(F.xxhash64("code"), F.lit(2))
    for part in (0, 1):
        rows = stocks.where(half == part)
        snapshot = F.concat(F.lit("full-stock-list_"), F.date_format("import_date", "yyyy_MM_dd"), F.lit(".csv"))
        out = reshape.source_layout(rows.withColumn("snapshot", snapshot), {**CURRENT_HEADERS, "snapshot": "snapshot"})
        out.hint("rebalance", F.col("snapshot")).write.mode("append").option("header", True).option("escape", '"').partitionBy(
            "snapshot"
        ).csv(landing)
        incremental.ingest_new_snapshots(spark, landing, table, checkpoint)
    return tables.read_stocks(spark, table)


def new_files_in_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the days after RELANDED, whose part files are told apart by their folder."""
    landing = scratch_path(spark, "landing")
    land_csv(event_stocks(spark, sf_dir), landing, CURRENT_HEADERS)
    listing = snapshots.snapshot_files(spark, landing)
    # Names as a single writer would give them in every folder.
    same = listing.withColumn(snapshots.SOURCE_PATH, F.regexp_replace(snapshots.SOURCE_PATH, "[^/]+$", "part-0.csv")).distinct()
    loaded = same.where(file_date(F.col(snapshots.SOURCE_PATH)) <= F.lit(RELANDED))
    fresh = snapshots.new_files(same, loaded).select(snapshots.snapshot_unit(F.col(snapshots.SOURCE_PATH)).alias("unit"))
    rows = snapshots.read_positional(spark, landing).withColumn("unit", snapshots.snapshot_unit(F.col(snapshots.SOURCE_PATH)))
    day = file_date(F.col("unit")).alias("import_date")
    return rows.join(fresh, "unit", "left_semi").groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))


def incremental_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layouts, the older with blank prices and its columns in another order."""
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "stocks", "ingest"))
    stocks = event_stocks(spark, sf_dir)
    newer = F.col("price_gbp").isNull()
    blank = reshape.set_cell(stocks.where(~newer), to_number("availability") % 5 == 0, "price_gbp", F.lit(None).cast("double"))
    land_csv(blank, f"{landing}/older", dict(reversed(LEGACY_HEADERS.items())))
    incremental.ingest_new_snapshots(spark, landing, table, checkpoint)
    land_csv(stocks.where(newer), f"{landing}/newer", CURRENT_HEADERS)
    incremental.ingest_new_snapshots(spark, landing, table, checkpoint)
    return tables.read_stocks(spark, table)


# --- tables and sinks -----------------------------------------------------------


def parquet_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stocks")
    writers.write_stocks(event_stocks(spark, sf_dir), path, even_files=True)
    return views.on_day(tables.read_stocks(spark, path), AS_OF)


def named_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.register_views(spark, event_stocks(spark, sf_dir), PRODUCT_TYPE, AS_OF)
    today = tables.named(spark, "product_stocks_view_today")
    views.drop_views(spark)
    return today


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "replaced")
    stocks = event_stocks(spark, sf_dir)
    writers.replace_table(stocks.select("code"), path)
    writers.replace_table(stocks.select("code", "title", "import_date"), path)
    return spark.read.parquet(path)


def appended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "appended")
    stocks = event_stocks(spark, sf_dir)
    last = F.col("import_date") == F.lit(AS_OF)
    writers.write_stocks(stocks.where(~last), path, even_files=True)
    writers.append_rows(stocks.where(last), path)
    return tables.read_stocks(spark, path)


def partition_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, its last day then reloaded with prices raised by one."""
    path = scratch_path(spark, "reloaded")
    stocks = event_stocks(spark, sf_dir)
    writers.write_stocks(stocks, path, even_files=True)
    day = views.on_day(stocks, AS_OF)
    writers.reload_days(day.withColumn("price_incl_vat", F.round(F.col("price_incl_vat") + 1, 2)), path)
    return tables.read_stocks(spark, path)


def emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All codes of the last day deleted, written and read back."""
    path = scratch_path(spark, "emptied")
    writers.write_stocks(event_stocks(spark, sf_dir), path, even_files=True)
    day = views.on_day(tables.read_stocks(spark, path), AS_OF)
    writers.reload_days(quality.delete_by_key(day, day.select("code")), path, [AS_OF])
    return tables.read_stocks(spark, path)


def repair_written_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "repaired")
    writers.write_stocks(event_stocks(spark, sf_dir), path, even_files=True)
    quality.repair_day(tables.read_stocks(spark, path), path, AS_OF, 6)
    return tables.read_stocks(spark, path)


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "sales")
    sales = movement.units_sold_by_date(event_products(spark, sf_dir), AS_OF)
    path = writers.write_dated_csv(sales, folder, "sales", AS_OF, separator="-")
    schema = "import_date date, code string, title string, url string, price_gbp double, availability double, units_sold double, price_changes_count bigint"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def csv_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "by-day")
    writers.write_csv_by_day(event_stocks(spark, sf_dir).select("code", "title", "availability", "import_date"), folder)
    schema = "code string, title string, availability string, import_date date"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(folder)


# --- rows and columns -----------------------------------------------------------


def tolerant_numbers(stocks: DataFrame) -> DataFrame:
    """Numbers read from clean and from spoilt text."""
    return stocks.select(
        "code", "import_date",
        to_number("availability").alias("units"),
        to_number("availability", strict=True).alias("units_strict"),
        to_number(F.concat("availability", F.lit(" left"))).alias("units_spoilt"),
    )


def title_clean(products: DataFrame) -> DataFrame:
    return products.select(
        "code", "import_date",
        drop_punctuation(drop_literal(F.concat("title", F.lit("`s (70cl)!")), "`")).alias("clean_title"),
    )


def title_slug(products: DataFrame) -> DataFrame:
    title = strip(F.concat(F.lit(" "), "title", F.lit("\t")))
    return products.select(
        "code", "import_date", slug_url(title, "https://shop.example.org/product/", "-item").alias("slug")
    )


def path_dates(stocks: DataFrame) -> DataFrame:
    """Dates out of file names: by pattern, and by splitting and joining."""
    path = F.concat(F.lit("/landing/full-stock-list_"), F.date_format("import_date", "yyyy_MM_dd"), F.lit(".csv"))
    parts = F.split(F.split(path, r"\.")[0], "_")
    return stocks.select(
        "code", file_date(path).alias("by_pattern"),
        F.right(F.array_join(parts, "-"), F.lit(10)).alias("by_parts"),
        file_date(F.concat(F.lit("stock_2024_13_"), "availability")).alias("no_date"),
    )


def fill_dates(stocks: DataFrame) -> DataFrame:
    """The older layout's rows lose their date and get the last day's."""
    older = F.col("price_gbp").isNotNull()
    undated = reshape.set_cell(stocks, older, "import_date", F.lit(None).cast("date"))
    return reshape.fill_missing(undated, "import_date", F.lit(AS_OF)).select("code", "availability", "import_date")


def set_price(stocks: DataFrame) -> DataFrame:
    cell = (F.col("code") == "SKU00001") & (F.col("import_date") == F.lit(AS_OF))
    return reshape.set_cell(stocks, cell, "price_incl_vat", F.lit(24500.0)).select(
        "code", "import_date", "price_incl_vat"
    )


def delete_keys(stocks: DataFrame) -> DataFrame:
    day = views.on_day(stocks, AS_OF)
    return quality.delete_by_key(day, quality.duplicate_codes(day))


def union_replace(stocks: DataFrame) -> DataFrame:
    day = views.on_day(stocks, AS_OF)
    corrected = quality.averaged_duplicates(day, 6).withColumn("availability", F.col("availability").cast("bigint").cast("string"))
    return quality.replace_subset(day.select(*quality.IDENTITY, "availability", "price_gbp"), corrected)


def renamed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source headers and back again, through a CSV export."""
    path = scratch_path(spark, "source-layout")
    writers.write_csv(reshape.source_layout(event_stocks(spark, sf_dir)), path)
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return reshape.to_canonical_names(raw).withColumn("price_gbp", to_number("price_gbp"))


def first_listed(products: DataFrame) -> DataFrame:
    return reshape.first_rows(
        products.select("import_date", "code", "title", "price_gbp", "availability"), 20,
        F.col("price_gbp").desc_nulls_last(), "code", "import_date", "availability",
    )


def units_sold_counted(products: DataFrame) -> DataFrame:
    """Equal sales as one row; rows that differ only in the earlier day's unused columns are added up."""
    sold = movement.units_sold_all(products)
    return sold.groupBy(*[c for c in sold.columns if c != "copies"]).agg(F.sum("copies").alias("copies"))


def price_points(products: DataFrame) -> DataFrame:
    """Offers at the lowest and at the highest price there is."""
    points = products.agg(F.min("price_gbp"), F.max("price_gbp")).first()
    return products.where(filters.price_is_one_of("price_gbp", points)).select("code", "title", "price_gbp", "url").distinct()


def discounts_by_title(products: DataFrame) -> DataFrame:
    items = reshape.by_measure(reports.discounted_items(products, AS_OF), "title", "current_price")
    return items.withColumn("current_price", F.round("current_price", 2))


def with_parameters(products: DataFrame) -> DataFrame:
    return reshape.constant_columns(views.today_view(products, AS_OF), {
        "target_date": F.lit(AS_OF), "target_text": day_text(F.lit(AS_OF)),
    })


def empty_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there are products of a known and of an unknown type."""
    stocks = event_stocks(spark, sf_dir)
    kinds = {name: views.product_view(stocks, name) for name in (PRODUCT_TYPE, "no such type")}
    return spark.createDataFrame([(name, filters.is_empty(df)) for name, df in kinds.items()], "type string, is_empty boolean")


# --- pages ----------------------------------------------------------------------


def page_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    heads = unescape_all(F.array(jsonld.page_title(html), jsonld.og_title(html)))
    return product_pages(spark, sf_dir).select(
        "page_id", strip(heads[0]).alias("page_title"), strip(heads[1]).alias("og_title")
    )


def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON-LD blocks, objects after unfolding, and their types, per page."""
    blocks = jsonld.script_blocks(F.col("html"))
    pages = product_pages(spark, sf_dir).select("page_id", blocks.alias("blocks"))
    parsed = pages.withColumn("objects", jsonld.parse_blocks(F.col("blocks"))).withColumn(
        "docs", jsonld.flatten_graph(F.col("objects"))
    )
    types = F.flatten(F.transform("docs", lambda d: jsonld.type_names(d["doc"])))
    return parsed.select(
        "page_id", F.size("blocks").alias("block_count"), F.size("objects").alias("object_count"),
        F.size("docs").alias("doc_count"), F.array_join(types, ",").alias("types"),
    )


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.metadata_table(product_pages(spark, sf_dir)).drop("categories")


def page_crumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = metadata.page_documents(product_pages(spark, sf_dir))
    crumbs = jsonld.breadcrumbs(F.col("docs"))
    return docs.select(
        "url", F.array_join(crumbs, "|").alias("crumbs"),
        F.array_join(jsonld.drop_home(crumbs), "|").alias("kept_crumbs"),
    )


TEMPLATE = {"url": "", "item_id": "X00000", "name": "Sample", "type": "Single Malt", "country": "Japan"}


def page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = {"url": "url", "item_id": "hed_id", "name": "product_name"}
    return metadata.schema_rows(product_pages(spark, sf_dir), TEMPLATE, found)


QUERIES = {
    # ingest
    "ingest_by_name": ingest_by_name,
    "ingest_positional": ingest_positional,
    "raw_by_name": raw_by_name,
    "legacy_flags": legacy_flags,
    "typed_csv": typed_csv,
    "incremental_ingest": incremental_ingest,
    "late_part_file": late_part_file,
    "new_files": new_files,
    "new_files_in_folders": new_files_in_folders,
    "incremental_by_name": incremental_by_name,
    # tables and sinks
    "parquet_day": parquet_day,
    "named_views": named_views,
    "replaced_table": replaced_table,
    "appended_rows": appended_rows,
    "partition_reload": partition_reload,
    "emptied_day": emptied_day,
    "repair_written_back": repair_written_back,
    "csv_export": csv_export,
    "csv_by_day": csv_by_day,
    # views
    "canonical_stocks": event_stocks,
    "product_view": event_products,
    "today_view": _on_products(lambda w: views.today_view(w, AS_OF)),
    # history and movement
    "price_changes": _on_products(history.price_changes),
    "versioned_days": versioned_days,
    "units_sold_bucketed": units_sold_bucketed,
    "clustered_view": clustered_view,
    "maintained_history": maintained_history,
    "maintained_series": maintained_series,
    "maintained_new_lows": maintained_new_lows,
    "maintained_discounts": maintained_discounts,
    "price_changes_approx": _on_products(lambda w: history.price_changes(w, "approx")),
    "units_sold_all": _on_products(lambda w: movement.units_sold_all(w, as_rows=True)),
    "units_sold_all_present": _on_products(lambda w: movement.units_sold_all(w, count_vanished=False, as_rows=True)),
    "units_sold_counted": _on_products(units_sold_counted),
    "units_sold_by_date_plain": _on_products(lambda w: movement.units_sold_by_date(w, AS_OF, with_counts=False)),
    "units_sold_today": _on_current(movement.units_sold_by_date),
    "units_sold_by_date": _on_products(lambda w: movement.units_sold_by_date(w, AS_OF)),
    "units_sold_missing_day": _on_products(lambda w: movement.units_sold_by_date(w, NO_SNAPSHOT)),
    "units_moved": _on_products(lambda w: movement.units_moved(w, AS_OF)),
    "units_sold_no_vanished": _on_products(lambda w: movement.units_moved(w, AS_OF, only_sales=True)),
    # reports
    "discounted_items": _on_products(lambda w: reports.discounted_items(w, AS_OF)),
    "discounted_items_plain": _on_products(lambda w: reports.discounted_items(w, AS_OF, plain=True)),
    "discounted_items_until": _on_products(
        lambda w: reports.discounted_items(w, RELANDED, plain=True, until=RELANDED)
    ),
    "discounted_items_today": _on_current(reports.discounted_items),
    "discount_screen": _on_products(
        lambda w: reports.discount_screen(reports.discounted_items(w, AS_OF), 10, 500, 10.0, "small|hot")
    ),
    "discount_alert": _on_products(lambda w: reports.discount_alert(reports.discounted_items(w, AS_OF), 50)),
    "discounts_by_title": _on_products(discounts_by_title),
    "daily_stock_summary": _on_products(reports.daily_stock_summary),
    "daily_stock_summary_approx": _on_products(lambda w: reports.daily_stock_summary(w, "approx")),
    "daily_stock_summary_text": _on_products(
        lambda w: reports.daily_stock_summary(w, strict=True, dates_as_text=True)
    ),
    "daily_counts_and_medians": _on_products(reports.daily_counts_and_medians),
    "daily_long": _on_products(lambda w: reports.daily_long(reports.daily_stock_summary(w))),
    "code_series": _on_products(lambda w: reports.code_series(w, CODES)),
    "code_series_all": _on_products(reports.code_series),
    "code_series_approx": _on_products(lambda w: reports.code_series(w, median="approx")),
    "code_series_contains": _on_products(lambda w: reports.code_series(w, ["sku00001", "0007"], contains=True)),
    "price_search": _on_products(lambda w: reports.price_search(w, AS_OF)),
    "price_search_plain": _on_products(lambda w: reports.price_search(w, AS_OF, with_counts=False)),
    "dirty_units_sold_all": _on_dirty(lambda w: movement.units_sold_all(w, as_rows=True)),
    "dirty_daily_summary": _on_dirty(reports.daily_stock_summary),
    "dirty_code_series": _on_dirty(reports.code_series),
    "dirty_discounted_items": _on_dirty(lambda w: reports.discounted_items(w, AS_OF)),
    "dirty_price_ranks": _on_dirty(ranking.price_ranks),
    "price_search_screen": _on_products(
        lambda w: reports.price_screen(reports.price_search(w, AS_OF), 0, 5000, "SMALL")
    ),
    "max_price_by_title": _on_products(reports.max_price_by_title),
    "max_price_screen": _on_products(lambda w: reports.price_screen(reports.max_price_by_title(w), 50, 5000, "ring")),
    "price_ranks": _on_products(ranking.price_ranks),
    "new_low_today": _on_products(lambda w: ranking.new_lows(w, AS_OF)),
    "totals": _on_products(
        lambda w: reports.totals(w).select("row_count", F.round("price_sum", 2).alias("price_sum"), F.round("price_avg", 6).alias("price_avg"))
    ),
    # quality
    "row_counts": _on_stocks(quality.row_counts),
    "snapshot_days": _on_stocks(movement.snapshot_days),
    "duplicate_codes": _on_stocks(lambda s: quality.duplicate_codes(views.on_day(s, AS_OF))),
    "duplicate_repair": _on_stocks(lambda s: quality.averaged_duplicates(views.on_day(s, AS_OF), 6)),
    "repaired_day": _on_stocks(lambda s: quality.repaired_day(s, AS_OF, 6)),
    "delete_keys": _on_stocks(delete_keys),
    "union_replace": _on_stocks(union_replace),
    "duplicate_titles": _on_products(quality.same_title_different_code),
    "price_points": _on_products(price_points),
    "null_price_audit": _on_stocks(
        lambda s: quality.null_price_audit(s.where(F.col("type") == PRODUCT_TYPE))
    ),
    "null_price_audit_stocks": _on_stocks(quality.null_price_audit),
    "fill_dates": _on_stocks(fill_dates),
    "set_price": _on_stocks(set_price),
    # rows and columns
    "tolerant_numbers": _on_stocks(tolerant_numbers),
    "title_features": _on_products(lambda w: reports.title_features(w.select("code", "title", "import_date"))),
    "title_features_leading": _on_products(
        lambda w: reports.title_features(w.select("code", "title", "import_date"), trailing_number=False)
    ),
    "title_clean": _on_products(title_clean),
    "title_slug": _on_products(title_slug),
    "path_dates": _on_stocks(path_dates),
    "source_layout_export": _on_stocks(lambda s: reshape.source_layout(s, LEGACY_HEADERS, AS_OF)),
    "renamed_source": renamed_source,
    "first_listed": _on_products(first_listed),
    "with_parameters": _on_products(with_parameters),
    "empty_checks": empty_checks,
    # pages
    "page_table": lambda spark, sf_dir: tables.read_pages(spark, f"{sf_dir}/pages.parquet"),
    "page_heads": page_heads,
    "page_blocks": page_blocks,
    "page_crumbs": page_crumbs,
    "page_metadata": page_metadata,
    "page_template": page_template,
    # the same operators on the larger line table
    "line_price_changes": _on_lines(history.price_changes),
    "line_daily_summary": _on_lines(reports.daily_stock_summary),
    "line_code_series": _on_lines(reports.code_series),
    "line_units_sold_all": _on_lines(lambda w: movement.units_sold_all(w, as_rows=True)),
    "line_units_sold_by_date": _on_lines(lambda w: movement.units_sold_by_date(w, LINE_DAY)),
    "line_discounted_items": _on_lines(lambda w: reports.discounted_items(w, LINE_DAY)),
    "line_new_lows": _on_lines(lambda w: ranking.new_lows(w, LINE_DAY)),
    "line_price_ranks": _on_lines(ranking.price_ranks),
    "line_duplicate_titles": _on_lines(quality.same_title_different_code),
}
