"""CSV layouts, table writes and incremental ingest."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from shelftrail import session as spark_session
from shelftrail.operators.reshape import source_layout, to_canonical_names
from shelftrail.plans import daily
from shelftrail.schema import CANONICAL_COLUMNS, CURRENT_HEADERS, LEGACY_HEADERS
from shelftrail.sinks import writers
from shelftrail.sources import snapshots, tables
from shelftrail.streaming.incremental import ingest_new_snapshots

OLD = "Code,Title,Size,Style,Country,Group,Available,Price (GBP)\n"
NEW = "Code,Title,Vintage,Size,ABV,Style,Country,Group,Available,Price (inc VAT),Price (ex-VAT),Link\n"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    put(folder, "full-stock-list_2024_01_01.csv",
        OLD + 'A,"Dram, ""old""",70cl,Dry,FR,Whisky,3,10.5\n' + "B,No price,70cl,Dry,FR,Whisky,1,\n")
    put(folder, "full-stock-list_2024_01_02.csv",
        NEW + "A,Dram,1984,70cl,46.5,Dry,FR,Whisky,2,12,10,https://x/a\n" + "C,Dirty,,70cl,n/a,Dry,FR,Whisky,many,x,y,\n")
    put(folder, "no-date.csv", OLD + "D,Undated,70cl,Dry,FR,Whisky,1,1\n")
    return str(folder)


def by_code(df, day=None):
    rows = df.where(F.col("import_date") == F.lit(day)) if day else df
    return {r["code"]: r for r in rows.collect()}


def test_by_name(spark, landing):
    stocks = snapshots.build_stocks(spark, landing)
    assert stocks.columns == CANONICAL_COLUMNS and stocks.count() == 5
    first = by_code(stocks, date(2024, 1, 1))
    assert first["A"]["title"] == 'Dram, "old"'
    assert (first["A"]["price_gbp"], first["A"]["price_incl_vat"], first["A"]["availability"]) == (10.5, None, "3")
    assert (first["B"]["type"], first["B"]["price_gbp"], first["B"]["availability"]) == ("Whisky", None, "1")
    second = by_code(stocks, date(2024, 1, 2))
    assert (second["A"]["price_gbp"], second["A"]["price_incl_vat"], second["A"]["abv"]) == (None, 12.0, 46.5)
    assert (second["C"]["abv"], second["C"]["price_incl_vat"], second["C"]["availability"]) == (None, None, "many")
    assert by_code(stocks)["D"]["import_date"] is None


def test_by_position(spark, landing):
    stocks = snapshots.build_stocks(spark, landing, "positional")
    first = by_code(stocks, date(2024, 1, 1))
    assert (first["A"]["country"], first["A"]["type"], first["A"]["price_gbp"]) == ("FR", "Whisky", 10.5)
    # An older row without a price looks like a newer one and is shifted.
    assert (first["B"]["type"], first["B"]["price_gbp"], first["B"]["vintage"]) == (None, None, "70cl")
    assert by_code(stocks, date(2024, 1, 2))["A"]["url"] == "https://x/a"


def test_readers_agree_on_rows_with_a_price(spark, landing):
    priced = F.coalesce("price_gbp", "price_incl_vat").isNotNull()
    a, b = (snapshots.build_stocks(spark, landing, k).where(priced) for k in ("by_name", "positional"))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_aliases(spark, tmp_path):
    put(tmp_path / "l", "s_2024_01_03.csv", "title,code,available,availability,abv,price_gbp,extra\nT,A,,7,40,1.5,zzz\n")
    put(tmp_path / "l", "s_2024_01_04.csv", "﻿Code,Title,Available\nB,T,1\n")
    rows = by_code(snapshots.stocks_by_name(spark, str(tmp_path / "l")))
    assert (rows["A"]["availability"], rows["A"]["price_gbp"], rows["A"]["abv"]) == ("7", 1.5, 40.0)
    assert (rows["B"]["availability"], rows["B"]["price_gbp"]) == ("1", None)


def test_raw_union(spark, landing):
    raw = snapshots.read_by_name(spark, landing)
    assert {"Price (GBP)", "Price (inc VAT)", "Link", snapshots.SOURCE_PATH} <= set(raw.columns)
    assert raw.count() == 5
    assert len(snapshots.header_groups(spark, landing)) == 2


def test_part_files_of_one_snapshot(spark, tmp_path):
    folder = tmp_path / "l" / "full-stock-list_2024_01_05.csv"
    put(folder, "part-0.csv", OLD + "A,t,s,d,FR,Whisky,1,1\n")
    put(folder, "part-1.csv", OLD + "B,t,s,d,FR,Whisky,1,1\n")
    assert sorted(by_code(snapshots.stocks_by_name(spark, str(tmp_path / "l")))) == ["A", "B"]
    put(folder, "part-2.csv", "Title,Code,Size,Style,Country,Group,Available,Price (GBP)\nt,C,s,d,FR,Whisky,1,1\n")
    with pytest.raises(Exception, match="header"):
        snapshots.stocks_by_name(spark, str(tmp_path / "l")).collect()


def test_odd_names_and_empty_files(spark, tmp_path):
    folder = tmp_path / "l x"
    put(folder, "list [1] 100%_2024_01_05.csv", OLD + "A,t,s,d,FR,Whisky,1,1\n")
    put(folder / "full_2024_01_06.csv", "part-0.csv", "")
    put(folder / "full_2024_01_06.csv", "part-1.csv", NEW + "B,t,,s,,d,FR,Whisky,1,2,1,u\n")
    for layout in ("by_name", "positional"):
        rows = by_code(snapshots.build_stocks(spark, str(folder), layout))
        assert {c: r["import_date"] for c, r in rows.items()} == {"A": date(2024, 1, 5), "B": date(2024, 1, 6)}


def test_headers_there_and_back(spark, landing):
    stocks = snapshots.build_stocks(spark, landing)
    for headers in (LEGACY_HEADERS, CURRENT_HEADERS):
        out = source_layout(stocks, headers)
        assert out.columns == list(headers.values())
        assert to_canonical_names(out).columns == list(headers)


def test_table_writes(spark, landing, tmp_path):
    stocks = snapshots.build_stocks(spark, landing).where("import_date IS NOT NULL")
    path = str(tmp_path / "table")
    writers.write_stocks(stocks, path)
    writers.write_stocks(stocks, path, even_files=True)
    table = tables.read_stocks(spark, path)
    assert table.count() == 4
    day = date(2024, 1, 2)
    plan = table.where(F.col("import_date") == F.lit(day))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(import_date" in plan
    writers.reload_days(table.where((F.col("import_date") == F.lit(day)) & (F.col("code") == "A")), path)
    table = tables.read_stocks(spark, path)
    assert sorted(r["code"] for r in table.collect()) == ["A", "A", "B"]
    writers.append_rows(table.where("code = 'B'"), path)
    assert tables.read_stocks(spark, path).count() == 4


def test_saved_table(spark):
    writers.save_table(spark.range(3), "saved_numbers")
    writers.save_table(spark.range(2), "saved_numbers")
    assert tables.named(spark, "saved_numbers").count() == 2


def test_dated_names(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "x", y')], "c string, t string")
    for separator, name in (("_", "sales_2024_01_30.csv"), ("-", "sales_2024-01-30.csv")):
        path = writers.write_dated_csv(df, str(tmp_path), "sales", "2024-01-30", separator)
        assert path.endswith(name)
        assert spark.read.option("header", True).option("escape", '"').csv(path).first()["t"] == 'say "x", y'


def test_new_files(spark, landing, tmp_path):
    earlier = put(tmp_path / "loaded", "full-stock-list_2024_01_01.csv", OLD)
    fresh = snapshots.new_files(snapshots.snapshot_files(spark, landing), snapshots.snapshot_files(spark, earlier))
    assert sorted(r["file_name"] for r in fresh.collect()) == ["full-stock-list_2024_01_02.csv", "no-date.csv"]


def test_new_files_in_folders(spark, tmp_path):
    """Part files have the same names in every folder."""
    for day in (20, 21):
        put(tmp_path / "l" / f"full_2024_01_{day}.csv", "part-0.csv", OLD + "A,t,s,d,FR,Whisky,1,1\n")
    listing = snapshots.snapshot_files(spark, str(tmp_path / "l"))
    fresh = snapshots.new_files(listing, listing.where(F.col(snapshots.SOURCE_PATH).contains("01_20")))
    assert [r["file_name"] for r in fresh.collect()] == ["full_2024_01_21.csv/part-0.csv"]


def test_headers_need_no_job(spark, tmp_path):
    for day in range(1, 29):
        put(tmp_path / "l", f"s_2024_02_{day:02d}.csv", (OLD if day % 2 else NEW))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "")
    assert len(snapshots.header_groups(spark, str(tmp_path / "l"))) == 2
    assert len(tracker.getJobIdsForGroup("headers")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_headers_cost_the_same_for_any_file_size(spark, tmp_path):
    """Bytes read from the file system, as Hadoop counts them."""
    def read(rows):
        folder = put(tmp_path / str(rows), "s_2024_02_01.csv", NEW + "A,t,,s,,d,FR,Whisky,1,2,1,u\n" * rows)
        stats = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
        before = stats.getLong("bytesRead")
        snapshots.file_headers(spark, folder)
        return stats.getLong("bytesRead") - before

    read(10)
    small, large = read(30_000), read(1_000_000)
    assert large == small


def test_all_layouts_in_one_scan(spark, tmp_path):
    for day in range(1, 6):
        header = ",".join(["Code", "Title", *[f"Extra{i}" for i in range(day)], "Available"])
        put(tmp_path / "l", f"s_2024_02_{day:02d}.csv", f"{header}\nA{day},t,{'x,' * day}{day}\n")
    stocks = snapshots.stocks_by_name(spark, str(tmp_path / "l"))
    assert stocks._jdf.queryExecution().sparkPlan().toString().count("FileScan csv") == 1
    assert {r["code"]: r["availability"] for r in stocks.collect()} == {f"A{d}": str(d) for d in range(1, 6)}
    assert snapshots.stocks_by_name(spark, str(tmp_path / "l"), files=[]).count() == 0


def test_a_file_without_a_known_header_fails(spark, tmp_path):
    folder = put(tmp_path / "l", "s_2024_02_01.csv", OLD + "A,t,s,d,FR,Whisky,1,1\n")
    found = snapshots.layouts(spark, folder)
    put(tmp_path / "l", "s_2024_02_02.csv", OLD + "B,t,s,d,FR,Whisky,1,1\n")
    with pytest.raises(Exception, match="no header was read"):
        snapshots._cells(spark, folder, found, False).collect()


def test_emptied_day(spark, tmp_path):
    path, day = str(tmp_path / "t"), date(2024, 1, 2)
    rows = spark.createDataFrame([("A", date(2024, 1, 1)), ("B", day), ("B", day)], "code string, import_date date")
    writers.write_stocks(rows, path)
    table = spark.read.parquet(path)
    writers.reload_days(table.where((F.col("import_date") == F.lit(day)) & (F.col("code") != "B")), path, [day])
    assert [r["code"] for r in spark.read.parquet(path).collect()] == ["A"]
    with pytest.raises(ValueError, match="2024-01-01"):
        writers.reload_days(rows, path, [day])


def test_late_part_file(spark, tmp_path):
    folder, table, state = tmp_path / "in" / "full_2024_01_20.csv", str(tmp_path / "t"), str(tmp_path / "s")
    for name, code in (("part-0.csv", "A"), ("part-1.csv", "B")):
        put(folder, name, OLD + f"{code},t,s,d,FR,Whisky,3,10\n")
        ingest_new_snapshots(spark, str(tmp_path / "in"), table, state)
    assert sorted(r["code"] for r in tables.read_stocks(spark, table).collect()) == ["A", "B"]


def test_incremental_by_name(spark, tmp_path):
    """Blank prices and reordered columns come out right, as in a rebuild."""
    folder, table = tmp_path / "in", str(tmp_path / "t")
    put(folder, "full_2024_01_01.csv", OLD + "B,No price,70cl,Dry,FR,Whisky,1,\n")
    put(folder, "full_2024_01_02.csv", "Title,Code,Available,Price (GBP),Group\nT,A,4,2.5,Whisky\n")
    ingest_new_snapshots(spark, str(folder), table, str(tmp_path / "s"))
    rows = by_code(tables.read_stocks(spark, table))
    assert (rows["B"]["type"], rows["B"]["availability"], rows["B"]["style"]) == ("Whisky", "1", "Dry")
    assert (rows["A"]["title"], rows["A"]["price_gbp"], rows["A"]["type"]) == ("T", 2.5, "Whisky")


def test_scratch_is_deleted(spark, tmp_path):
    spark_session.materialize(spark.range(3), "trial")
    assert glob.glob(f"{spark_session.shared_folder(spark)}/shelftrail/*/trial-*".removeprefix("file:"))
    spark_session.clear_scratch(spark)
    assert not glob.glob(f"{spark_session.shared_folder(spark)}/shelftrail/*/trial-*".removeprefix("file:"))


def test_incremental(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "s")

    def run():
        ingest_new_snapshots(spark, str(folder), table, state)
        return sorted((str(r["import_date"]), r["code"], r["availability"]) for r in tables.read_stocks(spark, table).collect())

    put(folder, "full-stock-list_2024_01_01.csv", OLD + "A,t,s,d,FR,Whisky,3,10\nB,t,s,d,FR,Whisky,1,9\n")
    put(folder, "full-stock-list_2024_01_02.csv", OLD + "A,t,s,d,FR,Whisky,2,10\n")
    put(folder, "no-date.csv", OLD + "X,t,s,d,FR,Whisky,2,10\n")
    first = run()
    assert first == [("2024-01-01", "A", "3"), ("2024-01-01", "B", "1"), ("2024-01-02", "A", "2")]
    assert run() == first                                             # nothing new, nothing added
    put(folder, "full-stock-list_2024_01_03.csv", OLD + "A,t,s,d,FR,Whisky,1,10\n")
    put(folder, "full-stock-list_2024_01_01_again.csv", OLD + "A,t,s,d,FR,Whisky,8,10\n")
    assert run() == [("2024-01-01", "A", "8"), ("2024-01-02", "A", "2"), ("2024-01-03", "A", "1")]
    assert spark.read.parquet(table + "_undated").count() == 1


def test_newest_of_one_batch_counts(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "full-stock-list_2024_01_01.csv", OLD + "A,t,s,d,FR,Whisky,3,10\n")
    put(folder, "a_2024_01_01.csv", OLD + "B,t,s,d,FR,Whisky,3,10\n")
    os.utime(folder / "a_2024_01_01.csv", (1, 1))
    ingest_new_snapshots(spark, str(folder), str(tmp_path / "t"), str(tmp_path / "s"))
    assert [r["code"] for r in tables.read_stocks(spark, str(tmp_path / "t")).collect()] == ["A"]


def test_daily_run(spark, tmp_path):
    folder, lake = tmp_path / "in", str(tmp_path / "lake")
    put(folder, "full-stock-list_2024_01_01.csv", OLD + "A,t,s,d,FR,Whisky,3,20\nB,t,s,d,FR,Wine,1,9\n")
    put(folder, "full-stock-list_2024_01_02.csv", OLD + "A,t,s,d,FR,Whisky,1,10\n")
    alerts = daily.run_day(spark, str(folder), lake, "Whisky", date(2024, 1, 2))
    assert [(r["code"], r["current_price"], r["old_price"]) for r in alerts.collect()] == [("A", 10.0, 20.0)]
    sales = spark.read.option("header", True).csv(f"{lake}/sales/sales_2024_01_02.csv").collect()
    assert [(r["code"], r["units_sold"]) for r in sales] == [("A", "2.0")]
    assert spark.table("product_units_sold_all_time").count() == 1
