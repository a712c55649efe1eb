"""Writing tables, days of a table, and CSV exports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from shelftrail import session
from shelftrail.functions.dates import as_date
from shelftrail.sinks import versions


#: Order of rows within a day's files: a filter on a type or a code then skips most row groups and pages.
CLUSTERED = ["import_date", "type", "code"]


def _by_day(rows: DataFrame, mode: str, row_group_bytes: int | None = None):
    """A writer of one folder per import_date, rows in order of CLUSTERED (as far as there are such columns)."""
    writer = rows.sortWithinPartitions(*[c for c in CLUSTERED if c in rows.columns]).write.mode("overwrite")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    return writer.option("partitionOverwriteMode", mode).partitionBy("import_date")


def _even_files(df: DataFrame, column: str) -> DataFrame:
    """Rows of one value together, but a value with very many rows split up (AQE)."""
    return df.hint("rebalance", F.col(column))


def write_stocks(stocks: DataFrame, path: str, even_files: bool = False, row_group_bytes: int | None = None) -> None:
    """Create or replace the Parquet table, one folder per import_date.

    Snapshots come one day per file, so a plain ingest writes without a shuffle.
    `even_files` is for input in which every task holds rows of many days. Rows are sorted
    within their task only (the day's folder needs that anyway), so that what a reader
    filters by type or code lies together; `row_group_bytes` sets how finely it may skip.
    """
    rows = _even_files(stocks, "import_date") if even_files else stocks
    _by_day(rows, "static", row_group_bytes).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, name: str) -> None:
    """Create or replace a catalogue table."""
    df.write.mode("overwrite").saveAsTable(name)


def save_bucketed(stocks: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Create or replace a catalogue table with all rows of a code in the same bucket.

    Read with `tables.read_bucketed`, day-over-day joins and groupings by code need no
    shuffle. A code is in one bucket with all its days, so this suits tables without hot
    codes; with hot ones the joins spread them, which shuffles. Files go to the warehouse, or to
    `path`.
    """
    writer = stocks.repartition(buckets, "code").write.mode("overwrite").bucketBy(buckets, "code").sortBy("code", "import_date")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_rows(df: DataFrame, path: str, by_day: bool = True) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy("import_date") if by_day else writer).parquet(path)


def reload_days(stocks: DataFrame, path: str, days: Iterable | None = None) -> None:
    """Replace the days that `stocks` holds; every other day stays.

    `days` names the days being replaced: one of them that `stocks` has no rows for
    (any more) becomes empty, and rows of other days are an error. In a table of
    `versions.create` all days are replaced in one step; in a plain one they are swapped in
    one after another when the job commits, so that a rerun after a failure is safe but
    readers may meet some days before others.
    """
    if versions.versions(stocks.sparkSession, path):
        if days is None:
            stocks = session.materialize(stocks, "reload")
            days = [r[0] for r in stocks.select("import_date").distinct().collect()]
        versions.replace_days(stocks, path, [as_date(d) for d in days], lambda rows, folder: _by_day(rows, "static").parquet(folder))
        return
    if days is not None:
        # Written first: the rows may come from the table itself, and are looked at twice.
        stocks = session.materialize(stocks, "reload")
        present = {r[0] for r in stocks.select("import_date").distinct().collect()}
        emptied = {as_date(d) for d in days}
        if not present <= emptied:
            raise ValueError(f"rows of days that aren't reloaded: {sorted(map(str, present - emptied))}")
        emptied -= present
    _by_day(stocks, "dynamic").parquet(path)
    for empty_day in emptied if days is not None else ():
        session.delete_path(stocks.sparkSession, f"{path.rstrip('/')}/import_date={empty_day.isoformat()}")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes inside a field are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_dated_csv(df: DataFrame, folder: str, prefix: str, as_of, separator: str = "_") -> str:
    """CSV named <prefix>_YYYY_MM_DD.csv (a folder of part files); returns its path."""
    day = as_date(as_of).strftime(separator.join(["%Y", "%m", "%d"]))
    path = f"{folder.rstrip('/')}/{prefix}_{day}.csv"
    write_csv(df, path)
    return path


def write_csv_by_day(df: DataFrame, folder: str, column: str = "import_date") -> None:
    """CSV in one folder per day, in one distributed write."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').partitionBy(column).csv(folder)
