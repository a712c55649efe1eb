"""Days replaced in one step: old or new, never a mixture, whenever a writer dies."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelftrail import session
from shelftrail.operators.quality import repair_day
from shelftrail.sinks import versions, writers
from shelftrail.sources.tables import read_stocks

A, B, C = (date(2024, 1, d) for d in (1, 2, 3))


def rows_of(stocks_of, **days):
    return stocks_of(*[dict(code=c, import_date={"a": A, "b": B, "c": C}[d], type="Gin", price_gbp=1.0, availability="1") for d, codes in days.items() for c in codes])


def content(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["import_date"], []).append(r["code"])
    return {d: "".join(sorted(c)) for d, c in out.items()}


@pytest.fixture
def table(spark, stocks_of, tmp_path):
    path = str(tmp_path / "t")
    versions.create(spark, path)
    versions.create(spark, path)
    writers.reload_days(rows_of(stocks_of, a="xy", b="z"), path)
    return path


def test_replace_empty_and_add(spark, stocks_of, table):
    assert content(read_stocks(spark, table)) == {A: "xy", B: "z"}
    before = read_stocks(spark, table)
    writers.reload_days(rows_of(stocks_of, b="uv", c="w"), table, [A, B, C])
    assert content(read_stocks(spark, table)) == {B: "uv", C: "w"}
    assert content(before) == {A: "xy", B: "z"}                     # a reader keeps its version
    assert versions.versions(spark, table) == [0, 1, 2]
    writers.reload_days(read_stocks(spark, table).where(F.col("code") == "u"), table, [B])  # from the table itself
    assert content(read_stocks(spark, table)) == {B: "u", C: "w"}
    writers.reload_days(read_stocks(spark, table).limit(0), table, [B, C])
    assert content(read_stocks(spark, table)) == {}


@pytest.mark.parametrize("moment", ["before the write", "after the write", "before the rename"])
def test_a_writer_that_dies_changes_nothing(spark, stocks_of, table, monkeypatch, moment):
    class Killed(BaseException):
        pass

    def die(*args, **kwargs):
        raise Killed

    new = rows_of(stocks_of, b="new")
    if moment == "before the write":
        monkeypatch.setattr(writers, "_by_day", die)
    elif moment == "after the write":
        monkeypatch.setattr(versions, "_publish", die)
    else:
        monkeypatch.setattr(versions.json, "dumps", die)
    with pytest.raises(Killed):
        writers.reload_days(new, table, [A, B])
    monkeypatch.undo()
    assert content(read_stocks(spark, table)) == {A: "xy", B: "z"}
    writers.reload_days(new, table, [A, B])                          # the rerun
    assert content(read_stocks(spark, table)) == {B: "enw"}
    versions.vacuum(spark, table)
    assert content(read_stocks(spark, table)) == {B: "enw"}
    assert len([p for p in Path(table).iterdir() if p.name.startswith("commit=")]) == 1
    assert [p.name for p in (Path(table) / "_manifests").iterdir() if not p.name.startswith(".")] == ["2"]


def test_of_two_writers_one_succeeds(spark, stocks_of, table, monkeypatch):
    known = versions.versions(spark, table)
    writers.reload_days(rows_of(stocks_of, b="first"), table, [B])
    monkeypatch.setattr(versions, "versions", lambda *_: known)      # the second started before that
    with pytest.raises(RuntimeError, match="another writer"):
        writers.reload_days(rows_of(stocks_of, a="second"), table, [A])
    monkeypatch.undo()
    assert content(read_stocks(spark, table)) == {A: "xy", B: "".join(sorted("first"))}


def test_rows_of_other_days_are_an_error(spark, stocks_of, table):
    with pytest.raises(ValueError, match="aren't reloaded"):
        writers.reload_days(rows_of(stocks_of, a="q", c="q"), table, [A])
    assert content(read_stocks(spark, table)) == {A: "xy", B: "z"}


def test_older_versions_and_pruning(spark, stocks_of, table):
    writers.reload_days(rows_of(stocks_of, a="n"), table, [A])
    schema = read_stocks(spark, table).schema
    assert content(versions.read(spark, table, schema, 1)) == {A: "xy", B: "z"}
    assert content(versions.read(spark, table, schema, 0)) == {}
    plan = read_stocks(spark, table).where(F.col("import_date") == F.lit(B))._jdf.queryExecution().executedPlan().toString()
    assert "import_date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_repair_is_one_step(spark, stocks_of, tmp_path):
    path = str(tmp_path / "r")
    versions.create(spark, path)
    writers.reload_days(rows_of(stocks_of, a="xxy", b="z"), path)
    repair_day(read_stocks(spark, path), path, A)
    assert content(read_stocks(spark, path)) == {A: "xy", B: "z"}
    assert session.folder_names(spark, str(tmp_path / "none")) == []
