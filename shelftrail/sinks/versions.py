"""Tables whose days are replaced in one step.

Each commit writes its days to a folder of its own that nobody reads yet, and then a manifest
that names, for every day of the table, the commit holding it. A manifest appears as a whole,
by a rename that fails where there is one of that number already, and readers take the one
of the highest number. So a writer that dies at any moment leaves the old table or the new
one, and of two writers who start from the same state only one succeeds.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import date

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from shelftrail import session


def _path(spark: SparkSession, *parts: str) -> tuple[JavaObject, JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of a table's manifests, ascending; none for a table of another kind."""
    return sorted(int(n) for n in session.folder_names(spark, f"{path.rstrip('/')}/_manifests") if n.isdigit())


def manifest(spark: SparkSession, path: str, version: int) -> dict[str, str]:
    """The commit of each day of a version, by ISO date."""
    files, target = _path(spark, path, "_manifests", str(version))
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(target), "UTF-8"))
    try:
        return json.loads(reader.readLine())
    finally:
        reader.close()


def _publish(spark: SparkSession, path: str, version: int, days: dict[str, str]) -> None:
    files, target = _path(spark, path, "_manifests", str(version))
    _, draft = _path(spark, path, "_manifests", f"_draft-{session.unused_name()}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(days, sort_keys=True).encode()))
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise RuntimeError(f"another writer made version {version} of {path}")


def create(spark: SparkSession, path: str) -> None:
    """An empty table at `path`, unless there is one of this kind."""
    if not versions(spark, path):
        _publish(spark, path, 0, {})


def _commit_folder(path: str, commit: str) -> str:
    return f"{path.rstrip('/')}/commit={commit}"


def replace_days(stocks: DataFrame, path: str, days: Iterable[date], write) -> int:
    """Replace `days` of the table by the rows of `stocks`, which has no others, and return the new version.

    `write(rows, folder)` writes rows in a folder per import_date. A day without rows is no
    longer part of the table. The rows may come from the table itself.
    """
    spark, names = stocks.sparkSession, {d.isoformat() for d in days}
    latest = versions(spark, path)[-1]
    commit = session.unused_name()
    folder = _commit_folder(path, commit)
    write(stocks, folder)
    present = {n.removeprefix("import_date=") for n in session.folder_names(spark, folder) if n.startswith("import_date=")}
    if not present <= names:
        session.delete_path(spark, folder)
        raise ValueError(f"rows of days that aren't reloaded: {sorted(present - names)}")
    kept = {d: c for d, c in manifest(spark, path, latest).items() if d not in names}
    _publish(spark, path, latest + 1, {**kept, **dict.fromkeys(present, commit)})
    return latest + 1


def read(spark: SparkSession, path: str, schema, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the latest. A DataFrame stays with the version it was made of."""
    known = versions(spark, path)
    days = manifest(spark, path, known[-1] if version is None else version)
    folders = [f"{_commit_folder(path, commit)}/import_date={day}" for day, commit in sorted(days.items())]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.fieldNames())


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> None:
    """Delete all versions but the latest `keep`, and what only they or failed writers hold.

    Not to be run beside a writer, whose unpublished commit would go, or readers of older versions.
    """
    known = versions(spark, path)
    used = {f"commit={c}" for v in known[-keep:] for c in manifest(spark, path, v).values()}
    for name in session.folder_names(spark, path):
        if name.startswith("commit=") and name not in used:
            session.delete_path(spark, f"{path.rstrip('/')}/{name}")
    for name in session.folder_names(spark, f"{path.rstrip('/')}/_manifests"):
        if name.startswith("_draft-") or (name.isdigit() and int(name) not in known[-keep:]):
            session.delete_path(spark, f"{path.rstrip('/')}/_manifests/{name}")
