"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_temporary: dict[str, str] = {}


def build(app_name: str = "shelftrail", master: str | None = None, **settings: str) -> SparkSession:
    """Session with this library's settings; `settings` uses `_` for `.` in keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("_", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A session whose tasks all run in this process needs none: it gets one temporary
    folder, once. Anything else, `local-cluster` included, must name a folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _temporary:
        _temporary[context.applicationId] = tempfile.mkdtemp(prefix="shelftrail-")
    return _temporary[context.applicationId]


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/shelftrail/{spark.sparkContext.applicationId}"


def unused_name() -> str:
    return uuid.uuid4().hex


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet inside the shared folder."""
    return f"{_scratch(spark)}/{name}-{unused_name()}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables of this application; DataFrames on them end with it."""
    delete_path(spark, _scratch(spark))


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store Spark reaches it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in files.listStatus(target)) if files.exists(target) else []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Used where a result feeds two actions: the table survives lost executors and
    the second action reads only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
