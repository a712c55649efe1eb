"""Incremental ingest: each snapshot file once, each day replaced as a whole."""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from shelftrail.functions.dates import file_date
from shelftrail.sinks.writers import reload_days
from shelftrail.sources.snapshots import SOURCE_PATH, build_stocks, snapshot_files, snapshot_unit

# Fixed value: columns of the binary file source.
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def newest_files(spark: SparkSession, landing: str, days: list) -> list[str]:
    """Paths of all files of the snapshot that landed last, for each of the days."""
    files = snapshot_files(spark, landing).select(
        SOURCE_PATH, "modificationTime",
        file_date(F.col(SOURCE_PATH)).alias("import_date"), snapshot_unit(F.col(SOURCE_PATH)).alias("unit"),
    ).where(F.col("import_date").isin(days))
    landed = files.groupBy("import_date", "unit").agg(F.max("modificationTime").alias("landed"))
    latest = F.row_number().over(Window.partitionBy("import_date").orderBy(F.desc("landed"), F.desc("unit")))
    newest = landed.withColumn("place", latest).where("place = 1").select("import_date", "unit")
    return sorted(unquote(r[0]) for r in files.join(newest, ["import_date", "unit"]).select(SOURCE_PATH).collect())


def ingest_new_snapshots(
    spark: SparkSession, landing: str, table: str, checkpoint: str, layout: str = "by_name",
    on_days: Callable[[SparkSession, list], None] | None = None,
) -> StreamingQuery:
    """Load the files that landed since the last run, then stop.

    The stream's checkpoint remembers the files already taken. A day that lands again
    under a new name replaces the old one; of several snapshots of a day only the
    newest counts. A day's part files may arrive in different runs: for every day with
    a new file all files of its newest snapshot are read again. Rows whose file name
    holds no date go to a folder of their own. `on_days` is called with the days just
    replaced, again after a failure, before the run counts as done.
    """
    # A listing: without its content column no file is opened. Files without rows count too.
    stream = (
        spark.readStream.format("binaryFile").schema(_LISTING)
        .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(landing)
        .select(F.col("_metadata.file_path").alias(SOURCE_PATH))
    )

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        dated = batch.withColumn("day", file_date(F.col(SOURCE_PATH))).collect()  # one row per new file
        days = sorted({r["day"] for r in dated if r["day"]})
        if days:
            reload_days(build_stocks(session, landing, layout, newest_files(session, landing, days)), table, days)
            if on_days is not None:
                on_days(session, days)
        undated = sorted(unquote(r[SOURCE_PATH]) for r in dated if r["day"] is None)
        if undated:
            rows = build_stocks(session, landing, layout, undated)
            rows.write.mode("overwrite").parquet(f"{table.rstrip('/')}_undated/batch_id={batch_id}")

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
