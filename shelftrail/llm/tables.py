"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrail import session


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a compressed table in the shared folder; later steps don't depend on its tasks.

    It stays until session.clear_scratch.
    """
    return _write(df, session.scratch_path(df.sparkSession, name))


class Scratch:
    """Tables in the shared folder that are deleted on leaving the `with` block.

    An operator writes its result with `written` before it leaves.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, session.scratch_path(spark, "steps")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        session.delete_path(self.spark, self.folder)

    def written(self, df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
        """`df` as a table; the table `instead_of`, which is no longer needed, goes."""
        out = _write(df, f"{self.folder}/{name}-{uuid.uuid4().hex}")
        for file in (instead_of.inputFiles()[:1] if instead_of is not None else ()):
            session.delete_path(self.spark, file.rpartition("/")[0])
        return out


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a column, of an unused name, that tells every stored row from all others.

    Rows may repeat as a whole and ids may be missing, so a row is known by its file and its
    place there. A DataFrame that isn't read from files is written first.
    """
    name = f"row_{uuid.uuid4().hex}"
    place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias(name)
    if "_metadata" not in docs.columns:
        try:
            return docs.select("*", place), name
        except AnalysisException:
            pass
    return written(docs, "rows").select("*", place), name


def only(docs: DataFrame, key: str, keep: DataFrame) -> DataFrame:
    """The rows of `docs` (from `keyed`) whose key is in column `key` of `keep`, without that column.

    The kept rows travel as a bitmap per 32768 rows of a file, 4 kB each, so the join is small
    enough for Spark to broadcast at most sizes; beyond, Spark shuffles the documents.
    """
    def place(name: str) -> tuple[Column, Column]:
        row = F.substring_index(name, ":", -1)
        return F.expr(f"left({name}, length({name}) - length(substring_index({name}, ':', -1)) - 1)"), row.cast("long") + 1

    file, row = place(key)
    names = [f"{key}_{x}" for x in ("file", "bucket", "bits")]
    bits = keep.groupBy(file.alias(names[0]), F.bitmap_bucket_number(row).alias(names[1])).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(row)).alias(names[2])
    )
    bits = written(bits, "kept-rows")
    here = docs.withColumns({names[0]: file, names[1]: F.bitmap_bucket_number(row)}).join(bits, names[:2])
    at = f"bitmap_bit_position(cast(substring_index({key}, ':', -1) as long) + 1)"
    byte = f"cast(conv(hex(substring({names[2]}, cast({at} div 8 as int) + 1, 1)), 16, 10) as int)"
    return here.where(F.expr(f"(shiftright({byte}, cast({at} % 8 as int)) & 1) = 1")).select(*[c for c in docs.columns if c != key])


def components(edges: DataFrame, steps: Scratch) -> DataFrame:
    """(node, component) for all nodes of the edges (a, b): the smallest node reachable.

    Each round points every node to its smallest neighbour or itself, follows the pointers
    four steps, and contracts the graph: edges then join what their ends point to, each
    once. The graph shrinks fast, so all rounds together cost little more than the first.
    Rounds are written, so the plan stays short; only "is an edge left" comes to the driver.
    Minima per node are combined before the shuffle, and Spark splits a hub's share of a
    join. When no edge is left, all of a component point to its smallest node.
    """
    edges = steps.written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while labels is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = steps.written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("to")), "points")
        for _ in range(2):
            on = points.select(F.col("node").alias("to"), F.col("to").alias("end"))
            points = steps.written(points.join(on, "to").select("node", F.col("end").alias("to")), "points", points)
        edges = steps.written(
            edges.join(points.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(points.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges", edges,
        )
        if labels is None:
            labels = points.withColumnRenamed("to", "component")
        else:
            on = points.select(F.col("node").alias("component"), "to")
            labels = steps.written(labels.join(on, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels", labels)
    return labels
