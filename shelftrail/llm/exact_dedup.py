"""Exact dedup by deterministic block naming.

The normalised text is cut into fixed-size blocks. Distinct blocks are sorted within
buckets of a hash of their content; bucket and rank make an integer name, so equal names
mean equal blocks. Adjacent names are then paired and the distinct pairs named the same
way, level by level, until one integer stands for each document. Contents are compared, not
hashes: two texts share an identity only if they are equal.

Each task first replaces its own repeated blocks by a reference, so a block that fills a
third of the corpus is sent once per task and table of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelftrail.llm.tables import Scratch, keyed, only, written

#: Bytes of normalised text per block.
BLOCK = 4096
#: Blocks a task keeps to recognise its repeats before it starts afresh.
_TABLE = 4096
#: Names are bucket * _RANKS + rank.
_RANKS = 1 << 40
#: Rows that a task puts in order when it names them, about: blocks (256 MB at most), pairs of names.
_BLOCKS_SORTED, _PAIRS_SORTED = 1 << 16, 1 << 22

_CUT = "row long, key string, doc_id long, n_chars long, text_sha256 string, slots array<int>, home long, slot int, block binary"
_SCHEMA = pa.schema([
    ("row", pa.int64()), ("key", pa.string()), ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("text_sha256", pa.string()), ("slots", pa.list_(pa.int32())),
    ("home", pa.int64()), ("slot", pa.int32()), ("block", pa.binary()),
])


def _cut(size: int):
    """A row per document, its blocks as references, and a row per distinct block of a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 36
        row, home, table = first, first, {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                rows = []
                for key, doc_id, text in zip(*(c.to_pylist() for c in batch.slice(lo, 1024).columns)):
                    text = text or ""
                    plain = b"".join(text.encode().split())
                    if len(table) >= _TABLE:
                        home, table = home + 1, {}
                    slots = []
                    for at in range(0, len(plain), size):
                        block = plain[at : at + size]
                        slot = table.get(block)
                        if slot is None:
                            slot = table[block] = len(table)
                            rows.append((None, None, None, None, None, None, home, slot, block))
                        slots.append(slot)
                    rows.append((row, key, doc_id, len(text), sha256(plain).hexdigest(), slots, home, None, None))
                    row += 1
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return run


def _named(df: DataFrame, buckets: int, *keys: str) -> DataFrame:
    """Adds `name`: equal keys, and only those, get equal integers."""
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*keys))
    df = df.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    if buckets > _partitions(df):
        df = df.repartition(buckets, "bucket")
    return df.withColumn("name", F.col("bucket") * _RANKS + rank.cast("long")).drop("bucket")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _buckets(df: DataFrame, rows: int) -> int:
    """Buckets for the rows of a written table, so that what a task sorts doesn't grow with the table."""
    return max(_partitions(df), -(-df.count() // rows))


def identities(
    docs: DataFrame, steps: Scratch, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, key_col: str | None = None
) -> DataFrame:
    """row, key, doc_id, n_chars, text_sha256, depth and name; the last two are equal for equal texts.

    Text is compared after deleting space and 0x09-0x0D; null is empty. Empty texts have
    depth and name -1.
    """
    key = F.col(key_col) if key_col else F.lit(None)
    docs = docs.select(key.cast("string").alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = steps.written(docs.mapInArrow(_cut(block), _CUT), "exact-blocks")
    docs, blocks = cut.where("row is not null"), cut.where("row is null").select("home", "slot", "block")
    level = steps.written(
        docs.select("row", "home", F.size("slots").alias("n"), F.posexplode("slots").alias("place", "slot"))
        .join(_named(blocks, _buckets(blocks, _BLOCKS_SORTED), "block").drop("block"), ["home", "slot"])
        .select("row", "n", "place", "name"),
        "exact-level",
    )
    names, depth = None, 0
    while True:
        done = level.where("n = 1").select("row", F.lit(depth).alias("depth"), "name")
        names, open_ = done if names is None else names.unionByName(done), level.where("n > 1")
        if open_.isEmpty():
            break
        pairs = open_.groupBy("row", F.expr("place div 2").alias("place")).agg(
            F.expr("(first(n) + 1) div 2").cast("int").alias("n"),
            F.max(F.when(F.col("place") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("place") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
        )
        pairs = steps.written(pairs, "exact-pairs")
        named = _named(pairs.select("a", "b").distinct(), _buckets(pairs, _PAIRS_SORTED), "a", "b")
        level = steps.written(pairs.join(named, ["a", "b"]).select("row", "n", "place", "name"), "exact-level")
        depth += 1
    return docs.select("row", "key", "doc_id", "n_chars", "text_sha256").join(names, "row", "left").fillna(-1, ["depth", "name"])


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, key_col: str | None = None
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and key, of key_col).

    Of equal normalised texts the row with the most characters in its original text stays,
    then the smallest id. Rows repeated as a whole count as copies: one of them stays. A null
    id comes after all others. Null and empty texts are one group. Other columns are ignored,
    whatever their names; an empty table gives an empty result; texts have no length limit.
    """
    with Scratch(docs.sparkSession) as steps:
        return _grouped(identities(docs, steps, id_col, text_col, block, key_col), steps, bool(key_col))


def _grouped(named: DataFrame, steps: Scratch, with_key: bool) -> DataFrame:
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")
    # Written, so that the join shuffles both sides itself and Spark may split a large group.
    groups = steps.written(named.groupBy("depth", "name").agg(best, F.count("*").alias("group_size")), "exact-groups")
    return written(named.join(groups, ["depth", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256",
        *(["key"] if with_key else []),
    ), "exact-dedup")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that exact_dedup keeps."""
    docs, key = keyed(docs)
    keep = exact_dedup(docs, id_col, text_col, key_col=key).where("kept").select(F.col("key").alias(key))
    return only(docs, key, keep)
