"""Documents dealt out in parts, and keys compared across parts without a row per key.

Searches for shared content need one key per word position. As rows these would outweigh
the text many times, so each part sends its distinct keys packed per bucket of the key
space, the bucket's task compares them, and a few bits per key go back. A key that fills a
third of the corpus is one entry per part, so no bucket is overfull.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrail.llm.hashing import group_starts, text_buffer

#: Text bytes per part: what one task holds at a time, together with a few arrays as long.
PART_BYTES = 8 << 20

PAYLOAD = "bucket long, part long, keys binary, flags binary, owners binary"
ANSWER = "part long, round int, bucket long, bits binary"


_PACKED = "part long, rows binary"


def dealt(docs: DataFrame, id_col: str, text_col: str, key_col: str | None = None) -> tuple[DataFrame, int]:
    """Documents packed by part (see unpacked), and the number of parts, which follows the volume of text.

    The text is shuffled once in compressed form; passes that group by part share it.
    """
    key = F.col(key_col) if key_col else F.lit(None)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), key.cast("string").alias("key"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / PART_BYTES))
    docs = docs.withColumn("part", F.pmod(F.xxhash64("doc_id", F.coalesce(F.length("text"), F.lit(-1))), F.lit(parts)))

    def pack(batches):
        for batch in batches:
            part = batch.column(3).to_numpy()
            order = np.argsort(part, kind="stable")
            cuts = [*group_starts(part[order]), len(order)]
            rows = [_packed(batch.take(pa.array(order[a:b]))) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(part[order[cuts[:-1]]], pa.int64()), pa.array(rows, pa.binary())], names=["part", "rows"])

    return docs.mapInArrow(pack, _PACKED), parts


def _packed(batch: pa.RecordBatch) -> bytes:
    """Compressed: number of rows; id and whether it is known; lengths (-1: null) and bytes of texts and of keys."""
    ids = batch.column(0)
    out = [struct.pack("<I", len(ids)), ids.fill_null(0).to_numpy().astype("<i8").tobytes(), (~ids.is_null().to_numpy(False)).tobytes()]
    for column in batch.columns[1:3]:
        data, bounds = text_buffer(column)
        out += [np.where(column.is_null().to_numpy(False), -1, np.diff(bounds)).astype("<i8").tobytes(), data.tobytes()]
    return zstandard.compress(b"".join(out), 1)


def unpacked(table: pa.Table) -> pa.Table:
    """doc_id, text and key of a part's documents."""
    tables = []
    for packed in table["rows"].to_pylist():
        data = zstandard.decompress(packed)
        n = struct.unpack_from("<I", data)[0]
        known = np.frombuffer(data, bool, n, 4 + 8 * n)
        columns, at = [pa.array(np.frombuffer(data, "<i8", n, 4), mask=~known)], 4 + 9 * n
        for _ in range(2):
            sizes = np.frombuffer(data, "<i8", n, at)
            bounds = np.concatenate(([0], np.cumsum(np.maximum(sizes, 0))))
            at += 8 * n
            text = pa.LargeStringArray.from_buffers(n, pa.py_buffer(bounds), pa.py_buffer(data[at : at + bounds[-1]]), pa.array(sizes >= 0).buffers()[1])
            columns.append(text)
            at += int(bounds[-1])
        tables.append(pa.table(columns, ["doc_id", "text", "key"]))
    empty = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string()), ("key", pa.large_string())]).empty_table()
    return pa.concat_tables(tables).combine_chunks() if tables else empty


def payload(part: int, keys: np.ndarray, buckets: int, flags=(), owners: np.ndarray | None = None, wide: bool = False) -> pa.Table:
    """Distinct sorted keys, cut into buckets. Narrow keys travel as their low 32 bits."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = [*group_starts(bucket), len(keys)]
    kept = keys if wide else keys.astype(np.uint32)
    if owners is not None and len(owners) and 0 <= owners.min() and owners.max() < 2**32:
        owners = owners.astype(np.uint32)
    rows = [(int(bucket[a]), part, kept[a:b].tobytes(), b"".join(np.packbits(f[a:b]).tobytes() for f in flags),
             owners[a:b].tobytes() if owners is not None else None) for a, b in zip(cuts, cuts[1:])]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "part", "keys", "flags", "owners"]
    columns = list(zip(*rows)) if rows else [[]] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _entries(table: pa.Table, kind) -> tuple[list[int], np.ndarray, np.ndarray]:
    chunks = [np.frombuffer(x, kind) for x in table["keys"].to_pylist()]
    counts = [len(c) for c in chunks]
    keys = np.concatenate(chunks) if chunks else np.zeros(0, kind)
    return counts, keys, np.argsort(keys, kind="stable")


def _answers(table: pa.Table, round_no: int, counts: list[int], bits: np.ndarray) -> pa.Table:
    cuts = np.cumsum([0, *counts])
    packed = [np.packbits(bits[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    n = len(counts)
    return pa.table(
        [table["part"], pa.array([round_no] * n, pa.int32()), table["bucket"], pa.array(packed, pa.binary())],
        ["part", "round", "bucket", "bits"],
    )


def _bits(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def shared_keys(table: pa.Table, round_no: int) -> pa.Table:
    """A bit per key: it is in several documents and one of its holders may be a reference.

    flags: the key is in several documents of the part; a document of the part offers it as
    a reference.
    """
    counts, keys, order = _entries(table, np.uint32)
    several, offered = [], []
    for count, flags in zip(counts, table["flags"].to_pylist()):
        half = len(flags) // 2
        several.append(_bits(flags[:half], count))
        offered.append(_bits(flags[half:], count))
    starts = group_starts(keys[order])
    sizes = np.diff([*starts, len(keys)])
    good = np.zeros(0, bool)
    if len(keys):
        several = np.logical_or.reduceat(np.concatenate(several)[order], starts)
        offered = np.logical_or.reduceat(np.concatenate(offered)[order], starts)
        good = offered & (several | (sizes > 1))
    bits = np.zeros(len(keys), bool)
    bits[order] = np.repeat(good, sizes)
    return _answers(table, round_no, counts, bits)


def earlier_owner(table: pa.Table, round_no: int) -> pa.Table:
    """A bit per key: another part's owner is smaller than this part's."""
    counts, keys, order = _entries(table, np.uint64)
    owners = np.concatenate([
        np.frombuffer(x, np.uint32 if len(x) == 4 * c else np.int64).astype(np.int64)
        for c, x in zip(counts, table["owners"].to_pylist())
    ]) if counts else np.zeros(0, np.int64)
    starts = group_starts(keys[order])
    bits = np.zeros(len(keys), bool)
    if len(keys):
        least = np.minimum.reduceat(owners[order], starts)
        bits[order] = np.repeat(least, np.diff([*starts, len(keys)])) < owners[order]
    return _answers(table, round_no, counts, bits)


def answered(answers: pa.Table, round_no: int, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits for a part's sorted keys, put together from its buckets' answers."""
    out = np.zeros(len(keys), bool)
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    for number, at, bits in zip(*(answers[c].to_pylist() for c in ("round", "bucket", "bits"))):
        if number == round_no:
            a, b = np.searchsorted(bucket, [at, at + 1])
            out[a:b] = _bits(bits, b - a)
    return out
