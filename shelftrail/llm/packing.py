"""Packing documents into token-budget batches over optimal length buckets.

The global histogram of exact lengths is all that reaches the driver: documents of d distinct
lengths have d * (d - 1) / 2 tokens at least, so it has no more rows than the root of twice
the corpus' tokens. A dynamic program over it places the bucket boundaries so that the
padding up to the boundaries is least. Rows then get their place within the bucket from
counts per slice and ranks inside slices, so no bucket passes through one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one slice of a bucket holds about.
SLICE_ROWS = 50_000


def _last_bucket(cost: np.ndarray, ends: np.ndarray, rows: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lengths 0..j-1, the least cost with a last bucket from length i >= 1, and the smallest such i.

    The cost is Monge, so i doesn't fall as j rises: each level halves the distance between
    the j known and looks only between their i, which takes n log n steps in all.
    """
    n = len(ends)
    best, came = np.full(n + 1, np.iinfo(np.int64).max), np.zeros(n + 1, np.int64)
    step = 1 << (n.bit_length() - 1)
    while step:
        j = np.arange(step, n + 1, 2 * step)
        j = j[j >= 2]
        low = np.maximum(came[j - step], 1)
        high = np.where(j + step <= n, np.minimum(came[np.minimum(j + step, n)], j - 1), j - 1)
        sizes = high - low + 1
        starts = np.cumsum(sizes) - sizes
        which = np.repeat(np.arange(len(j)), sizes)
        i = np.arange(len(which)) - starts[which] + low[which]
        if len(j):
            at = j[which]
            total = cost[i] + ends[at - 1] * (rows[at] - rows[i]) - (tokens[at] - tokens[i])
            best[j] = np.minimum.reduceat(total, starts)
            least = np.flatnonzero(total == best[at])
            came[j] = i[least[np.searchsorted(which[least], np.arange(len(j)))]]
        step //= 2
    return best, came


def boundaries(histogram: list[tuple[int, int, int]], buckets: int) -> list[int]:
    """Bucket ends that minimise padding, from (length, rows, tokens) per distinct length, ascending.

    Of equally good choices the one with the smallest ends is taken, looking from the last.
    """
    if not histogram:
        return []
    ends = np.array([h[0] for h in histogram], np.int64)
    rows, tokens = (np.concatenate(([0], np.cumsum([h[i] for h in histogram]))) for i in (1, 2))
    n, buckets = len(ends), min(buckets, len(ends))
    # cost[j]: least padding of lengths 0..j-1 in the buckets so far
    cost = ends[np.arange(n)] * rows[1:] - tokens[1:]
    cost, back = np.concatenate(([0], cost)), []
    for _ in range(1, buckets):
        new, from_ = _last_bucket(cost, ends, rows, tokens)
        from_ = np.where(new < cost, from_, 0)
        cost = np.minimum(new, cost)
        back.append(from_)
    out, j = [int(ends[-1])], n
    for from_ in reversed(back):
        if from_[j]:
            j = int(from_[j])
            out.append(int(ends[j - 1]))
    return out[::-1]


def pack(
    docs: DataFrame, budget: int = 32768, buckets: int = 8, id_col: str = "doc_id", length: Column | None = None
) -> DataFrame:
    """One row per document: doc_id, n_tokens, bucket, boundary, batch, slot.

    `length` is a document's tokens (by default the words of column `text`; null text has
    none). bucket counts from 0 by rising boundary; a batch of a bucket holds
    max(1, budget // boundary) documents, so padded it stays within the budget (or is one
    document longer than that). batch counts from 0 within its bucket and slot within its
    batch; every batch but a bucket's last is full. Rows are in order of a slice number made
    from the id and then of id; equal rows stay apart, in any order; a null id counts as 0.
    Documents without tokens are packed like others, at no cost. Only the id and the columns
    of `length` are read, so other columns may have any names. An empty table gives an empty
    result.
    """
    words = F.size(F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    length = F.when(F.col("text").isNull(), 0).otherwise(words) if length is None else length
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"))
    histogram = sized.groupBy("n_tokens").agg(F.count("*")).orderBy("n_tokens").collect()
    n = sum(rows for _, rows in histogram)
    ends = boundaries([(length, rows, length * rows) for length, rows in histogram], buckets) or [0]

    bucket = F.lit(len(ends) - 1)
    for k in reversed(range(len(ends) - 1)):
        bucket = F.when(F.col("n_tokens") <= ends[k], k).otherwise(bucket)
    slices = max(1, -(-n // SLICE_ROWS))
    placed = sized.withColumns({
        "bucket": bucket.cast("int"),
        "slice": F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(slices)),
    }).withColumn("boundary", F.element_at(F.array(*[F.lit(e).cast("long") for e in ends]), F.col("bucket") + 1))
    counts = placed.groupBy("bucket", "slice").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("bucket").orderBy("slice")) - F.col("n")
    counts = counts.select(F.col("bucket"), F.col("slice"), before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket", "slice").orderBy(F.coalesce("doc_id", F.lit(0)))) - 1
    per = F.greatest(F.lit(1).cast("long"), F.expr(f"{int(budget)} div greatest(boundary, 1)"))
    return (
        placed.withColumn("rank", rank).join(counts, ["bucket", "slice"])
        .withColumns({"place": F.col("before") + F.col("rank"), "per": per})
        .select("doc_id", "n_tokens", "bucket", "boundary", F.expr("place div per").alias("batch"), (F.col("place") % F.col("per")).alias("slot"))
    )
