"""Sharding by a minimax contiguous partition of groups of equal texts.

Groups, never divided, are ordered by the SHA-256 of their text, and each shard takes a run of
them. The smallest capacity that a greedy fill meets with the given number of shards is found
by binary search, and the groups are cut where that fill ends its shards.

The search needs running sizes of all groups. They stay in a table; the driver holds some of
them at a time. Some running sizes bracket the answer: using only those as cuts shows that a
capacity is enough, taking any size between two of them for a possible cut shows that one is
not. The next look reads running sizes from within the brackets only, until nothing is unknown.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelftrail.llm.order import numbered
from shelftrail.llm.tables import Scratch, written

#: Groups per cell of the order, about, and hexadecimal digits by which cells are gathered.
CELL, DIGITS = 4096, 3
#: Running sizes that the driver reads in one look, about, and gaps between known ones that a look fills.
POINTS, GAPS = 32_768, 64

_SUMS = ["bytes", "rows", "groups"]


def _before(cells: DataFrame, digits: int) -> DataFrame:
    """`cells` with the sums of all earlier cells, <name>_before. Sums run within gathered cells, then over those."""
    if digits <= DIGITS:
        inside, outer = Window.orderBy("cell"), None
    else:
        cells = cells.withColumn("outer", F.left("cell", F.lit(digits - DIGITS)))
        inside = Window.partitionBy("outer").orderBy("cell")
        outer = _before(cells.groupBy(F.col("outer").alias("cell")).agg(*[F.sum(s).alias(s) for s in _SUMS]), digits - DIGITS)
        outer = outer.select(F.col("cell").alias("outer"), *[F.col(f"{s}_before").alias(f"{s}_outer") for s in _SUMS])
    cells = cells.withColumns({f"{s}_before": F.sum(s).over(inside) - F.col(s) for s in _SUMS})
    if outer is None:
        return cells
    return cells.join(outer, "outer").withColumns({f"{s}_before": F.col(f"{s}_before") + F.col(f"{s}_outer") for s in _SUMS})


def running(groups: DataFrame, count: int) -> DataFrame:
    """key, and bytes_end, rows_end and groups_end: the sums over all groups up to and with it, in order of key.

    Keys are hexadecimal digests, so cells of equal leading digits are about equally full,
    and no task adds up more than a cell or the cells of a gathered one.
    """
    digits = max(0, math.ceil(math.log(max(count, 1) / CELL, 16)))
    groups = groups.select("key", "bytes", "rows", F.lit(1).cast("long").alias("groups"), F.left("key", F.lit(digits)).alias("cell"))
    before = _before(groups.groupBy("cell").agg(*[F.sum(s).alias(s) for s in _SUMS]), digits).select("cell", *[f"{s}_before" for s in _SUMS])
    inside = Window.partitionBy("cell").orderBy("key")
    sums = groups.withColumns({f"{s}_here": F.sum(s).over(inside) for s in _SUMS})
    return sums.join(before, "cell").select("key", *[(F.col(f"{s}_here") + F.col(f"{s}_before")).alias(f"{s}_end") for s in _SUMS])


class Fill:
    """Greedy fills of `shards` shards over the known ones of all running sizes."""

    def __init__(self, known: dict[int, int], shards: int):
        #: Numbers of known groups, and the running sizes at their ends; nothing and all are among them.
        self.numbers, self.shards = sorted(known), shards
        self.ends = [known[n] for n in self.numbers]
        self.total = self.ends[-1]

    def least(self, capacity: int) -> list[int]:
        """Ends of the shards if there were no cuts but the known ones."""
        out, at = [], 0
        for _ in range(self.shards):
            at = self.ends[bisect_right(self.ends, at + capacity) - 1]
            out.append(at)
        return out

    def most(self, capacity: int) -> list[int]:
        """Ends of the shards if there were a cut wherever one isn't known to be missing."""
        out, at = [], 0
        for _ in range(self.shards):
            reach = at + capacity
            i = bisect_right(self.ends, reach) - 1
            at = self.ends[i]
            if i + 1 < len(self.ends) and self.numbers[i + 1] > self.numbers[i] + 1:
                at = min(reach, self.ends[i + 1] - 1)
            out.append(at)
        return out

    def smallest(self, fill) -> int:
        """The smallest capacity with which `fill` places everything."""
        low, high = 0, self.total
        while low < high:
            middle = (low + high) // 2
            if fill(middle)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def gaps(self) -> tuple[int, list[tuple[int, int]]]:
        """A capacity that is enough, and the pairs of known group numbers between which unknown cuts may matter."""
        enough, needed = self.smallest(self.least), self.smallest(self.most)
        out = set()
        for low, high in zip(self.least(needed), self.most(enough)):
            first = bisect_right(self.ends, low) - 1
            last = min(bisect_left(self.ends, high), len(self.ends) - 1)
            out.update((self.numbers[i], self.numbers[i + 1]) for i in range(first, last) if self.numbers[i + 1] > self.numbers[i] + 1)
        return enough, sorted(out)


def capacity_and_cuts(sums: DataFrame, shards: int, points: int = POINTS) -> tuple[int, list[tuple[str, int]]]:
    """The smallest capacity of `shards` runs of groups, and (last key, rows up to it) of all shards but the last.

    A look reads at most about `points` running sizes, whatever the number of groups. With two
    thousand times as many groups there is one look more.
    """
    last = sums.agg(F.max("groups_end"), F.max("bytes_end")).first()
    if not last[0]:
        return 0, []
    known, found = {0: 0, last[0]: last[1]}, {}
    while True:
        fill = Fill(known, shards)
        capacity, open_ = fill.gaps()
        if not open_:
            break
        open_ = sorted(open_, key=lambda g: g[0] - g[1])[:GAPS]
        per = max(2, points // len(open_))
        wanted = F.lit(False)
        for a, b in open_:
            step = max(1, (b - a) // per)
            at = F.col("groups_end")
            wanted = wanted | ((at > a) & (at < b) & ((at - a) % step == 0))
        for r in sums.where(wanted).select("groups_end", "bytes_end").collect():
            known[r[0]] = r[1]
    ends = fill.least(capacity)[:-1]
    numbers = [fill.numbers[bisect_right(fill.ends, e) - 1] for e in ends]
    for r in sums.where(F.col("groups_end").isin(sorted(set(numbers)))).select("groups_end", "key", "rows_end").collect():
        found[r[0]] = (r[1], r[2])
    return capacity, [found[n] for n in numbers if n in found]


def _shard(cuts: list[str], low: int, high: int) -> Column:
    """The number of `cuts`, between low and high, that lie before the key, by halves."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(F.col("key") <= cuts[middle], _shard(cuts, low, middle)).otherwise(_shard(cuts, middle + 1, high))


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", points: int = POINTS) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, shard and slot.

    size is the text's bytes in UTF-8 plus 1. Rows of equal texts share a shard; null and
    empty texts are equal (size 1, text_crc32 0). The largest shard is as small as any runs
    of the groups allow; where groups are few or one is very large, the last shards may be
    small or empty. Slots count from 0 in each shard, in order of the text's digest and then of
    doc_id, nulls first; rows repeated as a whole keep one slot each, in any order. Long
    texts count by their size, other columns are ignored, whatever their names, and an
    empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1).cast("long")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text.cast("binary"), 256).alias("key"),
    )
    with Scratch(docs.sparkSession) as steps:
        rows = steps.written(rows, "shard-rows")
        groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        groups = steps.written(groups, "shard-groups")
        sums = steps.written(running(groups, groups.count()), "shard-sums")
        _, cuts = capacity_and_cuts(sums, shards, points)
        placed = numbered(rows, steps, "shard", "key", "doc_id").withColumn("shard", _shard([k for k, _ in cuts], 0, len(cuts)).cast("int"))
        first = F.element_at(F.array(*[F.lit(n).cast("long") for n in (0, *(r for _, r in cuts))]), F.col("shard") + 1)
        return written(placed.select("doc_id", "size", "text_crc32", "shard", (F.col("place") - first).alias("slot")), "shards")
