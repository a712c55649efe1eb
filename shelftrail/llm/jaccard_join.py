"""N-gram Jaccard join in size-banded tiles with hashed bitmap signatures.

A document is its set of distinct word n-grams, as a sorted array of 64-bit hashes.

1. Which documents can link at all: no overlap exceeds a set's n-grams that some other
   document has too (compared across all documents, packed, see parts.py), so a document of
   which too few are shared has no links.
   Of the others, two sets of similarity t differ in at most |x| * (1 - t) / t n-grams. If
   the hash space is cut into more slices than that, some slice is the same in both. Slices
   are hashed and compared the same way; their number follows the size band, and a band
   meets itself and the next. A few slices more than needed are cut, so that a non-empty
   one is always shared, unless a set has more empty slices than that; those sets offer
   their empty slices too.
2. Documents that share slices form candidate clusters, for each band by itself with the
   documents of the next; equal sets enter once, as a class.
3. Within a cluster, tiles of the band meet one another and tiles of the next band. In a
   tile pair, bitmaps of the sets give an upper bound of the overlap (a bit set on one side
   only stands for an n-gram missing on the other); pairs that pass are counted exactly on
   the sorted arrays. Tasks return links per class and the smallest member of each local
   component, never pairs.
4. Components of those members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrail.llm import parts as P
from shelftrail.llm.hashing import Words, group_starts, mix
from shelftrail.llm.tables import Scratch, components, keyed, only, written

#: N-grams per tile of a large cluster, and of small clusters that share a task call.
TILE = 1 << 20
#: Sets whose bitmaps are compared at once.
_BLOCK = 256
#: Slices beyond those that may differ.
_SPARE = 1

#: Bits of a row's number for its place within its part, and of a node's for its band.
_ROW_BITS, _BAND_BITS = 27, 11

_SETS = "row long, key string, doc_id long, n_shingles long, name1 long, name2 long, band int, slices array<long>, lower array<long>, shingles binary"
_SETS_ARROW = pa.schema([
    ("row", pa.int64()), ("key", pa.string()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("name1", pa.int64()), ("name2", pa.int64()),
    ("band", pa.int32()), ("slices", pa.list_(pa.int64())), ("lower", pa.list_(pa.int64())), ("shingles", pa.binary()),
])
_FOUND = "node long, links long, root long"


class Bands:
    """Size bands such that linked sets lie in the same or in adjacent bands."""

    def __init__(self, least: int, of: int):
        self.least, self.of = least, of
        self.lows = [1]

    def band(self, n: int) -> int:
        while self.lows[-1] <= n:
            low = self.lows[-1]
            self.lows.append(max(low + 1, -(-low * self.of // self.least)))
        return int(np.searchsorted(self.lows, n, "right")) - 1

    def slices(self, band: int) -> int:
        """More slices than two linked sets, the smaller one of this band, can differ in."""
        self.band(self.lows[band + 1] if band + 1 < len(self.lows) else self.lows[-1])
        largest = self.lows[band + 1] - 1
        return largest * (self.of - self.least) // self.least + 1 + _SPARE


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each row; fewer words than `size` make one n-gram."""
    grams, hashes, out = words.windows(size), words.hashes, []
    for a, b in zip(words.offsets, words.offsets[1:]):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            h = np.uint64(b - a)
            for x in hashes[a:b]:
                h = mix(np.array([h], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + x)[0]
            out.append(np.array([h], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def slice_hashes(grams: np.ndarray, bands: Bands) -> list[np.ndarray]:
    """Hashes of the slices that a set offers in its own band's and in the lower band's tiles."""
    n, out = len(grams), []
    if not n:
        return [np.zeros(0, np.uint64)] * 2
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(grams), out=total[1:])
    own = bands.band(n)
    for band in (own, own - 1):
        if band < 0:
            out.append(np.zeros(0, np.uint64))
            continue
        count = bands.slices(band)
        place = ((grams >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        cuts = np.searchsorted(place, np.arange(count + 1, dtype=np.uint64))
        content = total[cuts[1:]] - total[cuts[:-1]]
        hashes = mix(content + mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 32)))
        empty = cuts[1:] == cuts[:-1]
        out.append(hashes if empty.sum() > _SPARE else hashes[~empty])
    return out


class _Keys:
    """Distinct keys of lists of keys, and the way back to the lists."""

    def __init__(self, lists: list[np.ndarray]):
        self.cuts = np.cumsum([0, *map(len, lists)])
        self.all = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
        self.order = np.argsort(self.all, kind="stable")
        ordered = self.all[self.order]
        first = group_starts(ordered)
        self.keys, self.sizes = ordered[first], np.diff([*first, len(ordered)])

    def payload(self, part: int, buckets: int) -> pa.Table:
        return P.payload(part, self.keys, buckets, (self.sizes > 1, np.ones(len(self.keys), bool)))

    def shared(self, answers: pa.Table, round_no: int, buckets: int) -> np.ndarray:
        """A flag per key of the lists: other documents have it too."""
        out = np.zeros(len(self.all), bool)
        out[self.order] = np.repeat(P.answered(answers, round_no, self.keys, buckets), self.sizes)
        return out


class _Part:
    """The sets of a part's documents, and slices of those that may link."""

    def __init__(self, table: pa.Table, size: int):
        self.sets = shingle_sets(Words(table["text"], lower=True), size)
        self.grams = _Keys(self.sets)

    def offer(self, answers: pa.Table, buckets: int, least: int, of: int) -> _Keys:
        """Two lists for each set; empty ones if too few of its n-grams are shared."""
        shared = np.concatenate(([0], np.cumsum(self.grams.shared(answers, 1, buckets))))
        shared = shared[self.grams.cuts[1:]] - shared[self.grams.cuts[:-1]]
        bands, none = Bands(least, of), np.zeros(0, np.uint64)
        self.slices = _Keys([
            x for s, k in zip(self.sets, shared) for x in (slice_hashes(s, bands) if of * k >= least * len(s) else (none, none))
        ])
        return self.slices


def _pairs(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (indexes into sets) of left with right, or within left if right is None."""
    n = np.array([len(s) for s in sets], np.int64)
    used = left if right is None else np.concatenate((left, right))
    width = int(min(1 << 14, max(64, 1 << int(4 * n[used].mean() - 1).bit_length())))
    bits = np.zeros((len(used), width), np.float32)
    for k, i in enumerate(used):
        bits[k, (sets[i] & np.uint64(width - 1)).astype(np.int64)] = 1
    ones = bits.sum(1).astype(np.int64)
    over, at = (left, 0) if right is None else (right, len(left))
    both = (bits[: len(left)] @ bits[at:].T).astype(np.int64)
    a, b = n[left][:, None], n[over][None, :]
    # A bit on one side only means at least one n-gram that the other side lacks.
    bound = np.minimum(a - (ones[: len(left)][:, None] - both), b - (ones[at:][None, :] - both))
    may = of * bound >= least * (a + b - bound)
    if right is None:
        may &= np.arange(len(left))[:, None] < np.arange(len(left))[None, :]
    vocabulary, flat = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
    cuts = np.cumsum([0, *n[used]])
    ids = {int(i): flat[cuts[k] : cuts[k + 1]] for k, i in enumerate(used)}
    mark, found_a, found_b = np.zeros(len(vocabulary), np.int64), [], []
    for k in np.flatnonzero(may.any(1)):
        i, others = int(left[k]), over[np.flatnonzero(may[k])]
        mark[ids[i]] = 1
        common = np.add.reduceat(mark[np.concatenate([ids[int(j)] for j in others])], np.cumsum([0, *n[others][:-1]]))
        mark[ids[i]] = 0
        good = others[of * common >= least * (n[i] + n[others] - common)]
        found_a.append(np.full(len(good), i))
        found_b.append(good)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_a, found_b))


def _link(nodes: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], side: np.ndarray, least: int, of: int) -> list[tuple[int, int, int]]:
    """(node, links, smallest node of its component here) for all nodes with a link.

    Sides 0 meet one another, and sides 0 and 1 meet sides 2.
    """
    lengths = np.array([len(s) for s in sets])
    by_size = np.argsort(lengths, kind="stable")
    blocks = [[by_size[x[by_size]][i : i + _BLOCK] for i in range(0, x.sum(), _BLOCK)] for x in (side == 0, side < 2, side == 2)]
    found = []
    for k, block in enumerate(blocks[0]):
        found.append(_pairs(sets, block, None, least, of))
        for other in blocks[0][k + 1 :]:
            if lengths[other[0]] * least <= lengths[block[-1]] * of:
                found.append(_pairs(sets, block, other, least, of))
    for block in blocks[1]:
        for other in blocks[2]:
            if lengths[other[0]] * least <= lengths[block[-1]] * of and lengths[block[0]] * least <= lengths[other[-1]] * of:
                found.append(_pairs(sets, block, other, least, of))
    a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2
    links = np.bincount(a, copies[b], len(nodes)) + np.bincount(b, copies[a], len(nodes))
    root = nodes.copy()
    while True:  # smallest label over all links until nothing changes
        old = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (old == root).all():
            break
    return [(int(nodes[i]), int(links[i]), int(root[i])) for i in np.flatnonzero(links)]


def _tile(least: int, of: int):
    def run(table):
        table = table.sort_by([("cluster", "ascending"), ("node", "ascending")])
        cluster, nodes, copies, side = (table[c].to_numpy() for c in ("cluster", "node", "copies", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        cuts, rows = [*group_starts(cluster), len(cluster)], []
        for x, y in zip(cuts, cuts[1:]):
            if y - x > 1:
                rows += _link(nodes[x:y], copies[x:y], sets[x:y], side[x:y], least, of)
        columns = list(zip(*rows)) if rows else [[]] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

    return run


def jaccard_join(
    docs: DataFrame, size: int = 3, least: int = 90, of: int = 100, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, n_links, kept (and key, of key_col).

    Rows link when of * intersection >= least * union of their n-gram sets (A-Z lowered,
    words divided by space and 0x09-0x0D). component_id is the smallest id reachable by
    links; n_links counts the rows linked to; kept marks one row of each component, that of
    the smallest id. Null, empty and blank texts have no n-grams and no links. Rows with
    equal or null ids are nodes of their own; a null id gives way to any other, and a
    component of null ids has a null component_id. Other columns are ignored, whatever their
    names; an empty table gives an empty result; texts are read whole.
    """
    with Scratch(docs.sparkSession) as steps:
        return _joined(docs, steps, size, least, of, id_col, text_col, key_col)


def _joined(docs: DataFrame, steps: Scratch, size: int, least: int, of: int, id_col: str, text_col: str, key_col: str | None) -> DataFrame:
    dealt, buckets = P.dealt(docs, id_col, text_col, key_col)
    by_part = dealt.groupBy("part")

    def grams(key, table):
        return _Part(P.unpacked(table), size).grams.payload(key[0].as_py(), buckets)

    def offer(key, table, answers):
        return _Part(P.unpacked(table), size).offer(answers, buckets, least, of).payload(key[0].as_py(), buckets)

    def sets(key, table, answers):
        table = P.unpacked(table)
        part = _Part(table, size)
        slices = part.offer(answers, buckets, least, of)
        shared = slices.shared(answers, 2, buckets)
        bands, rows, seen, first = Bands(least, of), [], set(), key[0].as_py() << _ROW_BITS
        order = np.argsort(table["doc_id"].fill_null(2**63 - 1).to_numpy(), kind="stable")
        ids, keys = table["doc_id"].to_pylist(), table["key"].to_pylist()
        for row, i in enumerate(order):
            grams = part.sets[i]
            scrambled = mix(grams)
            name = (int(np.sum(scrambled).view(np.int64)), int(np.bitwise_xor.reduce(mix(scrambled + np.uint64(7))).view(np.int64))) if len(grams) else (0, 0)
            a, b, c = slices.cuts[2 * i : 2 * i + 3]
            own, lower = (np.unique(slices.all[x:y][shared[x:y]]).view(np.int64) for x, y in ((a, b), (b, c)))
            whole = len(own) + len(lower) > 0 and (len(grams), name) not in seen
            seen.add((len(grams), name))
            band = bands.band(len(grams)) if len(grams) else None
            rows.append((first + row, keys[i], ids[i], len(grams), *name, band, *((own, lower, grams.tobytes()) if whole else (None,) * 3)))
        columns = list(zip(*rows)) if rows else [[]] * len(_SETS_ARROW)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _SETS_ARROW)], schema=_SETS_ARROW)

    def shared(offered: DataFrame, round_no: int) -> DataFrame:
        return offered.groupBy("bucket").applyInArrow(lambda t: P.shared_keys(t, round_no), P.ANSWER)

    first = shared(by_part.applyInArrow(grams, P.PAYLOAD), 1)
    second = shared(by_part.cogroup(first.groupBy("part")).applyInArrow(offer, P.PAYLOAD), 2)
    table = steps.written(by_part.cogroup(first.unionByName(second).groupBy("part")).applyInArrow(sets, _SETS), "jaccard-sets")

    name = ["n_shingles", "name1", "name2"]
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    best = F.min_by(F.struct("row", "band"), order).alias("head")
    classes = table.where("n_shingles > 0").groupBy(*name).agg(best, F.count("*").alias("copies"))
    classes = steps.written(classes.select(*name, "head.band", F.col("head.row").alias("node"), "copies"), "jaccard-classes")

    # A place is a class in the tiles of its own or of the lower band.
    def place(band: Column) -> Column:
        return F.shiftleft("row", _BAND_BITS) + band

    heads = classes.select(F.col("node").alias("row"))
    offers = F.concat(
        F.transform("slices", lambda x: F.struct(place(F.col("band")).alias("place"), x.alias("slice"))),
        F.transform("lower", lambda x: F.struct(place(F.col("band") - 1).alias("place"), x.alias("slice"))),
    )
    slices = table.where("slices is not null").select("row", offers.alias("offers")).join(heads, "row").select(F.inline("offers"))
    slices = steps.written(slices, "jaccard-slices")
    first = slices.groupBy("slice").agg(F.min("place").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = slices.join(first, "slice").select(F.col("place").alias("a"), "b").where("a <> b").distinct()
    clusters = components(edges, steps).select(
        F.shiftright("node", _BAND_BITS).alias("node"), F.col("component").alias("cluster"), (F.col("node") % (1 << _BAND_BITS)).alias("tiles_of")
    )

    # One task call for small clusters together; a large one is cut into tiles that meet pairwise.
    members = classes.select("node", "copies", "band", F.col("n_shingles").alias("n")).join(clusters, "node").withColumn("upper", F.col("band") > F.col("tiles_of"))
    members = steps.written(members.select("node", "copies", "cluster", "upper", "n"), "jaccard-members")
    sizes = members.groupBy("cluster").agg(
        F.sum("n").alias("all"),
        F.ceil(F.sum(F.when(F.col("upper"), 0).otherwise(F.col("n"))) / TILE).cast("int").alias("low"),
        F.ceil(F.sum(F.when(F.col("upper"), F.col("n")).otherwise(0)) / TILE).cast("int").alias("up"),
    )
    batches = -(-(members.agg(F.sum("n")).first()[0] or 1) // TILE)
    placed = members.join(sizes.where("low > 0"), "cluster").withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.greatest(F.lit(1), F.when(F.col("upper"), F.col("up")).otherwise(F.col("low")))).cast("int")
    )
    meets = F.expr("""
        if(upper,
           transform(sequence(0, low - 1), x -> struct(x as t1, 1 as kind, tile as t2, 2 as side)),
           concat(
               array(struct(tile as t1, 0 as kind, tile as t2, 0 as side)),
               transform(filter(sequence(0, low - 1), x -> x > tile), x -> struct(tile as t1, 0 as kind, x as t2, 1 as side)),
               transform(filter(sequence(0, low - 1), x -> x < tile), x -> struct(x as t1, 0 as kind, tile as t2, 2 as side)),
               transform(filter(sequence(0, up), x -> x < up), x -> struct(tile as t1, 1 as kind, x as t2, 1 as side))))
    """)
    small = placed.where(F.col("all") <= TILE).select(
        "cluster", "node", "copies", F.when(F.col("upper"), 2).otherwise(0).alias("side"),
        F.pmod(F.xxhash64("cluster"), F.lit(batches)).alias("work"),
    )
    large = placed.where(F.col("all") > TILE).withColumn("meet", F.explode(meets)).select(
        "cluster", "node", "copies", F.col("meet.side").alias("side"), F.xxhash64("cluster", "meet.kind", "meet.t1", "meet.t2").alias("work"),
    )
    contents = table.where("shingles is not null").select(F.col("row").alias("node"), "shingles")
    found = steps.written(
        small.unionByName(large).join(contents, "node").groupBy("work").applyInArrow(_tile(least, of), _FOUND), "jaccard-links"
    )

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"), steps)
    classes = (
        classes.join(links, "node", "left").join(roots, "node", "left")
        .select(*name, "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    )
    rows = table.select("row", "key", "doc_id", *name).join(classes, name, "left").withColumn("component", F.coalesce("component", "row"))
    # Written, so that the join shuffles both sides itself and Spark may split a large component.
    best = steps.written(rows.groupBy("component").agg(F.min(order).alias("best")), "jaccard-best")
    return written(rows.join(best, "component").select(
        "doc_id", "n_shingles", F.col("best.doc_id").alias("component_id"),
        F.when(F.col("copies").isNull(), 0).otherwise(F.col("links") + F.col("copies") - 1).cast("long").alias("n_links"),
        (F.col("row") == F.col("best.row")).alias("kept"), *(["key"] if key_col else []),
    ), "jaccard-join")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """The rows of `docs`, all columns, that are the first of their component."""
    docs, key = keyed(docs)
    keep = jaccard_join(docs, id_col=id_col, text_col=text_col, key_col=key, **limits).where("kept").select(F.col("key").alias(key))
    return only(docs, key, keep)
