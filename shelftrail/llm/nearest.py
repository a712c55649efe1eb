"""Approximate nearest neighbours: a neighbour graph by NN-descent, greedy search on it, and the cells of its nodes.

Equal vectors are one node. The graph is one of pivots: all nodes of a small table, of a
larger one a sample that grows with the root of its nodes. It starts from exact neighbours
within cells of random projections. Then rounds of NN-descent follow: a node's neighbours,
and the nodes that have it as a neighbour, are likely near one another, so each node
introduces them, and every node keeps its nearest. A round joins edges with the vectors they
need, one copy per block of nodes, and merges the introductions with the graph, until a
round leaves few neighbours new.

Every node belongs to the cell of its nearest pivot. Queries walk the graph from their own
cell, always opening the nearest pivots not yet opened, and are compared with all nodes of
the cells in sight when the walk ends.

Every round is a written table. Reverse edges and introductions are sampled, as NN-descent
does. What that costs in recall is measured on each table: the neighbours of a bounded sample
of the queries are also found by a scan of all nodes, and queries keep more pivots in sight
until enough of those lie in their cells; with all pivots in sight, all nodes are compared.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelftrail.llm.hashing import group_starts, mix
from shelftrail.llm.tables import Scratch, written

#: Neighbours per node, and of those how many a node introduces in a round, new and old each.
NEIGHBOURS, SAMPLE = 24, 12
#: Rounds end when at most this share of all neighbours is new.
SETTLED = 0.02
#: Sets of cells to start from, and the rows of a cell, about.
CELL_SETS, CELL = 3, 400
#: Nodes per block of a round. Blocks are small against the nodes that one is linked to, so
#: that a node is sent to about as many blocks at any table size (at most one per link) and
#: the rows of a round grow as the nodes do.
BLOCK = 250
#: Pivots per root of the number of nodes, and the least of them; smaller tables have all nodes as pivots.
PIVOTS, LEAST_PIVOTS = 2, 4096
#: Pivots a query keeps in sight, and pivots it opens at once; both are doubled until recall is reached.
BEAM, OPENED = 400, 80
#: Least recall, and the queries it is measured on (all if there are no more).
RECALL, MEASURED = 0.9, 200
#: Queries that a task walks for; bytes of vectors in a block of nodes that a task holds; lists of answers that a task merges.
SCAN_QUERIES, BLOCK_BYTES, MERGED = 2000, 1 << 25, 50000
#: Vectors that are compared at once with all pivots, or with 16 times as many nodes.
TILE = 256
#: Rows whose projections' medians cut the cells.
CUT_SAMPLE = 4000

_LISTS = "block long, node long, owners binary, vector binary, ids binary, dists binary, fresh binary, worst double"
_LISTS_ARROW = pa.schema([
    ("block", pa.int64()), ("node", pa.int64()), ("owners", pa.binary()), ("vector", pa.binary()), ("ids", pa.binary()), ("dists", pa.binary()),
    ("fresh", pa.binary()), ("worst", pa.float64()),
])


def _usable_rows(rows: DataFrame, id_col: str, vector_col: str, dtype: str) -> DataFrame:
    """id, size, key (SHA-256 of the vector) and vector (bytes of its numbers) of the rows that take part.

    Those are vectors that are not null, not zero, and finite in all components. Adding zero
    makes equal numbers (0.0 and -0.0) one.
    """
    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # Missing numbers become NaN.
            x = lists.flatten().to_numpy(zero_copy_only=False).astype(dtype) + np.dtype(dtype).type(0)
            ends = np.cumsum(sizes)
            bad, some = (np.concatenate(([0], np.cumsum(flags))) for flags in (~np.isfinite(x), x != 0))
            good = (bad[ends] == bad[ends - sizes]) & (some[ends] > some[ends - sizes])
            offsets = np.concatenate(([0], ends)).astype(np.int32) * x.itemsize
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(x.tobytes())]).filter(pa.array(good))
            keys = pa.array([sha256(v).digest() for v in packed.to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), pa.array(sizes[good].astype(np.int32)), keys, packed], names=["id", "size", "key", "vector"])

    numbers = F.transform(F.col(vector_col), lambda x: x.cast("float" if dtype == "<f4" else "double"))
    numbers = F.col(vector_col) if isinstance(rows.schema[vector_col].dataType.elementType, (T.FloatType, T.DoubleType)) else numbers
    taken = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), numbers.alias("vector"))
    return taken.mapInArrow(run, "id long, size int, key binary, vector binary")


def nodes(rows: DataFrame, asked: DataFrame, steps: Scratch, most: int) -> tuple[DataFrame, DataFrame, int]:
    """What the keys of rows and of queries tell, without their vectors.

    The keys that several rows have or a query asks for (key, rows, asked); the shared ones
    (key, tag, node: the smallest id, ids: the `most` smallest); the number of distinct vectors.
    """
    keys = rows.select("key", F.lit(1).alias("rows"), F.lit(0).alias("asked")).unionByName(asked.select("key", F.lit(0).alias("rows"), F.lit(1).alias("asked")))
    few = keys.groupBy("key").agg(F.sum("rows").alias("rows"), F.sum("asked").alias("asked")).where("rows > 1 or asked > 0")
    few = steps.written(few, "ann-keys")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    shared = rows.select("key", "id").join(few.where("rows > 1").select("key"), "key").withColumn("rank", rank).where(F.col("rank") <= most)
    copies = shared.groupBy("key").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids")).withColumn("tag", F.xxhash64("key"))
    more = few.where("rows > 1").agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0))).first()[0]
    return few, steps.written(copies, "ann-copies"), rows.count() - more


def _distinct(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """node, tag (which tells nodes of one repeated id apart) and vector of each distinct vector."""
    single = rows.select(F.col("id").alias("node"), F.xxhash64("key").alias("tag"), "key", "vector")
    if copies.isEmpty():
        return single.drop("key")
    several = rows.join(copies.select("key", "node", "tag"), "key").groupBy("node", "tag").agg(F.first("vector").alias("vector"))
    return single.join(copies.select("key"), "key", "left_anti").drop("key").unionByName(several)


def _narrowed(dtype: str):
    """(node, vector) with vectors of 32-bit floats."""
    def run(batches):
        for batch in batches:
            x = [np.frombuffer(v, dtype).astype(np.float32).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["node", "vector"])

    return run


def _floats(column) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float32) for x in column.to_pylist()])


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all of a to all of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0)


def _nearest(owner: np.ndarray, other: np.ndarray, dist: np.ndarray, fresh: np.ndarray, keep: int):
    """The `keep` nearest distinct others of each owner, known ones before fresh ones, nearest first."""
    order = np.lexsort((fresh, other, owner))
    owner, other, dist, fresh = owner[order], other[order], dist[order], fresh[order]
    first = np.ones(len(owner), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, dist, fresh = owner[first], other[first], dist[first], fresh[first]
    order = np.lexsort((other, dist, owner))
    owner, other, dist, fresh = owner[order], other[order], dist[order], fresh[order]
    starts = group_starts(owner)
    rank = np.arange(len(owner)) - np.repeat(starts, np.diff([*starts, len(owner)]))
    kept = rank < keep
    return owner[kept], other[kept], dist[kept], fresh[kept]


def _lists(owner, other, dist, fresh, keep: int = 0, vectors: dict[int, bytes] | None = None) -> pa.Table:
    """Rows of _LISTS from parallel arrays in order of owner; with vectors, one for each of those."""
    starts = group_starts(owner)
    found = {int(owner[a]): (other[a:b], dist[a:b], fresh[a:b]) for a, b in zip(starts, [*starts[1:], len(owner)])}
    none = np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, bool)
    rows = []
    for node in found if vectors is None else vectors:
        ids, dists, new = found.get(node, none)
        worst = float(dists[-1]) if keep and len(dists) >= keep else float("inf")
        rows.append((None, node, None, vectors[node] if vectors else None, ids.astype(np.int64).tobytes(), dists.astype(np.float32).tobytes(), new.tobytes(), worst))
    columns = list(zip(*rows)) if rows else [[]] * len(_LISTS_ARROW)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _LISTS_ARROW)], schema=_LISTS_ARROW)


def _packed(block, owner, other, dist) -> pa.Table:
    """Rows of _LISTS, one per block, from parallel arrays: introductions of many nodes, all fresh."""
    order = np.argsort(block, kind="stable")
    block, owner, other, dist = block[order], owner[order].astype(np.int64), other[order].astype(np.int64), dist[order].astype(np.float32)
    starts = group_starts(block)
    rows = [
        (int(block[a]), None, owner[a:b].tobytes(), None, other[a:b].tobytes(), dist[a:b].tobytes(), np.ones(b - a, bool).tobytes(), None)
        for a, b in zip(starts, [*starts[1:], len(block)])
    ]
    columns = list(zip(*rows)) if rows else [[]] * len(_LISTS_ARROW)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _LISTS_ARROW)], schema=_LISTS_ARROW)


def _flat(table: pa.Table):
    """Parallel arrays of all lists of a table."""
    ids = [np.frombuffer(x, np.int64) for x in table["ids"].to_pylist()]
    if not ids:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, bool)
    owner = np.concatenate([
        np.frombuffer(many, np.int64) if many is not None else np.full(len(x), node)
        for node, many, x in zip(table["node"].to_pylist(), table["owners"].to_pylist(), ids)
    ])
    dists = np.concatenate([np.frombuffer(x, np.float32) for x in table["dists"].to_pylist()])
    return owner, np.concatenate(ids), dists, np.concatenate([np.frombuffer(x, bool) for x in table["fresh"].to_pylist()])


def _sampled(owner: np.ndarray, other: np.ndarray, fresh: np.ndarray, sample: int, turn: int) -> np.ndarray:
    """Flags of the neighbours each node introduces in this round: `sample` fresh and as many others, by hash."""
    draw = mix(mix(owner.astype(np.uint64)) + mix(other.astype(np.uint64) + np.uint64(turn + 1)))
    order = np.lexsort((draw, fresh, owner))
    starts = group_starts(owner[order] * 2 + fresh[order])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)]))
    used = np.zeros(len(order), bool)
    used[order] = rank < sample
    return used


def _edges(sample: int, turn: int):
    """Edges (host, member, fresh) to the neighbours a node introduces."""
    def run(batches):
        for batch in batches:
            owner, other, _, fresh = _flat(pa.Table.from_batches([batch]))
            used = _sampled(owner, other, fresh, sample, turn)
            yield pa.RecordBatch.from_arrays([pa.array(x[used]) for x in (owner, other, fresh)], names=["host", "member", "fresh"])

    return run


def _merge(keep: int, sample: int, turn: int):
    """Nodes of a block with their nearest of old and introduced neighbours; introduced ones aren't fresh any more."""
    def run(table):
        own, found = table.filter(table["vector"].is_valid()), _flat(table.filter(table["vector"].is_null()))
        owner, other, dist, fresh = _flat(own)
        fresh = fresh & ~_sampled(owner, other, fresh, sample, turn)
        joined = [np.concatenate(x) for x in zip((owner, other, dist, fresh), found)]
        return _lists(*_nearest(*joined, keep), keep, dict(zip(own["node"].to_pylist(), own["vector"].to_pylist())))

    return run


def _in_block(df: DataFrame, blocks: int, node: str = "node") -> DataFrame:
    return df.withColumn("block", F.pmod(F.xxhash64(node), F.lit(blocks)))


def _start(packed: DataFrame, count: int, keep: int) -> DataFrame:
    """Exact neighbours within cells of random projections, as introductions."""
    depth = max(0, int(np.ceil(np.log2(max(count, 1) / CELL))))
    sample = packed.where(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < F.lit(int(min(1.0, CUT_SAMPLE / max(count, 1)) * (1 << 20)))).select("vector").collect()
    if not sample:
        sample = packed.select("vector").limit(1).collect()
    sample = np.stack([np.frombuffer(r.vector, np.float32) for r in sample])
    random = np.random.default_rng(3).normal(size=(sample.shape[1], CELL_SETS * depth)).astype(np.float32)
    cuts = np.median(sample @ random, 0) if depth else np.zeros(0, np.float32)

    def cells(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = (_floats(batch.column(1)) @ random) > cuts
            for s in range(CELL_SETS if depth else 1):
                cell = sides[:, s * depth : (s + 1) * depth] @ (1 << np.arange(depth)) if depth else np.zeros(batch.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell * CELL_SETS + s, pa.int64()), batch.column(0), batch.column(1)], names=["cell", "node", "vector"]
                )

    def near(table):
        ids, x = table["node"].to_numpy(), _floats(table["vector"])
        d = _squares(x, x)
        np.fill_diagonal(d, np.inf)
        k = min(keep, len(ids) - 1)
        at = np.argpartition(d, max(k - 1, 0), 1)[:, :k]
        owner = np.repeat(ids, k)
        return _lists(*_nearest(owner, ids[at].ravel(), np.take_along_axis(d, at, 1).ravel(), np.ones(len(owner), bool), keep))

    placed = packed.select("node", "vector").mapInArrow(cells, "cell long, node long, vector binary")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / (2 * CELL)).alias("pieces"))
    work = F.xxhash64("cell", F.pmod(F.xxhash64("node"), F.col("pieces")))
    return placed.join(sizes, "cell").select(work.alias("work"), "node", "vector").groupBy("work").applyInArrow(near, _LISTS)


def _introduce(keep: int):
    """Distances among the members that each node of the block brings together.

    The best few of each member, in a row for each block that they go to.
    """
    def run(edges, needed):
        if not edges.num_rows:
            return _LISTS_ARROW.empty_table()
        order = np.argsort(needed["node"].to_numpy())
        ids, x, worst = needed["node"].to_numpy()[order], _floats(needed["vector"])[order], needed["worst"].to_numpy()[order]
        squares, target = (x * x).sum(1), needed["target"].to_numpy()[order]
        host, member, fresh = (edges[c].to_numpy() for c in ("host", "member", "fresh"))
        order = np.lexsort((member, ~fresh, host))
        host, place, fresh = host[order], np.searchsorted(ids, member[order]), fresh[order]
        starts, out = group_starts(host), []
        for a, b in zip(starts, [*starts[1:], len(host)]):
            mine = place[a:b]
            new = mine[: int(fresh[a:b].sum())]
            d = np.maximum(squares[new][:, None] + squares[mine] - 2 * (x[new] @ x[mine].T), 0)
            once = np.arange(len(new))[:, None] < np.arange(len(mine))
            i, j = np.nonzero(once & (d < np.maximum(worst[new][:, None], worst[mine])))
            out.append((new[i], mine[j], d[i, j]))
        left, right, dist = (np.concatenate(c) for c in zip(*out))
        owner, other, dist = np.concatenate((left, right)), np.concatenate((right, left)), np.concatenate((dist, dist))
        better = dist < worst[owner]
        owner, other, dist, _ = _nearest(owner[better], ids[other[better]], dist[better], np.ones(better.sum(), bool), keep)
        return _packed(target[owner], ids[owner], other, dist)

    return run


def build(base: DataFrame, steps: Scratch, neighbours: int = NEIGHBOURS, sample: int = SAMPLE, settled: float = SETTLED) -> DataFrame:
    """The graph over (node, vector): node, vector (32-bit floats) and packed ids, dists of its neighbours, nearest first.

    Rounds go on until at most the share `settled` of all neighbours is new or wasn't introduced
    yet. They end, as a neighbour only ever gives way to a nearer one.
    """
    def pack(batches):
        for batch in batches:
            x = [v if isinstance(v, bytes) else np.array(v, np.float32).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], names=["node", "vector"])

    packed = steps.written(base.select("node", "vector").mapInArrow(pack, "node long, vector binary"), "ann-vectors")
    count = packed.count()
    blocks = max(1, -(-count // BLOCK))
    empty = F.lit(bytearray())
    graph = steps.written(packed, "ann-graph").select("node", F.lit(None).cast("binary").alias("owners"), "vector", empty.alias("ids"), empty.alias("dists"), empty.alias("fresh"), F.lit(float("inf")).alias("worst"))
    if not count:
        return graph

    def merged(found: DataFrame, turn: int) -> DataFrame:
        lists = _in_block(graph, blocks).unionByName(found)
        new = lists.groupBy("block").applyInArrow(_merge(neighbours, sample, turn), _LISTS).drop("block")
        return steps.written(new, "ann-graph", graph)

    graph = merged(_in_block(_start(packed, count, neighbours), blocks), 0)
    turn, edges = 0, None
    new = F.length(F.hex("fresh")) - F.length(F.replace(F.hex("fresh"), F.lit("1"), F.lit("")))
    while not graph.agg(F.sum(new) <= settled * F.sum(F.length("fresh"))).first()[0]:
        ahead = graph.mapInArrow(_edges(sample, turn), "host long, member long, fresh boolean")
        back = ahead.select(F.col("member").alias("host"), F.col("host").alias("member"), "fresh")
        rank = F.row_number().over(Window.partitionBy("host", "fresh").orderBy(F.xxhash64("host", "member", F.lit(turn)), "member"))
        both = ahead.unionByName(back.withColumn("rank", rank).where(F.col("rank") <= sample).drop("rank"))
        # Mutual neighbours come twice, perhaps only once as fresh.
        both = _in_block(both.groupBy("host", "member").agg(F.max("fresh").alias("fresh")), blocks, "host")
        edges = both = steps.written(both, "ann-edges", edges)
        vectors = _in_block(graph, blocks).select("node", "vector", "worst", F.col("block").alias("target"))
        needed = both.select(F.col("block").alias("home"), F.col("member").alias("node")).distinct().join(vectors, "node")
        graph = merged(both.groupBy("block").cogroup(needed.groupBy("home")).applyInArrow(_introduce(neighbours), _LISTS), turn)
        turn += 1
    return graph


def linked(graph: DataFrame, steps: Scratch, back: int = 2 * NEIGHBOURS) -> DataFrame:
    """node, vector and links: its neighbours, and the `back` nearest of those that have it as a neighbour."""
    def flat(batches):
        for batch in batches:
            owner, other, dist, _ = _flat(pa.Table.from_batches([batch]))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (owner, other, dist)], names=["node", "link", "dist"])

    ahead = graph.mapInArrow(flat, "node long, link long, dist float")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("dist", "link"))
    behind = ahead.select(F.col("link").alias("node"), F.col("node").alias("link"), "dist").withColumn("rank", rank).where(F.col("rank") <= back)
    links = ahead.select("node", "link").unionByName(behind.select("node", "link")).groupBy("node").agg(F.collect_set("link").alias("links"))
    return steps.written(graph.select("node", "vector").join(links, "node", "left"), "ann-links")


def _first(owner: np.ndarray, dist: np.ndarray, name: np.ndarray, keep: int) -> np.ndarray:
    """Places of the `keep` nearest of each owner, nearest first; of equally near ones the smaller names."""
    order = np.lexsort((name, dist, owner))
    return order[_ranks(owner[order]) < keep]


def _ranks(owner: np.ndarray) -> np.ndarray:
    """Places within runs of equal owners."""
    starts = group_starts(owner)
    return np.arange(len(owner)) - np.repeat(starts, np.diff([*starts, len(owner)]))


def _first_of_many(owner: np.ndarray, dist: np.ndarray, name: np.ndarray, keep: int) -> np.ndarray:
    """As _first, for 32-bit distances of at least 0: names are looked at only where the last place is tied."""
    key = owner.astype(np.uint64) << np.uint64(32) | dist.view(np.uint32)
    order = np.argsort(key)
    rank, key = _ranks(owner[order]), key[order]
    last = np.flatnonzero(rank == keep)
    tied = owner[order[last[key[last] == key[last - 1]]]]
    kept = order[rank < keep]
    if not len(tied):
        return kept
    some = np.flatnonzero(np.isin(owner, tied))
    kept = np.concatenate((kept[~np.isin(owner[kept], tied)], some[_first(owner[some], dist[some], name[some], keep)]))
    return kept[np.lexsort((dist[kept], owner[kept]))]


class Pivots:
    """The graph of the pivots, held whole: vectors (32-bit floats), and the pivots that each is linked to."""

    def __init__(self, graph: pa.Table):
        graph = graph.sort_by("node")
        names, x = graph["node"].to_numpy(), _floats(graph["vector"])
        self.centre = x.mean(0)
        self.x = x - self.centre
        self.half = (self.x * self.x).sum(1) / 2
        self.routes = np.concatenate((self.x, -self.half[:, None]), 1)
        links = [np.array(found or [], np.int64) for found in graph["links"].to_pylist()]
        # Short lists are filled up with the pivot itself.
        self.links = np.repeat(np.arange(len(x), dtype=np.int32)[:, None], max(1, *map(len, links)), 1)
        for at, found in enumerate(links):
            self.links[at, : len(found)] = np.searchsorted(names, found)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.centre).astype(np.float32)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The nearest pivot of each (centred) vector."""
        x, near = np.concatenate((x, np.ones((len(x), 1), np.float32)), 1), np.zeros(len(x), np.int32)
        room = np.empty((TILE, len(self.x)), np.float32)
        for lo in range(0, len(x), TILE):
            some = x[lo : lo + TILE]
            near[lo : lo + TILE] = np.matmul(some, self.routes.T, out=room[: len(some)]).argmax(1)
        return near

    def walk(self, query: np.ndarray, start: int, beam: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The pivots in sight of a (centred) query and their squared distances, nearest first, when no nearer one is left to open.

        A walk that has been everywhere the links lead, with room left in its sight, goes on
        with the nearest of the others.
        """
        square, far = float(query @ query), np.full(len(self.x), np.inf, np.float32)
        opened = np.zeros(len(self.x), bool)

        def met(new):
            far[new] = np.maximum(square + 2 * (self.half[new] - self.x[new] @ query), 0)

        sight = np.array([start])
        met(sight)
        while True:
            front = sight[~opened[sight]][:width]
            opened[front] = True
            new = np.zeros(len(self.x), bool)
            new[self.links[front] if len(front) else slice(None)] = True
            new = np.flatnonzero(new & np.isinf(far)) if len(front) or len(sight) < beam else front
            if not len(front) and not len(new):
                return sight, far[sight]
            met(new)
            sight = np.concatenate((sight, new))
            if len(sight) > beam:
                sight = sight[np.argpartition(far[sight], beam - 1)[:beam]]
            sight = sight[np.lexsort((sight, far[sight]))]


def _matrix(column, dtype: str) -> np.ndarray:
    """Vectors of one length, from their bytes, which lie one after another."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        _, offsets, data = chunk.buffers()
        if len(chunk):
            ends = np.frombuffer(offsets, np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(dtype).reshape(len(chunk), -1))
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros((0, 1), dtype)


def indexed(nodes_: DataFrame, pivots: Pivots, dtype: str) -> DataFrame:
    """cell (the nearest pivot), node, tag and vector of all nodes."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                cell = pivots.cells(pivots.centred(_matrix(batch.column(2), dtype)))
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], names=["cell", "node", "tag", "vector"])

    return nodes_.select("node", "tag", "vector").mapInArrow(run, "cell int, node long, tag long, vector binary")


class Layout:
    """Blocks of cells that lie near one another; a cell of more rows than a block has is dealt out to several."""

    def __init__(self, pivots: Pivots, sizes: pa.Table, rows: int):
        self.rows = np.zeros(len(pivots.x), np.int64)
        self.rows[sizes["cell"].to_numpy()] = sizes["count"].to_numpy()
        self.pieces = np.maximum(1, -(-self.rows // rows))
        some = pivots.x[:: max(1, int(len(pivots.x) ** 0.5))]
        near = (pivots.x @ some.T - (some * some).sum(1) / 2).argmax(1)
        self.first, self.blocks, filled = np.zeros(len(pivots.x), np.int64), 0, 0
        for cell in np.argsort(near, kind="stable"):
            if filled and (filled + self.rows[cell] > rows):
                self.blocks, filled = self.blocks + 1, 0
            self.first[cell] = self.blocks
            filled += self.rows[cell]
            if self.pieces[cell] > 1:
                self.blocks, filled = self.blocks + int(self.pieces[cell]), 0
        self.blocks += 1

    def tasks(self, spark: SparkSession) -> np.ndarray:
        """A number for each block, so that Spark deals out every block to a task of its own."""
        numbers = np.arange(self.blocks)
        if self.blocks > 1:
            tried = spark.range(self.blocks * 40).select("id", F.pmod(F.hash("id"), F.lit(self.blocks)).alias("task"))
            first = {r["task"]: r["id"] for r in tried.groupBy("task").agg(F.min("id").alias("id")).collect()}
            # Any numbers do; those that weren't met are beyond all that were.
            numbers = np.array([first.get(task, self.blocks * 40 + task) for task in range(self.blocks)])
        return numbers

    def placed(self, index: DataFrame) -> DataFrame:
        """`index` with the block of each node."""
        cells = index.sparkSession.createDataFrame(
            [(cell, int(first), int(pieces)) for cell, (first, pieces) in enumerate(zip(self.first, self.pieces))], "cell int, first long, pieces long",
        )
        block = F.col("first") + F.pmod(F.xxhash64("tag", "node"), F.col("pieces"))
        return index.join(F.broadcast(cells), "cell").withColumn("block", block).drop("first", "pieces")


_VISIT = "block long, query long, vector binary, cells binary, bound double"


def visits(asked: DataFrame, pivots: Pivots, layout: Layout, dtype: str, keep: int, beam: int, width: int) -> DataFrame:
    """For each (query, vector) a row per block that has cells in its sight, with those and a bound for the `keep` nearest."""
    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, TILE):
                some = batch.slice(lo, TILE)
                x = pivots.centred(_matrix(some.column(1), dtype))
                rows = []
                for query, vector, own, start in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), x, pivots.cells(x)):
                    sight, far = pivots.walk(own, start, beam, width)
                    # Pivots are nodes, so as many nodes as pivots are that near; a little more, as distances are rounded.
                    bound = float(far[keep - 1]) * 1.001 + 1e-5 * float(own @ own) if len(far) >= keep else float("inf")
                    cells = np.repeat(sight, layout.pieces[sight]).astype(np.int32)
                    starts = np.concatenate(([0], np.cumsum(layout.pieces[sight])[:-1]))
                    blocks = layout.first[cells] + np.arange(len(cells)) - np.repeat(starts, layout.pieces[sight])
                    order = np.argsort(blocks, kind="stable")
                    blocks, cells = blocks[order], cells[order]
                    at = group_starts(blocks)
                    rows += [(int(blocks[a]), query, vector, cells[a:b].tobytes(), bound) for a, b in zip(at, [*at[1:], len(blocks)])]
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "query", "vector", "cells", "bound"])

    return asked.select("query", "vector").mapInArrow(run, _VISIT)


class _Block:
    """Nodes of a block, in order of cell."""

    def __init__(self, rows: pa.Table, pivots: Pivots, dtype: str):
        cell = rows["cell"].to_numpy()
        order = np.argsort(cell, kind="stable")
        self.names, self.tags = rows["name"].to_numpy()[order], rows["tag"].to_numpy()[order]
        self.vectors, self.pivots = _matrix(rows["vector"], dtype)[order], pivots
        cell = cell[order]
        starts = group_starts(cell)
        self.of = {int(cell[a]): (a, b) for a, b in zip(starts, [*starts[1:], len(cell)])}
        self.near: dict[int, np.ndarray] = {}

    def _cell(self, cell: int) -> np.ndarray:
        """Vectors as seen from the pivot, with their squares, so that rounding is small against the distances."""
        if cell not in self.near:
            x = self.pivots.centred(self.vectors[slice(*self.of[cell])]) - self.pivots.x[cell]
            self.near[cell] = np.concatenate((-2 * x, (x * x).sum(1)[:, None]), 1)
        return self.near[cell]

    def answers(self, queries: pa.Table, dtype: str, keep: int, least: int) -> tuple[np.ndarray, ...]:
        """Parallel arrays (query's place, node's place, distance): the `least` nearest in the cells that each query asks for."""
        vectors, worst = _matrix(queries["vector"], dtype), queries["bound"].to_numpy().copy()
        x = np.concatenate((self.pivots.centred(vectors), np.ones((len(vectors), 1), np.float32)), 1)
        lists = [np.frombuffer(c, np.int32) for c in queries["cells"].to_pylist()]
        asking, cells = np.repeat(np.arange(len(lists)), [len(c) for c in lists]), np.concatenate(lists)
        order = np.argsort(cells, kind="stable")
        asking, cells = asking[order], cells[order]
        best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)]
        found, waiting = [], 0
        room, flags = np.empty(16 * TILE * TILE, np.float32), np.empty(16 * TILE * TILE, bool)

        def settle():
            joined = [np.concatenate(c) for c in zip(best, *found)]
            kept = _first_of_many(joined[0], joined[2], self.names[joined[1]], keep)
            best[:] = (c[kept] for c in joined)
            starts = group_starts(best[0])
            ends = np.array([*starts[1:], len(best[0])])
            full = ends - starts >= keep
            at = best[0][starts[full]]
            worst[at] = np.minimum(worst[at], best[2][ends[full] - 1])

        starts = group_starts(cells)
        for a, b in zip(starts, [*starts[1:], len(cells)]):
            cell = int(cells[a])
            if cell not in self.of:
                continue
            first, near = self.of[cell][0], self._cell(cell)
            for lo in range(a, b, TILE):
                rows = asking[lo : min(b, lo + TILE)]
                own = x[rows]
                own[:, :-1] -= self.pivots.x[cell]
                square = (own[:, :-1] ** 2).sum(1)
                for some in range(0, len(near), 16 * TILE):
                    nodes_ = near[some : some + 16 * TILE]
                    d = room[: len(own) * len(nodes_)].reshape(len(own), -1)
                    np.matmul(own, nodes_.T, out=d)
                    near_enough = np.less_equal(d, (worst[rows] - square).astype(np.float32)[:, None], out=flags[: d.size].reshape(d.shape))
                    hits = np.flatnonzero(near_enough)
                    i, j = np.divmod(hits, d.shape[1])
                    found.append((rows[i], first + some + j, np.maximum(d.ravel()[hits] + square[i], 0) + np.float32(0)))
                    waiting += len(hits)
                    if waiting > 2 * keep * len(lists):
                        settle()
                        found, waiting = [], 0
        settle()
        query, place, _ = best
        exact = np.empty(len(query))
        for lo in range(0, len(query), 8192):
            gap = self.vectors[place[lo : lo + 8192]].astype(float) - vectors[query[lo : lo + 8192]]
            # Squares are added up from first to last.
            exact[lo : lo + 8192] = np.sqrt(np.cumsum(gap * gap, 1)[:, -1])
        kept = _first(query, exact, self.names[place], least)
        return query[kept], place[kept], exact[kept]


_ANSWER = "query long, names binary, tags binary, dists binary"


def answers(index: DataFrame, asked: DataFrame, pivots: Pivots, layout: Layout, dtype: str, k: int, beam: int, width: int) -> DataFrame:
    """(query, node, tag, score): the k nearest nodes in the cells in sight of each (query, vector).

    A block's nodes are held, and its queries pass by them.
    """
    keep, count = 2 * k, asked.count()
    def run(batches):
        block, rows, held = None, [], None
        for batch in batches:
            at, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            runs = group_starts(at * 2 + kind)
            for a, b in zip(runs, [*runs[1:], len(at)]):
                if at[a] != block:
                    block, rows, held = at[a], [], None
                part = batch.slice(a, b - a)
                if not kind[a]:
                    rows.append(part)
                    continue
                if held is None:
                    held, rows = _Block(pa.Table.from_batches(rows).select(["name", "tag", "cell", "vector"]), pivots, dtype) if rows else None, []
                if held is None:
                    continue
                query, place, dist = held.answers(pa.Table.from_batches([part]), dtype, keep, k)
                names, starts = part.column(2).to_numpy(), group_starts(query)
                out = [
                    (int(names[query[c]]), held.names[place[c:d]].tobytes(), held.tags[place[c:d]].tobytes(), dist[c:d].tobytes())
                    for c, d in zip(starts, [*starts[1:], len(query)])
                ]
                columns = list(zip(*out)) if out else [[]] * 4
                kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query", "names", "tags", "dists"])

    def merged(batches):
        table = pa.Table.from_batches(list(batches), pa.schema([("query", pa.int64()), ("names", pa.binary()), ("tags", pa.binary()), ("dists", pa.binary())]))
        names, tags, dists = (np.frombuffer(b"".join(table[c].to_pylist()), t) for c, t in (("names", np.int64), ("tags", np.int64), ("dists", float)))
        query = np.repeat(table["query"].to_numpy(), pc.binary_length(table["dists"]).to_numpy() // 8)
        kept = _first(query, dists, names, k)
        yield pa.RecordBatch.from_arrays([pa.array(c[kept]) for c in (query, names, tags, dists)], names=["query", "node", "tag", "score"])

    none = {name: F.lit(None).cast(kind) for name, kind in (("cell", "int"), ("tag", "long"), ("cells", "binary"), ("bound", "double"))}
    walks = asked.repartition(max(1, -(-count // SCAN_QUERIES)))
    going = visits(walks, pivots, layout, dtype, keep, beam, width)
    columns = ["block", "kind", "name", "tag", "cell", "vector", "cells", "bound"]
    there = layout.placed(index).withColumns({"kind": F.lit(0), "name": F.col("node"), "cells": none["cells"], "bound": none["bound"]}).select(columns)
    going = going.withColumns({"kind": F.lit(1), "name": F.col("query"), "tag": none["tag"], "cell": none["cell"]}).select(columns)
    task = F.element_at(F.lit(layout.tasks(index.sparkSession).tolist()), (F.col("block") + 1).cast("int"))
    both = there.unionByName(going).withColumn("block", task).repartition(layout.blocks, "block").sortWithinPartitions("block", "kind")
    parts = max(1, -(-count * layout.blocks // MERGED))
    return both.mapInArrow(run, _ANSWER).repartition(parts, "query").mapInArrow(merged, "query long, node long, tag long, score double")


def scanned(index: DataFrame, asked: pa.Table, dtype: str, k: int) -> DataFrame:
    """(query, cell, place) for the k nearest nodes of each (query, vector) of `asked`, by a scan of all nodes."""
    names, x = asked["query"].to_numpy(), _matrix(asked["vector"], dtype).astype(float)

    def near(batches):
        owner, cell, node, dist = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)
        worst = np.full(len(x), np.inf)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                some = batch.slice(lo, 2048)
                d = _squares(x, _matrix(some.column(2), dtype).astype(float))
                i, j = np.nonzero(d < worst[:, None])
                owner, cell, node, dist = (
                    np.concatenate(c) for c in zip((owner, cell, node, dist), (i, some.column(0).to_numpy()[j], some.column(1).to_numpy()[j], d[i, j]))
                )
                kept = _first(owner, dist, node, k)
                owner, cell, node, dist = owner[kept], cell[kept], node[kept], dist[kept]
                starts = group_starts(owner)
                ends = np.array([*starts[1:], len(owner)])
                full = ends - starts >= k
                worst[owner[starts[full]]] = dist[ends[full] - 1]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (names[owner], cell, node, dist)], names=["query", "cell", "node", "dist"])

    place = F.row_number().over(Window.partitionBy("query").orderBy("dist", "node"))
    found = index.select("cell", "node", "vector").mapInArrow(near, "query long, cell int, node long, dist double")
    return found.withColumn("place", place).where(F.col("place") <= k).drop("dist", "node")


def _reached(known: dict[int, list[int]], sights: dict[int, np.ndarray], least: float, whole: bool) -> bool:
    """Whether the share of known neighbours whose cells are in sight is `least`, two standard errors below the mean unless the sample is whole."""
    shares = np.array([np.isin(cells, sights[query]).mean() for query, cells in known.items()])
    if not len(shares):
        return True
    return shares.mean() - (0 if whole else 2 * shares.std() / len(shares) ** 0.5) >= least


def widened(index: DataFrame, asked: DataFrame, pivots: Pivots, dtype: str, k: int, recall: float = RECALL, beam: int = BEAM, width: int = OPENED) -> tuple[int, int]:
    """Beam and width, doubled until a sample of the queries finds the share `recall` of its k nearest other nodes.

    All nodes of the cells in sight are compared, so a neighbour is found if its cell is in
    sight. With all pivots in sight, all nodes are compared.
    """
    sample = asked.orderBy(F.xxhash64("query"), "query").limit(MEASURED).select("query", "vector").toArrow()
    known: dict[int, list[int]] = {}
    # The node itself is the nearest of all.
    for r in scanned(index, sample, dtype, k + 1).where("place > 1").collect():
        known.setdefault(r["query"], []).append(r["cell"])
    whole, x = asked.count() <= sample.num_rows, pivots.centred(_matrix(sample["vector"], dtype))
    starts = pivots.cells(x)
    while beam < len(pivots.x):
        sights = {q: pivots.walk(own, at, beam, width)[0] for q, own, at in zip(sample["query"].to_pylist(), x, starts)}
        if _reached(known, sights, recall, whole):
            break
        beam, width = 2 * beam, 2 * width
    return beam, width


_RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", **search_limits: float) -> DataFrame:
    """The k nearest other rows found for each of `queries`, which are rows of `vectors`.

    Returns query_id, rank (from 1), vec_id and score, the Euclidean distance in double
    precision between the original vectors; ties go to the smaller id. Vectors that are
    null, zero or not finite in all components take no part, nor do rows without an id; such
    queries have no result. Vectors of different lengths have no distance: each length has a
    graph of its own, and a query's candidates are those of its length. Equal vectors are neighbours at
    distance 0. Recall is measured on this table's queries, and the search widened until it is
    `recall` (see `widened` for the limits). A repeated id is a candidate once per row; a query's own id is none. Other columns are ignored, whatever their names; an empty table gives an
    empty result.
    """
    kinds = [rows.schema[vector_col].dataType.elementType for rows in (vectors, queries)]
    dtype = "<f4" if all(isinstance(kind, T.FloatType) for kind in kinds) else "<f8"
    with Scratch(vectors.sparkSession) as steps:
        rows, asked = (steps.written(_usable_rows(x, id_col, vector_col, dtype), "ann-rows") for x in (vectors, queries))
        # A vector whose length no other row has is nobody's neighbour.
        sizes = [r["size"] for r in rows.groupBy("size").count().where("count > 1").orderBy(F.desc("count"), "size").collect()]
        found = []
        for size in sizes:
            same = F.col("size") == size
            found.append(_nearest_rows(rows.where(same), asked.where(same), steps, dtype, k, search_limits, size == sizes[-1]))
    return reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], _RESULT)


def _nearest_rows(rows: DataFrame, asked: DataFrame, steps: Scratch, dtype: str, k: int, search_limits: dict, last: bool) -> DataFrame:
    """`nearest` for vectors of one length, of rows and queries of _usable_rows. last: the table of `rows` is no longer needed."""
    few, copies, count = nodes(rows, asked, steps, k + 1)
    asked = asked.select(F.col("id").alias("query_id"), "key", "vector").distinct()
    asked = asked.join(few.where("rows > 0 and asked > 0").select("key"), "key")
    names = steps.written(asked.groupBy("key").agg(F.first("vector").alias("vector")).withColumn("query", F.monotonically_increasing_id()), "ann-queries")
    asked = asked.select("query_id", "key").join(names.select("key", "query"), "key").select("query_id", "query")
    if names.isEmpty():
        return rows.sparkSession.createDataFrame([], _RESULT)
    base = _distinct(rows, copies)
    share = max(LEAST_PIVOTS, PIVOTS * count**0.5) / count
    drawn = base.where(F.pmod(F.xxhash64("node", "tag"), F.lit(1 << 40)) < F.lit(int(min(1, share) * (1 << 40))))
    drawn = steps.written(drawn.select(F.xxhash64("tag", "node").alias("node"), "vector").mapInArrow(_narrowed(dtype), "node long, vector binary"), "ann-pivots")
    pivots = Pivots(linked(build(drawn, steps), steps).select("node", "vector", "links").toArrow())
    index = steps.written(indexed(base, pivots, dtype), "ann-index", rows if last else None)
    beam, width = widened(index, names, pivots, dtype, k, **search_limits)
    size = pivots.x.shape[1] * np.dtype(dtype).itemsize
    layout = Layout(pivots, index.groupBy("cell").count().toArrow(), max(1, BLOCK_BYTES // size))
    found = steps.written(answers(index, names, pivots, layout, dtype, k + 1, beam, width), "ann-found")
    ids = F.coalesce("ids", F.array("node"))
    scored = found.join(copies.select("node", "tag", "ids"), ["node", "tag"], "left").select("query", "score", F.explode(ids).alias("vec_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return written(
        asked.join(scored, "query").where("vec_id <> query_id")
        .withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"),
        "nearest",
    )
