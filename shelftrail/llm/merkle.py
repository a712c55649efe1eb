"""Merkle manifest of a dataset: a postorder append log, and proofs read out of it.

Rows are leaves of a tree per value of a column; the trees' roots are leaves of one more. A
node stands for `ARITY` consecutive ones. Builders take aligned runs of ARITY ** HEIGHT nodes,
so all nodes of some levels above a run lie in one builder, and write each node when its
last leaf has come: a log in postorder. The next builders take the roots of those. Where a node
lies in a log follows from the sizes of the subtrees before it, in closed form (`position`),
so siblings are addressed without pointers or search.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrail.llm.order import numbered
from shelftrail.llm.tables import Scratch, written

#: Nodes that one node stands for, and levels that one builder writes.
ARITY, HEIGHT = 8, 3

_LOG = "tree long, block long, leaves long, height int, log binary, root binary"
_LOG_ARROW = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("leaves", pa.int64()), ("height", pa.int32()), ("log", pa.binary()), ("root", pa.binary())])
_PATH = "tree long, node long, left array<binary>, right array<binary>, subroot binary, top binary"
_PATH_ARROW = pa.schema([
    ("tree", pa.int64()), ("node", pa.int64()), ("left", pa.list_(pa.binary())), ("right", pa.list_(pa.binary())), ("subroot", pa.binary()), ("top", pa.binary()),
])
_PROOF = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_PROOF_ARROW = pa.schema([
    ("id", pa.int64()), *[(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_()),
])


def height_of(leaves: int) -> int:
    """Levels above so many leaves until one node is left."""
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def position(level: int, index: int, leaves: int) -> int:
    """Where the log over `leaves` leaves has node `index` of a level.

    A full node is written when its last leaf has come, after the full nodes of its own and
    lower levels up to that leaf and those of higher levels before it. Nodes left open by the
    last leaf follow at the end, lower levels first.
    """
    end = (index + 1) * ARITY**level
    if end <= leaves:
        before, k = -1, 0
        while ARITY**k <= end:
            before += (end if k <= level else end - 1) // ARITY**k
            k += 1
        return before
    full = sum(leaves // ARITY**k for k in range(height_of(leaves) + 1))
    return full + sum(leaves % ARITY**k != 0 for k in range(1, level))


def node_hash(children: list[bytes]) -> bytes:
    """Digest of the children's digests as lower-case hexadecimal text, joined."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """All nodes of `height` levels above the leaves, each appended once its last leaf has come."""
    log, open_ = [], [[] for _ in range(height + 1)]

    def add(level: int, node: bytes) -> None:
        log.append(node)
        if level < height:
            open_[level].append(node)
            if len(open_[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        children, open_[level] = open_[level], []
        add(level + 1, node_hash(children))

    for leaf in leaves:
        add(0, leaf)
    for level in range(height):
        if open_[level]:
            close(level)
    return log


def _nodes(log: bytes, leaves: int, height: int) -> list[list[bytes]]:
    """The nodes of each level, from their places in the log."""
    return [
        [log[32 * p : 32 * p + 32] for p in (position(level, j, leaves) for j in range(-(-leaves // ARITY**level)))]
        for level in range(height + 1)
    ]


def siblings(levels: list[list[bytes]], leaf: int) -> list[tuple[bytes, bytes]]:
    """Per level, the digests before and after the leaf's ancestor in its run, joined."""
    out = []
    for nodes in levels[:-1]:
        run = leaf // ARITY * ARITY
        out.append((b"".join(nodes[run:leaf]), b"".join(nodes[leaf + 1 : run + ARITY])))
        leaf //= ARITY
    return out


def fold(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a node and the siblings of its ancestors give."""
    for left, right in path:
        node = sha256((left + node + right).hex().encode()).digest()
    return node


def proof_hash(path: list[tuple[bytes, bytes]]) -> str:
    return sha256("".join((left + right).hex() for left, right in path).encode()).hexdigest()


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _build(height: int):
    """The log of one block. Blocks of a tree with several have `height` levels, an only one as many as it needs."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        leaves, count = table["digest"].to_pylist(), table["count"][0].as_py()
        levels = height if count > ARITY**height else height_of(count)
        log = append_log(leaves, levels)
        return _table([(table["tree"][0].as_py(), table["block"][0].as_py(), len(leaves), levels, b"".join(log), log[-1])], _LOG_ARROW)

    return run


@dataclass
class Forest:
    """Logs of trees: a table of _LOG per round of builders, and (tree, root, round) of all trees."""

    rounds: list[DataFrame]
    roots: DataFrame
    height: int


def forest(nodes: DataFrame, steps: Scratch, height: int = HEIGHT) -> Forest:
    """Builds trees from (tree, at, count, digest): their leaves, numbered from 0, and how many each has.

    A builder has at most ARITY ** height nodes, whatever the size of its tree. A round has that
    many times fewer rows than the one before, and ends the trees that had one block.
    """
    rounds, ended, size = [], [], ARITY**height
    while True:
        blocks = nodes.withColumn("block", F.expr(f"at div {size}")).groupBy("tree", "block")
        logs = steps.written(blocks.applyInArrow(_build(height), _LOG), "merkle-log")
        counts = nodes.groupBy("tree").agg(F.expr(f"(max(count) + {size - 1}) div {size}").alias("count"))
        roots = logs.select("tree", F.col("block").alias("at"), F.col("root").alias("digest")).join(counts, "tree")
        nodes = steps.written(roots, "merkle-roots")
        ended.append(nodes.where("count = 1").select("tree", F.col("digest").alias("root"), F.lit(len(rounds)).alias("round")))
        rounds.append(logs)
        nodes = nodes.where("count > 1")
        if nodes.isEmpty():
            return Forest(rounds, reduce(DataFrame.unionByName, ended), height)


def _above(log: dict) -> list[tuple[bytes, bytes]]:
    return list(zip(log["left"], log["right"]))


def _paths(size: int):
    """The path of each leaf of a block."""
    def run(logs: pa.Table) -> pa.Table:
        log = logs.to_pylist()[0]
        levels, above = _nodes(log["log"], log["leaves"], log["height"]), _above(log)
        out = []
        for i in range(log["leaves"]):
            path = siblings(levels, i) + above
            out.append((log["tree"], log["block"] * size + i, [p[0] for p in path], [p[1] for p in path], log["subroot"], log["top"]))
        return _table(out, _PATH_ARROW)

    return run


def with_paths(trees: Forest, above: DataFrame, steps: Scratch) -> DataFrame:
    """The first round's logs, with the siblings (left, right) from each block's root upward, subroot and top.

    `above` has them from the trees' roots upward: tree, left, right, subroot, top. Rounds are
    walked from the last: a block's root is a leaf of the next round.
    """
    found, size = None, ARITY**trees.height
    for n in reversed(range(len(trees.rounds))):
        ended = trees.roots.where(F.col("round") == n).select("tree", F.lit(0).cast("long").alias("block"))
        paths = ended.join(above, "tree").select("tree", "block", "left", "right", "subroot", "top")
        if found is not None:
            paths = paths.unionByName(found.withColumnRenamed("node", "block"))
        logs = steps.written(trees.rounds[n].join(paths, ["tree", "block"]), "merkle-paths")
        if n:
            found = leaf_paths(logs, steps, size)
    return logs


def leaf_paths(logs: DataFrame, steps: Scratch, size: int) -> DataFrame:
    """tree, node (the leaf's number), left, right, subroot and top for each leaf of logs from `with_paths`."""
    return steps.written(logs.groupBy("tree", "block").applyInArrow(_paths(size), _PATH), "merkle-leaves")


def leaf_hash(*fields: Column) -> Column:
    """SHA-256 over the fields: `-` for a null, else the length of its text in UTF-8 bytes, `:` and the text."""
    def one(field: Column) -> Column:
        text = field.cast("string")
        return F.when(field.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.unhex(F.sha2(F.concat(*[one(f) for f in fields]), 256))


def _proofs(rows: pa.Table, logs: pa.Table) -> pa.Table:
    """A row per leaf of a block: its digests, its proof, and the root that its present content gives."""
    rows, log = rows.sort_by("at"), logs.to_pylist()[0]
    levels, above = _nodes(log["log"], log["leaves"], log["height"]), _above(log)
    out, folded = [], {}
    for i, (id_, now) in enumerate(zip(rows["id"].to_pylist(), rows["present"].to_pylist())):
        own, leaf = siblings(levels, i), levels[0][i]
        block = fold(leaf if now is None else now, own)
        if block not in folded:
            folded[block] = fold(block, above)
        root = folded[block]
        out.append((id_, leaf.hex(), log["subroot"].hex(), log["top"].hex(), proof_hash(own + above), root.hex(), root == log["top"]))
    return _table(out, _PROOF_ARROW)


@dataclass
class Manifest:
    """leaves: tree, at, count, id, digest, present. subroots: of (a tree), at, count, digest. And the logs over both."""

    leaves: DataFrame
    trees: Forest
    subroots: DataFrame
    over: Forest


def manifest(docs: DataFrame, steps: Scratch, group: Column, id_: Column, leaf: Column, present: Column | None = None, height: int = HEIGHT) -> Manifest:
    """Builds the logs over the leaf digests of `docs`, in a tree per value of `group`, and over the trees' roots.

    The content is read once. A tree's leaves are numbered by id, nulls first, and, where that
    is equal, by digest. Trees are in order of their group, null first, and known by the place
    of their first leaf among all; they may hold any share of the rows.
    """
    present = F.lit(None).cast("binary") if present is None else present
    rows = docs.select(group.alias("group"), id_.cast("long").alias("id"), leaf.alias("digest"), present.alias("present"))
    placed = numbered(steps.written(rows, "merkle-rows"), steps, "merkle", "group", "id", "digest")
    firsts = placed.groupBy(F.col("group").alias("of")).agg(F.min("place").alias("tree"), F.count("*").alias("count"))
    firsts = steps.written(firsts, "merkle-trees")
    leaves = placed.join(firsts, F.col("group").eqNullSafe(F.col("of")))
    leaves = steps.written(leaves.select("tree", (F.col("place") - F.col("tree")).alias("at"), "count", "id", "digest", "present"), "merkle-leaves")
    trees = forest(leaves.select("tree", "at", "count", "digest"), steps, height)

    roots = steps.written(trees.roots.select(F.col("tree").alias("of"), F.col("root").alias("digest")), "merkle-roots")
    subroots = numbered(roots, steps, "subroots", "of").withColumnRenamed("place", "at")
    subroots = steps.written(subroots.withColumns({"tree": F.lit(0).cast("long"), "count": F.lit(firsts.count()).cast("long")}), "merkle-subroots")
    return Manifest(leaves, trees, subroots, forest(subroots.select("tree", "at", "count", "digest"), steps, height))


def proofs(
    docs: DataFrame, group: Column, id_: Column, leaf: Column, present: Column | None = None, height: int = HEIGHT
) -> DataFrame:
    """One row per row of `docs`: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    `leaf` is a row's digest (see `leaf_hash`) and `present` that of its content now, null where
    nothing changed. folded_root is made of the present digest and the siblings in the logs;
    verified says whether it equals root. proof_sha256 is the digest of the siblings, from the
    leaf's run up to the root, left to right. A lone leaf is its tree's root and a lone tree's
    root that of all; without siblings the proof is the empty text. Null groups and ids come
    first; rows of equal ids are in order of their digests and rows repeated as a whole have
    neighbouring leaves. Only the columns given are read, so others may have any names;
    texts are hashed where they lie, whatever their length. An empty table gives an empty
    result.
    """
    with Scratch(docs.sparkSession) as steps:
        built = manifest(docs, steps, group, id_, leaf, present, height)
        none = F.array().cast("array<binary>")
        top = built.over.roots.select("tree", none.alias("left"), none.alias("right"), F.lit(None).cast("binary").alias("subroot"), F.col("root").alias("top"))
        over = leaf_paths(with_paths(built.over, top, steps), steps, ARITY**height)
        subroots = built.subroots.select("of", F.col("at").alias("node"), F.col("digest").alias("own"))
        above = subroots.join(over.select("node", "left", "right", "top"), "node").select(F.col("of").alias("tree"), "left", "right", F.col("own").alias("subroot"), "top")
        logs = with_paths(built.trees, steps.written(above, "merkle-above"), steps)
        rows = built.leaves.select("tree", F.expr(f"at div {ARITY ** height}").alias("block"), "at", "id", "present")
        found = rows.groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(_proofs, _PROOF)
        return written(found, "merkle-proofs")
