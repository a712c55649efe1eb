"""Repair of conversations' structure at least cost, by a Viterbi search over chunks in parallel.

A conversation should be empty or `s?(ua)+` in its rows' roles. Rows are kept, given another
role, deleted, or new ones put between; a state says which role may come next. Cost to go, by
state, runs from a conversation's last row to its first. All rows are numbered in one order and
cut into chunks of equal length whatever conversation they belong to, so one conversation may
span many chunks. Every chunk first guesses the costs at its right end. Then passes put right
the chunks whose guess differs from what the next chunk gives by more than a constant, as a
constant changes no decision, until none is left. Along the costs each chunk then traces the
edits from any state it may start in; a conversation's states at its chunks' borders follow
from one chunk to the next.
"""

from __future__ import annotations

from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrail.llm.order import numbered
from shelftrail.llm.tables import Scratch, written

#: Rows per chunk.
CHUNK = 1024
#: Characters that count as white space.
BLANKS = " \t\n\x0b\x0c\r"
_ZERO = (0, 0, 0, 0)

#: States: nothing yet, after the system's row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
#: The state after a row of another role or a new row, which may only be the one that is due.
_DUE = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after keeping a row of initial s, u, a or another (code 0 to 3), by state; None: not allowed.
_KEPT = {0: (SYSTEM, None, None, None), 1: (USER, USER, None, USER), 2: (None, None, ASSISTANT, None), 3: (None,) * 4}
#: Cost to go after the last row.
_END = (0, 2 * INSERT, INSERT, 0)

#: A row's kind: its initial's code, plus these.
_DROP, _CUT_OFF, _LAST = 4, 8, 16


def _moves(kind: int, after: tuple[int, ...], state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, state after) of the edits that deal with a row, without those before it."""
    out = [("D", DELETE + after[state], state)]
    if not kind & _DROP:
        extra = TRUNCATED if kind & _CUT_OFF else 0
        to = _KEPT[kind & 3][state]
        if to is not None:
            out.append(("K", KEEP + extra + after[to], to))
        out.append(("R", REROLE + extra + after[_DUE[state]], _DUE[state]))
    return out


@lru_cache(None)
def _before(kind: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cost to go before a row, by state and less the smallest, from that after it. Two new rows are the most that help."""
    after = _END if kind & _LAST else after
    own = [min(m[1] for m in _moves(kind, after, s)) for s in range(4)]
    costs = [min(own[s], INSERT + own[_DUE[s]], 2 * INSERT + own[_DUE[_DUE[s]]]) for s in range(4)]
    return tuple(c - min(costs) for c in costs)


@lru_cache(None)
def _edits(kind: int, after: tuple[int, ...], state: int) -> tuple[str, int, int]:
    """The ASCII-least cheapest edits at a row from a state: initials, own cost, state after it.

    An initial leads to one state only, so the least of the cheapest first initials begins the
    least audit.
    """
    after = _END if kind & _LAST else after
    own = [min(m[1] for m in _moves(kind, after, s)) for s in range(4)]
    full = [min(own[s], INSERT + own[_DUE[s]], 2 * INSERT + own[_DUE[_DUE[s]]]) for s in range(4)]
    initials, cost = "", 0
    while True:
        moves = [*_moves(kind, after, state), ("I", INSERT + full[_DUE[state]], _DUE[state])]
        name, total, to = min((m for m in moves if m[1] == full[state]), key=lambda m: m[0])
        cost += full[state] - (full[to] if name == "I" else after[to])
        initials, state = initials + name, to
        if name != "I":
            break
    if kind & _LAST:
        initials, cost = initials + "I" * (_END[state] // INSERT), cost + _END[state]
    return initials, cost, state


def damaged(rows: DataFrame, draw: Column) -> DataFrame:
    """`rows` (conv, turn, role, text; no nulls in the last two) after damage by `draw`.

    0 drops a row, 1 empties its text, 2 takes `.`, `!` and `?` out of it, 3 repeats it next to
    itself and 4 makes its role user; all others stay as they are.
    """
    text = F.when(draw == 1, "").when(draw == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(draw == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(draw != 0).select("conv", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def plain(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv, turn, role and text; a null role or text is one space. Other columns go."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]
    return conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), *texts)


def _digest() -> Column:
    return F.sha2(F.col("text").cast("binary"), 256).alias("digest")


def _pieces_type(conv: str) -> tuple[str, list[str]]:
    names = ["chunk", "conv", "kinds", "head", "tail", *_COUNTS, "low", "high", "first", "last"]
    kinds = {"conv": conv, "kinds": "binary", "head": "boolean", "tail": "boolean"}
    return ", ".join(f"{n} {kinds.get(n, 'long')}" for n in names), names


#: Sums over a conversation's rows: faults, neighbours in a wrong order, and turns that the row before doesn't have.
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
#: Pairs of codes that may be neighbours: su, ua, au.
_LEGAL = ((0, 1), (1, 2), (2, 1))


def _cut(rows: pa.Table, firsts: pa.Table) -> pa.Table:
    """The pieces of a chunk: a row per conversation in it."""
    rows = rows.sort_by("place")
    n = rows.num_rows
    conv = pc.fill_null(pc.dictionary_encode(rows["conv"].combine_chunks()).indices, -1).to_numpy(zero_copy_only=False)
    turns, known = rows["turn"].fill_null(0).to_numpy(), rows["turn"].is_valid().to_numpy()
    code = rows["code"].to_numpy().astype(np.uint8)
    blank = rows["blank"].to_numpy()
    duplicate = ~blank & ~np.isin(rows["place"].to_numpy(), firsts["place"].to_numpy())
    truncated = ~blank & ~duplicate & rows["cut_off"].to_numpy()
    new = np.ones(n, bool)
    new[1:] = conv[1:] != conv[:-1]
    legal = np.zeros(n, bool)
    for a, b in _LEGAL:
        legal[1:] |= (code[:-1] == a) & (code[1:] == b)
    fresh = known.copy()
    fresh[1:] &= new[1:] | ~known[:-1] | (turns[1:] != turns[:-1])
    kinds = (code + _DROP * (blank | duplicate) + _CUT_OFF * truncated).astype(np.uint8)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    sums = [np.add.reduceat(x.astype(np.int64), starts) for x in (blank, duplicate, truncated, ~legal & ~new, fresh)]
    lowest = [min((int(t) for t, k in zip(turns[a:b], known[a:b]) if k), default=None) for a, b in zip(starts, ends)]
    highest = [int(turns[b - 1]) if known[b - 1] else None for b in ends]
    columns = [
        pa.array([rows["chunk"][0].as_py()] * len(starts), pa.int64()), rows["conv"].take(pa.array(starts)).combine_chunks(),
        pa.array([kinds[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
        pa.array(starts == 0), pa.array(ends == n), *[pa.array(x) for x in sums], pa.array(lowest, pa.int64()), pa.array(highest, pa.int64()),
        pa.array(code[starts].astype(np.int64)), pa.array(code[ends - 1].astype(np.int64)),
    ]
    return pa.table(columns, _pieces_type("")[1])


def _pieces(rows: DataFrame, steps: Scratch, chunk: int) -> DataFrame:
    """A row per conversation and chunk: the kinds of its rows, its sums, and whether the conversation goes on to either side."""
    first = F.left("role", F.lit(1))
    code = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    ended = F.rtrim("text", F.lit(BLANKS))
    facts = steps.written(rows.select(
        "conv", "turn", "role", _digest(), code.alias("code"), (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
    ), "conv-rows")
    placed = numbered(facts, steps, "conv", "conv", "turn", "role", "digest").withColumn("chunk", F.expr(f"place div {chunk}"))
    # First rows are found by their place, so a text that fills a conversation is no frequent key.
    firsts = placed.groupBy("conv", "role", "digest").agg(F.min("place").alias("place"))
    firsts = firsts.select("place", F.expr(f"place div {chunk}").alias("chunk"))
    kept = placed.select("chunk", "place", "conv", "turn", "code", "blank", "cut_off")
    schema = _pieces_type(rows.schema["conv"].dataType.simpleString())[0]
    pieces = steps.written(kept.groupBy("chunk").cogroup(firsts.groupBy("chunk")).applyInArrow(_cut, schema), "conv-pieces")
    for side, end, step in (("after", "head", -1), ("before", "tail", 1)):
        there = pieces.where(end).select((F.col("chunk") + step).alias("at"), F.col("conv").alias("of"), F.lit(True).alias(side))
        pieces = pieces.join(there, (F.col("chunk") == F.col("at")) & F.col("conv").eqNullSafe(F.col("of")), "left").drop("at", "of")
    return steps.written(pieces.fillna(False, ["after", "before"]), "conv-pieces")


def _kinds(kinds: bytes, after: bool) -> bytes:
    """The kinds of a piece; its last row is marked where the conversation ends."""
    return kinds if after else kinds[:-1] + bytes([kinds[-1] | _LAST])


def _costs(batches):
    """Cost to go before each stale piece, from that wanted after it."""
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            if r["stale"]:
                costs = tuple(r["wanted"])
                for kind in reversed(_kinds(r["kinds"], r["after"])):
                    costs = _before(kind, costs)
                r["guess"], r["left"] = r["wanted"], list(costs)
        yield pa.RecordBatch.from_pylist([{f.name: r[f.name] for f in batch.schema if f.name not in ("wanted", "stale")} for r in rows],
                                         pa.schema([f for f in batch.schema if f.name not in ("wanted", "stale")]))


def _settled(pieces: DataFrame, steps: Scratch) -> DataFrame:
    """chunk, conv and the cost to go after each piece (`guess`) of conversations in several chunks.

    The first pass starts everywhere from equal costs. A later one runs the pieces whose start
    isn't, but for a constant, what the last pass gave for the next piece.
    """
    long = pieces.where("before or after").select("chunk", "conv", "kinds", "after")
    conv = long.schema["conv"].dataType.simpleString()
    schema = f"chunk long, conv {conv}, kinds binary, after boolean, guess array<int>, left array<int>"
    none, zero = F.lit(None).cast("array<int>"), F.array(*[F.lit(0)] * 4)
    costs = long.select("*", none.alias("guess"), none.alias("left"), zero.alias("wanted"), F.lit(True).alias("stale"))
    costs = steps.written(costs.mapInArrow(_costs, schema), "conv-costs")
    while True:
        given = costs.select((F.col("chunk") - 1).alias("at"), F.col("conv").alias("of"), F.col("left").alias("wanted"))
        met = costs.join(given, F.col("after") & (F.col("chunk") == F.col("at")) & F.col("conv").eqNullSafe(F.col("of")), "left").drop("at", "of")
        met = met.withColumn("stale", F.coalesce(F.col("wanted") != F.col("guess"), F.lit(False)))
        if met.where("stale").isEmpty():
            return costs.select("chunk", "conv", "guess")
        costs = steps.written(met.mapInArrow(_costs, schema), "conv-costs", costs)


_TRACE = "ends array<int>, audits array<string>, costs array<long>"


def _traced(batches):
    """For each piece, from each state that it may start in: the state after it, its audit and its cost."""
    for batch in batches:
        ends, audits, costs = [], [], []
        columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("kinds", "after", "before", "guess")]
        for kinds, goes_on, goes_back, guess in zip(*columns):
            kinds, after = _kinds(kinds, goes_on), tuple(guess or _ZERO)
            known = []
            for kind in reversed(kinds):
                known.append(after)
                after = _before(kind, after)
            known.reverse()
            found = []
            for state in range(4 if goes_back else 1):
                audit, total = [], 0
                for kind, after in zip(kinds, known):
                    initials, cost, state = _edits(kind, after, state)
                    audit.append(initials)
                    total += cost
                found.append((state, "".join(audit), total))
            for column, value in zip((ends, audits, costs), zip(*found)):
                column.append(list(value))
        keep = [f.name for f in batch.schema if f.name not in ("kinds", "after", "guess", "head", "tail")]
        arrays = [batch.column(batch.schema.get_field_index(n)) for n in keep]
        types = [pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, t) for c, t in zip((ends, audits, costs), types)], names=[*keep, "ends", "audits", "costs"])


class _Conversation:
    """What the pieces of one conversation add up to, and its rows as they pass by."""

    def __init__(self, conv):
        self.conv, self.state, self.audit, self.cost = conv, START, [], 0
        self.sums = dict.fromkeys(_COUNTS, 0)
        self.low = self.high = self.last = None
        self.edits = None

    def piece(self, r: dict) -> None:
        self.audit.append(r["audits"][self.state])
        self.cost += r["costs"][self.state]
        self.state = r["ends"][self.state]
        for name in _COUNTS:
            self.sums[name] += r[name]
        if self.last is not None and (self.last, r["first"]) not in _LEGAL:
            self.sums["illegal"] += 1
        if r["low"] is not None:
            self.sums["turns"] -= r["low"] == self.high
            self.low = r["low"] if self.low is None else self.low
            self.high = r["high"]
        self.last = r["last"]

    def start(self) -> None:
        self.edits, self.audit = 0, "".join(self.audit)
        self.state = START

    def new(self):
        """(edit, role, text) of new rows that come next."""
        while self.edits < len(self.audit) and self.audit[self.edits] == "I":
            self.state, self.edits = _DUE[self.state], self.edits + 1
            yield "I", _ROLE[self.state], ""

    def row(self, role: str, text: str):
        """(edit, role, text) of what becomes of the next row, and of new rows before it. Deleted rows keep their text."""
        yield from self.new()
        edit = self.audit[self.edits]
        self.edits += 1
        if edit == "R":
            self.state = _DUE[self.state]
            role = _ROLE[self.state]
        elif edit == "K":
            self.state = _KEPT["sua".find(role[:1]) if role[:1] else 3][self.state]
        yield edit, role, text

    def counts(self) -> list[int]:
        gaps = self.high - self.low + 1 - self.sums["turns"] if self.low is not None else 0
        return [gaps, *[self.sums[n] for n in _COUNTS[:-1]], self.cost]


_DIGEST_NAMES = ["gaps", *_COUNTS[:-1], "cost"]


def _streamed(batches, new_output):
    """Conversations one after another: ids, pieces and rows pass in this order, so none is held whole."""
    one, out = None, new_output()

    def finish():
        if one is not None:
            if one.edits is None:
                one.start()
            out.end(one, one.new())

    for batch in batches:
        kind_at = batch.schema.get_field_index("kind")
        for lo in range(0, batch.num_rows, 1024):
            part = batch.slice(lo, 1024)
            kinds, convs = part.column(kind_at).to_pylist(), part.column(part.schema.get_field_index("conv")).to_pylist()
            pieces = part.column(part.schema.get_field_index("piece")).to_pylist()
            roles, texts = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("role", "text"))
            for kind, conv, piece, role, text in zip(kinds, convs, pieces, roles, texts):
                if one is None or conv != one.conv:
                    finish()
                    one = _Conversation(conv)
                if kind == 1:
                    one.piece(piece)
                elif kind == 2:
                    if one.edits is None:
                        one.start()
                    out.rows(one, one.row(role, text))
            yield from out.batches()
    finish()
    yield from out.batches()


class _Digests:
    """A row per conversation, with the digest of its repaired rows."""

    def __init__(self, conv_type: pa.DataType):
        self.type, self.found, self.hash, self.empty = conv_type, [], sha256(), True

    def rows(self, one: _Conversation, edits) -> None:
        for edit, role, text in edits:
            if edit != "D":
                self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
                self.empty = False

    def end(self, one: _Conversation, edits) -> None:
        self.rows(one, edits)
        self.found.append((one.conv, *one.counts(), one.audit, self.hash.hexdigest()))
        self.hash, self.empty = sha256(), True

    def batches(self):
        if self.found:
            types = [self.type, *[pa.int64()] * len(_DIGEST_NAMES), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.found), types)], names=["conv", *_DIGEST_NAMES, "audit", "repaired_sha256"])
            self.found = []


class _Rows:
    """The rows themselves, numbered in each conversation; deleted ones have no number."""

    def __init__(self, conv_type: pa.DataType):
        self.type, self.found, self.next = conv_type, [], 0

    def rows(self, one: _Conversation, edits) -> None:
        for edit, role, text in edits:
            self.found.append((one.conv, None if edit == "D" else self.next, edit, role, text))
            self.next += edit != "D"

    def end(self, one: _Conversation, edits) -> None:
        self.rows(one, edits)
        self.next = 0

    def batches(self):
        if self.found:
            types = [self.type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*self.found), types)], names=["conv", "number", "edit", "role", "text"])
            self.found = []


def _stream(rows: DataFrame, convs: DataFrame, steps: Scratch, chunk: int) -> DataFrame:
    """kind 0: a conversation's id, 1: its pieces, 2: its rows; by conversation and in order."""
    pieces = _pieces(rows, steps, chunk)
    settled = _settled(pieces, steps).select(F.col("chunk").alias("at"), F.col("conv").alias("of"), "guess")
    pieces = pieces.join(settled, (F.col("chunk") == F.col("at")) & F.col("conv").eqNullSafe(F.col("of")), "left").drop("at", "of", "head", "tail")
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema if f.name not in ("kinds", "after", "guess")]
    traced = steps.written(pieces.mapInArrow(_traced, ", ".join([*kept, _TRACE])), "conv-traced")
    piece = F.struct("audits", "costs", "ends", *_COUNTS, "low", "high", "first", "last").alias("piece")
    empty = [F.lit(None).cast("string").alias(c) for c in ("role", "text", "digest")]
    no_turn, no_chunk = F.lit(None).cast("long").alias("turn"), F.lit(None).cast("long").alias("chunk")
    none = F.lit(None).cast(traced.select(piece).schema["piece"].dataType).alias("piece")
    all_ = (
        convs.select("conv").distinct().select("conv", F.lit(0).alias("kind"), no_chunk, none, no_turn, *empty)
        .unionByName(traced.select("conv", F.lit(1).alias("kind"), "chunk", piece, no_turn, *empty))
        .unionByName(rows.select("conv", F.lit(2).alias("kind"), no_chunk, none, "turn", "role", "text", _digest()))
    )
    order = ["conv", "kind", "chunk", "turn", "role", "digest"]
    return all_.repartition("conv").sortWithinPartitions(*order).select("conv", "kind", "piece", "role", "text")


def _arrow_type(df: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema["conv"].dataType)


def repair(rows: DataFrame, convs: DataFrame | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation of `rows` and `convs`: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `rows` has conv, turn, role and text, as `plain` gives them, and `convs` conv. Rows are in
    order of turn, nulls first, then of role and of the SHA-256 of the text; rows repeated as a
    whole are neighbours. A null conv is a conversation. Very long texts and conversations
    pass by in a stream; only a conversation's audit, a letter or a few per row, is held. As
    SHA-256 runs through all of a conversation's text, that is done by one task for each. A
    conversation without rows has zeros, an empty audit and the digest of no text; empty
    tables give an empty result. Roles count by their first letter; one that is not s, u
    or a can't be kept.
    """
    conv, type_ = rows.schema["conv"].dataType.simpleString(), _arrow_type(rows)
    schema = f"conv {conv}, {', '.join(f'{n} long' for n in _DIGEST_NAMES)}, audit string, repaired_sha256 string"
    with Scratch(rows.sparkSession) as steps:
        stream = _stream(rows, rows if convs is None else convs, steps, chunk)
        return written(stream.mapInArrow(lambda batches: _streamed(batches, lambda: _Digests(type_)), schema), "repaired")


def repaired_rows(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of all conversations after repair: conv, number (from 0), edit, role and text.

    edit is K (kept), R (new role), I (new, empty text) or D: deleted, with its text and no
    number. The rest is as in `repair`.
    """
    conv, type_ = rows.schema["conv"].dataType.simpleString(), _arrow_type(rows)
    with Scratch(rows.sparkSession) as steps:
        stream = _stream(rows, rows, steps, chunk)
        out = stream.mapInArrow(lambda batches: _streamed(batches, lambda: _Rows(type_)), f"conv {conv}, number long, edit string, role string, text string")
        return written(out, "repaired-rows")
