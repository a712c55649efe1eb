"""Substring dedup by fixed-block anchors.

Half-window blocks at fixed places of every document are the index; every rolling window
of the same length probes it. Any repeat of a whole window holds an indexed block, so each
repeat has a hit. Around a hit the match is extended to both sides, window by window, and
overlapping matched windows join to maximal exact repeats.

Documents are dealt out once (one shuffle of the text, used by three passes):
1. block and rolling hashes -> which of them are shared between documents (packed),
2. window hashes around shared blocks -> the smallest document of each (packed),
3. windows that an earlier document holds -> spans to remove.
No pair of documents is ever formed, so groups of copies cost what their text costs.
Windows are identified by 64-bit hashes within a bucket of the hash space.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelftrail.llm import parts as P
from shelftrail.llm.hashing import Words, group_starts, mix

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<array<long>>"


class _Part:
    """Keys of one part's documents."""

    def __init__(self, table: pa.Table, window: int):
        table = P.unpacked(table)
        ids = table["doc_id"]
        self.table, self.known = table, ~ids.is_null().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()
        self.words = Words(table["text"])
        self.window, self.block = window, (window + 1) // 2
        self.row = self.words.rows()
        self.room = np.where(self.known[self.row], self.words.room(), 0)
        self.hashes = self.words.windows(self.block)
        at = np.flatnonzero(self.room >= self.block)
        self.order = at[np.argsort(self.hashes[at], kind="stable")]
        ordered = self.hashes[self.order]
        self.first = group_starts(ordered)
        self.keys = ordered[self.first]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """For each key: in several documents; at a block boundary of one."""
        if not len(self.keys):
            return np.zeros(0, bool), np.zeros(0, bool)
        ids = self.ids[self.row[self.order]]
        several = np.minimum.reduceat(ids, self.first) != np.maximum.reduceat(ids, self.first)
        place = self.order - self.words.offsets[:-1][self.row[self.order]]
        return several, np.logical_or.reduceat(place % self.block == 0, self.first)

    def extend(self, shared: np.ndarray) -> None:
        """Whole windows around the hits, with the smallest document of this part for each."""
        sizes = np.diff([*self.first, len(self.order)])
        hits = self.order[np.repeat(shared, sizes)]
        n = len(self.words) + 1
        near = np.bincount(np.maximum(hits - (self.window - self.block), 0), minlength=n) - np.bincount(hits + 1, minlength=n)
        at = np.flatnonzero((np.cumsum(near[:-1]) > 0) & (self.room >= self.window))
        second = at + self.window - self.block
        names = mix(self.hashes[at] * np.uint64(0x9E3779B97F4A7C15) + mix(self.hashes[second]))
        order = np.argsort(names, kind="stable")
        self.at, names = at[order], names[order]
        first = group_starts(names)
        self.names, self.owner_of = names[first], self.ids[self.row[self.at]]
        self.least = np.minimum.reduceat(self.owner_of, first) if len(first) else np.zeros(0, np.int64)
        self.sizes = np.diff([*first, len(names)])

    def removed(self, earlier: np.ndarray) -> np.ndarray:
        """A flag per word: a window with an earlier holder covers it."""
        gone = np.repeat(earlier, self.sizes) | (self.owner_of > np.repeat(self.least, self.sizes))
        n, at = len(self.words) + 1, self.at[gone]
        cover = np.bincount(at, minlength=n) - np.bincount(at + self.window, minlength=n)
        return np.cumsum(cover[:-1]) > 0


def _result(part: _Part, gone: np.ndarray) -> pa.Table:
    words, bounds, data = part.words, part.words.bounds, part.words.data
    raw = data.tobytes()
    edges = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
    # A removed run that crosses from one document to the next is cut there.
    run_starts, run_ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    n_gone = np.add.reduceat(np.concatenate((gone, [False])).astype(np.int64), words.offsets[:-1]) * (words.counts > 0) if len(words.counts) else []
    digests, spans = [], []
    for i, (a, b) in enumerate(zip(words.offsets, words.offsets[1:])):
        found = raw[bounds[i] : bounds[i + 1]].split()
        mine = []
        if n_gone[i]:
            lo, hi = np.searchsorted(run_ends, a, "right"), np.searchsorted(run_starts, b, "left")
            mine = [[int(max(s, a) - a), int(min(e, b) - a)] for s, e in zip(run_starts[lo:hi], run_ends[lo:hi])]
            for s, e in reversed(mine):
                del found[s:e]
        digests.append(sha256(b" ".join(found)).hexdigest())
        spans.append(mine)
    return pa.table(
        [part.table["doc_id"], pa.array(words.counts, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(digests, pa.string()),
         pa.array(spans, pa.list_(pa.list_(pa.int64())))],
        ["doc_id", "n_words", "n_removed", "kept_sha256", "spans"],
    )


def remove_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Words of every document that repeat `window` or more words of a document with a smaller id.

    Returns one row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by a space) and spans ([start, end) in words, the maximal removed repeats).

    Null or empty text has no words and an empty remainder. A row without an id is returned
    with nothing removed and is no reference for others. Rows with equal ids are not
    references for each other. Other columns of `docs` are ignored, whatever their names; an
    empty table gives an empty result. Texts are read whole at any length.
    """
    if window < 2:
        raise ValueError("window must be 2 or more")
    dealt, buckets = P.dealt(docs, id_col, text_col)
    by_part = dealt.groupBy("part")

    def probe(key, table):
        part = _Part(table, window)
        return P.payload(key[0].as_py(), part.keys, buckets, part.anchors())

    def windows(key, table, answers):
        part = _Part(table, window)
        part.extend(P.answered(answers, 1, part.keys, buckets))
        return P.payload(key[0].as_py(), part.names, buckets, owners=part.least, wide=True)

    def cut(table, answers):
        part = _Part(table, window)
        part.extend(P.answered(answers, 1, part.keys, buckets))
        return _result(part, part.removed(P.answered(answers, 2, part.names, buckets)))

    hits = by_part.applyInArrow(probe, P.PAYLOAD).groupBy("bucket").applyInArrow(lambda t: P.shared_keys(t, 1), P.ANSWER)
    owners = (
        by_part.cogroup(hits.groupBy("part")).applyInArrow(windows, P.PAYLOAD)
        .groupBy("bucket").applyInArrow(lambda t: P.earlier_owner(t, 2), P.ANSWER)
    )
    return by_part.cogroup(hits.unionByName(owners).groupBy("part")).applyInArrow(cut, RESULT)
