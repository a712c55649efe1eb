"""Secret scans: patterns, and character Markov models of random strings and ordinary identifiers.

Training reads all documents once. The values that the patterns find are the samples
labelled random; every other run of identifier characters is labelled ordinary. Tasks count
character transitions of both, a few thousand counts at most, and the sums make two
first-order models. A run of any length is a secret if its log-likelihood ratio, summed and per
character, is high enough. So the model learns what ordinary identifiers look like in the corpus at hand.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrail.llm.hashing import text_buffer

#: The kinds of spans, in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

#: Characters of identifiers; code 0 is everything else.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_SIZE = len(ALPHABET) + 1
_CODE = np.zeros(256, np.int64)
_CODE[list(ALPHABET.encode())] = np.arange(1, _SIZE)

_SCHEMA = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))])


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, leftmost and not overlapping within a kind."""
    out = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    # A run is taken whole, so asking for the least length in the pattern drops the same matches.
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


def _values(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    """The secret part of each span, one of overlapping ones."""
    out, reach = [], -1
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        value = _ASSIGN.fullmatch(text, start, end).group(2) if kind == "assign" else text[start:end]
        if end > reach:
            out.append(value)
            reach = end
    return out


def _transitions(data: np.ndarray) -> np.ndarray:
    """Counts of adjacent codes, flattened; the data is taken to stand between other characters."""
    codes = np.concatenate(([0], _CODE[data], [0]))
    return np.bincount(codes[:-1] * _SIZE + codes[1:], minlength=_SIZE * _SIZE)


@dataclass(frozen=True)
class RandomStrings:
    """Scores runs of identifier characters; `ratio` has log P(random) - log P(ordinary) per transition.

    A run of any length looks random if its ratios sum up to `evidence` and their mean is
    `threshold` at least. The sum is what the whole run says: at 20 an ordinary run would pass once in
    e**20, about half a billion, were the ordinary model right. The mean keeps long runs out that
    gather it little by little.
    """

    ratio: np.ndarray
    evidence: float = 20.0
    threshold: float = 1.0

    @classmethod
    def fitted(cls, random: np.ndarray, ordinary: np.ndarray, **limits) -> RandomStrings:
        """From transition counts. Without samples, random strings are uniform."""
        def log(counts: np.ndarray) -> np.ndarray:
            counts = counts.reshape(_SIZE, _SIZE).astype(float)[:, 1:]
            # Prior: a letter as often as in all samples, and one of each besides.
            share = (counts.sum(0) + 1) / (counts.sum() + _SIZE - 1)
            return np.log((counts + share * (_SIZE - 1)) / (counts.sum(1, keepdims=True) + _SIZE - 1))

        uniform = np.zeros((_SIZE, _SIZE))
        uniform[:, 1:] = 1  # strings of any letters are random too, whatever the samples hold
        return cls(log(random + uniform.ravel() * max(1.0, random.sum() / _SIZE**2)) - log(ordinary), **limits)

    def score(self, run: str) -> float:
        """Mean log-likelihood ratio per character."""
        codes = _CODE[np.frombuffer(run.encode(), np.uint8)]
        return float(self.ratio[np.concatenate(([0], codes[:-1])), codes - 1].mean())

    def runs(self, texts: pa.Array) -> list[list[tuple[int, int]]]:
        """Per text, (start, end) in code points of the runs that look random."""
        data, bounds = text_buffer(texts)
        out = [[] for _ in range(len(texts))]
        codes = _CODE[data]
        inside, cut = codes > 0, np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        first = inside & (cut[:-1] | np.concatenate(([True], ~inside))[:-1])
        starts = np.flatnonzero(first)
        if not len(starts):
            return out
        ends = np.flatnonzero(inside & (cut[1:] | np.concatenate((~inside, [True]))[1:])) + 1
        before = np.where(first, 0, np.concatenate(([0], codes))[:-1])
        gain = np.where(inside, self.ratio[before, codes - 1], 0.0)
        total = np.add.reduceat(gain, starts)
        good = (total >= self.evidence) & (total >= self.threshold * (ends - starts))
        starts, ends = starts[good], ends[good]
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        rows = np.searchsorted(bounds, starts, "right") - 1
        for row, start, end in zip(rows.tolist(), (points[starts] - points[bounds[rows]]).tolist(), (points[ends] - points[bounds[rows]]).tolist()):
            out[row].append((start, end))
        return out


def spans(texts: pa.Array, model: RandomStrings) -> list[list[tuple[str, int, int]]]:
    """Per text, the patterns' spans and the random runs that don't lie within those; a run that overlaps one is given whole."""
    out = []
    for text, runs in zip(texts.to_pylist(), model.runs(texts)):
        found = pattern_spans(text or "")
        known = sorted(s[1:] for s in found)
        for lo, hi in runs:
            at = lo
            for start, end in known:
                if start <= at:
                    at = max(at, end)
            if at < hi:
                found.append(("random", lo, hi))
        out.append(sorted(found, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def fit(docs: DataFrame, text_col: str = "text", **limits) -> RandomStrings:
    """Models from every text of `docs`; a table of sums of at most 2 * 67 * 67 rows reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random, every = (np.zeros(_SIZE * _SIZE, np.int64) for _ in range(2))
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                column = batch.column(0).slice(lo, 512)
                data, bounds = text_buffer(column)
                every += _transitions(data)
                cut = bounds[(bounds > 0) & (bounds < len(data))]  # no transition from text to text
                cut = np.unique(cut)
                codes = _CODE[data]
                np.subtract.at(every, codes[cut - 1] * _SIZE + codes[cut], 1)
                np.add.at(every, codes[cut - 1] * _SIZE, 1)
                np.add.at(every, codes[cut], 1)
                for text in column.to_pylist():
                    for value in _values(text, pattern_spans(text)) if text else ():
                        random += _transitions(np.frombuffer(value.encode(), np.uint8))
        at = np.flatnonzero(every)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), pa.array(every[at], pa.int64()), pa.array(random[at], pa.int64())], names=["pair", "every", "random"]
        )

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "pair long, every long, random long")
    every, random = (np.zeros(_SIZE * _SIZE) for _ in range(2))
    for pair, e, r in counted.groupBy("pair").agg(F.sum("every"), F.sum("random")).collect():
        every[pair], random[pair] = e, r
    return RandomStrings.fitted(random, np.maximum(every - random, 0), **limits)


def scan(docs: DataFrame, model: RandomStrings, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """doc_id and found, an array of (kind, start, end) in code points, for every row (and key, of key_col).

    Kinds assign, access and hex are the patterns', random the model's. Spans are in order
    of start, then of kind. Null and empty texts have none. Ids may be null or repeat; other
    columns are ignored, whatever their names; an empty table gives an empty result; texts
    are scanned whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = [[{"kind": k, "start": s, "end": e} for k, s, e in found] for found in spans(part.column(2), model)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(rows, _SCHEMA.field("found").type)], schema=_SCHEMA)

    key = F.col(key_col) if key_col else F.lit(None)
    docs = docs.select(key.cast("string").alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = docs.mapInArrow(run, "key string, doc_id long, found array<struct<kind string, start long, end long>>")
    return out if key_col else out.drop("key")


def redact(text: str | None, found: list[tuple[int, int]], mark: str = "[SECRET]") -> str | None:
    """`text` with each maximal union of the spans found replaced by `mark`."""
    out, at = [], 0
    for start, end in sorted(found):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return text if not out else "".join(out) + text[at:]


def redacted(docs: DataFrame, model: RandomStrings, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """`docs`, same columns and rows, with secrets replaced by a mark; length_col follows if there is one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            texts = []
            for lo in range(0, batch.num_rows, 512):
                part = batch.column(place).slice(lo, 512)
                texts += [redact(text, [s[1:] for s in found]) for text, found in zip(part.to_pylist(), spans(part, model))]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    out = docs.mapInArrow(run, docs.schema)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out
