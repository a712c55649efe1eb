"""Quality classifier from weak labels.

1. Heuristic labellers vote good, bad or nothing on every document.
2. Documents are counted by their pattern of votes; expectation-maximisation over the counts
   estimates how often each labeller gives each vote for good and for bad documents, and
   with it the posterior of every pattern. No labelled data is used.
3. Posteriors of a bounded sample of documents train a linear scorer over hashed features
   (trigrams of character classes, words repeated at short distances).
4. The scorer rates every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftrail.llm.hashing import Words, mix

#: Documents that train the scorer, about.
SAMPLE = 3000
#: Hashed features of trigrams; the repeats come after them.
TRIGRAMS, REPEATS = 1024, 16
WIDTH = TRIGRAMS + REPEATS + 1

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _FOREIGN, _MARK = 1, 2, 3, 4, 5, 6, 7
_CLASS = np.zeros(256, np.int64)
_CLASS[33:127] = np.arange(_MARK, _MARK + 94)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = _LOWER, _UPPER, _DIGIT
_CLASS[[32, 9]], _CLASS[[10, 13]], _CLASS[128:] = _SPACE, _LINE, _FOREIGN
_RUNS = np.zeros(128, bool)
_RUNS[[_LOWER, _UPPER, _DIGIT, _FOREIGN]] = True


@dataclass(frozen=True)
class Labeller:
    """Votes bad (0) from `bad` on, good (2) up to `good`, else nothing (1), on one measure."""

    measure: str
    good: float
    bad: float


LABELLERS = (
    Labeller("symbols", 0.06, 0.10),
    Labeller("upper", 0.15, 0.30),
    Labeller("marked_ends", 0.02, 0.15),
    Labeller("repeated_word", 0.05, 0.20),
    Labeller("near_repeats", 0.35, 0.60),
    Labeller("lone_marks", 0.03, 0.12),
    Labeller("long_words", 0.10, 0.40),
    Labeller("digits", 0.10, 0.30),
)

#: Shares of fewer words than this say nothing.
LEAST_WORDS = 8


class Texts:
    """Character classes and words of a text column, and what is measured on them."""

    def __init__(self, column):
        self.words = words = Words(column)
        self.data, self.bounds, self.n = words.data, words.bounds, len(words.counts)
        self.kind = _CLASS[self.data]
        self.row_of_word = words.rows()

    def _per_row(self, flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def _per_word(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.row_of_word, flags, self.n)

    def _same_as(self, back: int) -> np.ndarray:
        """Words equal to the one `back` places before them in their text."""
        h, same = self.words.hashes, np.zeros(len(self.words), bool)
        same[back:] = (h[back:] == h[:-back]) & (self.row_of_word[back:] == self.row_of_word[:-back])
        return same

    def repeats(self) -> list[np.ndarray]:
        return [self._same_as(k) for k in range(1, REPEATS + 1)]

    def measures(self) -> dict[str, np.ndarray]:
        kind, words, first, last = self.kind, self.words, self.words.starts, self.words.ends - 1
        mark, upper = kind >= _MARK, self._per_row(kind == _UPPER)
        ink = np.maximum(self._per_row((kind != _SPACE) & (kind != _LINE)), 1)
        letters = np.maximum(self._per_row((kind == _LOWER) | (kind == _FOREIGN)) + upper, 1)
        n_words = np.maximum(words.counts, 1)
        repeats = self.repeats()
        before = np.maximum(last - 1, 0)
        return {
            "symbols": self._per_row(mark) / ink,
            "upper": upper / letters,
            "marked_ends": self._per_word(mark[last] & mark[before] & (last > first)) / n_words,
            "repeated_word": self._per_word(repeats[0]) / n_words,
            "near_repeats": self._per_word(np.logical_or.reduce(repeats)) / n_words,
            "lone_marks": self._per_word((last == first) & mark[last]) / n_words,
            "long_words": self._per_word(last - first >= 24) / n_words,
            "digits": self._per_row(kind == _DIGIT) / ink,
        }

    def votes(self) -> np.ndarray:
        """A vote of each labeller for each row; a text of very few words gets none (1)."""
        measures = self.measures()
        out = np.ones((self.n, len(LABELLERS)), np.int64)
        for j, labeller in enumerate(LABELLERS):
            x = measures[labeller.measure]
            out[x <= labeller.good, j] = 2
            out[x >= labeller.bad, j] = 0
        out[self.words.counts < LEAST_WORDS] = 1
        return out

    def features(self) -> np.ndarray:
        """Square roots of frequencies: trigrams of class runs, and repeated words by distance."""
        kind, rows = self.kind, np.repeat(np.arange(self.n), np.diff(self.bounds))
        fresh = np.ones(len(kind), bool)
        fresh[1:] = (kind[1:] != kind[:-1]) | ~_RUNS[kind[1:]] | (rows[1:] != rows[:-1])
        kind, rows = kind[fresh], rows[fresh]
        out = np.zeros((self.n, WIDTH), np.float32)
        out[:, -1] = 1
        if len(kind) > 2:
            grams = (kind[:-2] * 128 + kind[1:-1]) * 128 + kind[2:]
            whole = rows[:-2] == rows[2:]
            places = (mix(grams[whole].astype(np.uint64)) % np.uint64(TRIGRAMS)).astype(np.int64)
            counts = np.bincount(rows[:-2][whole] * TRIGRAMS + places, minlength=self.n * TRIGRAMS).reshape(self.n, TRIGRAMS)
            out[:, :TRIGRAMS] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
        for k, same in enumerate(self.repeats()):
            out[:, TRIGRAMS + k] = np.sqrt(self._per_word(same) / np.maximum(self.words.counts, 1))
        return out


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good per pattern, P(vote | class) as [class, labeller, vote], and P(good).

    Starts from the share of good votes. Each estimate has one more of each vote, so no
    probability is zero.
    """
    votes = np.eye(3)[patterns]  # pattern, labeller, vote
    votes[:, :, 1] = 0  # no vote is no evidence
    good, bad = votes[:, :, 2].sum(1), votes[:, :, 0].sum(1)
    posterior = (good + 1) / (good + bad * 3 + 2)  # one bad vote outweighs some good ones
    for _ in range(rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        table = np.einsum("cp,pjv->cjv", weight, votes) + 1
        table /= table.sum(2, keepdims=True)
        prior = (weight[1].sum() + 1) / (weight.sum() + 2)
        log = np.einsum("pjv,cjv->cp", votes, np.log(table)) + np.log([[1 - prior], [prior]])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        done = np.abs(new - posterior).max() < 1e-9
        posterior = new
        if done:
            break
    return posterior, table, float(prior)


def train_linear(features: np.ndarray, target: np.ndarray, rounds: int = 300, rate: float = 0.5, decay: float = 1e-5) -> np.ndarray:
    """Logistic regression on soft targets by full-batch Adam."""
    weight, m, v = (np.zeros(features.shape[1]) for _ in range(3))
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(features @ weight.astype(np.float32), -50, 50)))
        gradient = (p - target).astype(np.float32) @ features / len(target) + decay * weight
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        weight -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return weight


@dataclass(frozen=True)
class Quality:
    weight: np.ndarray
    #: P(vote | class) as [class, labeller, vote] and P(good), for reports.
    table: np.ndarray
    prior: float

    def scores(self, texts: Texts) -> np.ndarray:
        """P(good); a text without words has that of a document nothing is known about."""
        p = 1 / (1 + np.exp(-np.clip(texts.features() @ self.weight, -50, 50)))
        return np.where(texts.words.counts == 0, self.prior, p)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Quality:
    """Votes of all documents, and a scorer trained on about `sample` of them.

    The driver receives one row per pattern of votes (at most 3 ** 8) and the features of
    the sample, drawn by a hash of the id and the text's length.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                found, n = np.unique(Texts(batch.column(0).slice(lo, 512)).votes(), axis=0, return_counts=True)
                for pattern, k in zip(map(bytes, found.astype(np.uint8)), n):
                    total[pattern] = total.get(pattern, 0) + int(k)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], names=["pattern", "n"])

    counted = docs.select("text").mapInArrow(count, "pattern binary, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    patterns = np.array([list(r.pattern) for r in counted], np.int64).reshape(-1, len(LABELLERS))
    counts = np.array([r.n for r in counted], float)
    if not len(counts):
        return Quality(np.zeros(WIDTH), np.full((2, len(LABELLERS), 3), 1 / 3), 0.5)
    posterior, table, prior = expectation_maximisation(patterns, counts)
    known = {bytes(p.astype(np.uint8)): float(q) for p, q in zip(patterns, posterior)}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                texts = Texts(batch.column(0).slice(lo, 512))
                used = np.flatnonzero(texts.words.counts)
                targets = [known[bytes(v)] for v in texts.votes()[used].astype(np.uint8)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.astype("<f2").tobytes() for x in texts.features()[used]], pa.binary()), pa.array(targets, pa.float64())], names=["x", "y"]
                )

    share = min(1.0, sample / counts.sum())
    chance = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = docs.where(chance).select("text").mapInArrow(draw, "x binary, y double").collect()
    if not rows:
        return Quality(np.zeros(WIDTH), table, prior)
    features = np.stack([np.frombuffer(r.x, "<f2") for r in rows]).astype(np.float32)
    return Quality(train_linear(features, np.array([r.y for r in rows])), table, prior)


def score(docs: DataFrame, model: Quality, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (of being good, 0 to 1) and accepted (score >= threshold) of every row.

    Null and blank texts have the share of good documents as score. Ids may be null or
    repeat; other columns are ignored, whatever their names; an empty table gives an empty
    result; texts are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                p = model.scores(Texts(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64()), pa.array(p >= threshold)], names=["doc_id", "score", "accepted"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, score double, accepted boolean")


def accepted(docs: DataFrame, model: Quality, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that the model accepts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                yield part.filter(pa.array(model.scores(Texts(part.column(place))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
