"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads each word (or piece of a long one) byte by byte from both ends, labels
every position with a probability per language, and a document's probability is the mean
over all its positions. It is written and trained in numpy, by backpropagation through
time, on the driver, from a bounded sample of words.

As the state starts afresh at each word, equal words get equal labels: a task runs the
network once for each distinct word it meets in a batch and counts the occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelftrail.llm.hashing import Words, group_starts

#: Bytes of a word that are read together, and states per direction.
LONGEST, STATES = 24, 16
#: Training sample: documents per language (about) and words of each.
SAMPLE_DOCS, SAMPLE_WORDS = 250, 48
#: Distinct words whose labels a Python worker keeps.
TABLE = 1_000_000
_KNOWN: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Gru:
    """One direction. inputs: byte -> update, reset and candidate; state: the same from the state."""

    def __init__(self, states: int, random: np.random.Generator):
        self.states = states
        self.inputs = random.normal(0, 0.3, (256, 3 * states)).astype(np.float32)
        self.state = random.normal(0, states**-0.5, (states, 3 * states)).astype(np.float32)

    def forward(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each byte of x (words, length) as (length, words, states), and what backward needs."""
        h, n = np.zeros((len(x), self.states), np.float32), self.states
        out, tape = np.empty((x.shape[1], len(x), n), np.float32), []
        for t in range(x.shape[1]):
            given = self.inputs[x[:, t]]
            gates = _sigmoid(given[:, : 2 * n] + h @ self.state[:, : 2 * n])
            update, reset = gates[:, :n], gates[:, n:]
            candidate = np.tanh(given[:, 2 * n :] + (reset * h) @ self.state[:, 2 * n :])
            if keep:
                tape.append((h, update, reset, candidate))
            h = h + update * (candidate - h)
            out[t] = h
        return out, tape

    def backward(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of inputs and state, given those of the states, through all steps."""
        n, d_inputs, d_state = self.states, np.zeros_like(self.inputs), np.zeros_like(self.state)
        d_h = np.zeros((len(x), n), np.float32)
        for t in reversed(range(x.shape[1])):
            h, update, reset, candidate = tape[t]
            d_h = d_h + d_out[t]
            d_candidate = d_h * update * (1 - candidate**2)
            d_update = d_h * (candidate - h) * update * (1 - update)
            d_kept = d_candidate @ self.state[:, 2 * n :].T
            d_reset = d_kept * h * reset * (1 - reset)
            d_gates = np.concatenate((d_update, d_reset), 1)
            d_state[:, : 2 * n] += h.T @ d_gates
            d_state[:, 2 * n :] += (reset * h).T @ d_candidate
            np.add.at(d_inputs, x[:, t], np.concatenate((d_gates, d_candidate), 1))
            d_h = d_h * (1 - update) + d_kept * reset + d_gates @ self.state[:, : 2 * n].T
        return d_inputs, d_state


class Network:
    """Both directions and the labels of each position."""

    def __init__(self, labels: int, states: int = STATES, seed: int = 5):
        random = np.random.default_rng(seed)
        self.ahead, self.back = Gru(states, random), Gru(states, random)
        self.out = random.normal(0, 0.1, (2 * states + 1, labels)).astype(np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.state, self.back.inputs, self.back.state, self.out]

    def _labels(self, ahead: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        states = np.concatenate((ahead, back[::-1], np.ones((*ahead.shape[:2], 1), np.float32)), 2)
        logits = states @ self.out
        p = np.exp(logits - logits.max(2, keepdims=True))
        return states, p / p.sum(2, keepdims=True)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """P(label) of each position of words of one length: (length, words, labels)."""
        return self._labels(self.ahead.forward(x)[0], self.back.forward(x[:, ::-1])[0])[1]

    def gradients(self, x: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradient for each parameter."""
        (ahead, tape_a), (back, tape_b) = self.ahead.forward(x, True), self.back.forward(x[:, ::-1], True)
        states, p = self._labels(ahead, back)
        count, n = p.shape[0] * p.shape[1], self.ahead.states
        loss = float(-np.log(p[:, np.arange(len(label)), label] + 1e-12).mean())
        p[:, np.arange(len(label)), label] -= 1
        p /= count
        d_out = np.einsum("tws,twl->sl", states, p)
        d_states = p @ self.out.T
        return loss, [
            *self.ahead.backward(x, tape_a, d_states[:, :, :n]),
            *self.back.backward(x[:, ::-1], tape_b, d_states[::-1, :, n : 2 * n]),
            d_out,
        ]


def train(words: list[bytes], labels: np.ndarray, n_labels: int, epochs: int = 3, batch: int = 128, rate: float = 0.01) -> Network:
    """Adam over batches of words of equal length, in an order fixed by a seed."""
    network, random = Network(n_labels), np.random.default_rng(6)
    lengths = np.array([len(w) for w in words], np.int64)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    step = 0
    for _ in range(epochs):
        batches = []
        for length in np.unique(lengths):
            at = random.permutation(np.flatnonzero(lengths == length))
            batches += [at[i : i + batch] for i in range(0, len(at), batch)]
        for k in random.permutation(len(batches)):
            at, step = batches[k], step + 1
            x = np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(len(at), -1)
            _, gradients = network.gradients(x, labels[at])
            for p, g, (m, v) in zip(network.parameters(), gradients, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    network: Network

    def _looked_up(self, names: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """word_labels, kept by name (ascending hashes) for later batches of this Python worker."""
        token = hash((*self.labels, *(p.tobytes() for p in self.network.parameters())))
        if token not in _KNOWN or len(_KNOWN[token][0]) > TABLE:
            _KNOWN.clear()
            _KNOWN[token] = np.zeros(0, np.uint64), np.zeros((0, len(self.labels)), np.float32)
        known, values = _KNOWN[token]
        place = np.searchsorted(known, names)
        old = place < len(known)
        old[old] = known[place[old]] == names[old]
        out = np.empty((len(names), len(self.labels)), np.float32)
        out[old] = values[place[old]]
        out[~old] = self.word_labels(data, starts[~old], lengths[~old])
        _KNOWN[token] = np.insert(known, place[~old], names[~old]), np.insert(values, place[~old], out[~old], axis=0)
        return out

    def word_labels(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sum of the positions' probabilities for each word."""
        out = np.zeros((len(starts), len(self.labels)), np.float32)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            for lo in range(0, len(at), 4096):
                part = at[lo : lo + 4096]
                out[part] = self.network.positions(data[starts[part][:, None] + np.arange(length)]).sum(0)
        return out

    def documents(self, column) -> np.ndarray:
        """Mean of the positions' probabilities for each text; zeros where there is no word."""
        words = Words(column, longest=LONGEST)
        if not len(words):
            return np.zeros((len(words.counts), len(self.labels)))
        order = np.argsort(words.hashes, kind="stable")
        first = group_starts(words.hashes[order])
        heads = order[first]
        distinct = self._looked_up(words.hashes[heads], words.data, words.starts[heads], (words.ends - words.starts)[heads])
        which = np.empty(len(words), np.int64)
        which[order] = np.repeat(np.arange(len(first)), np.diff([*first, len(order)]))
        total = np.concatenate((np.zeros((1, len(self.labels))), np.cumsum(distinct[which], 0, dtype=np.float64)))
        total = total[words.offsets[1:]] - total[words.offsets[:-1]]
        length = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
        length = length[words.offsets[1:]] - length[words.offsets[:-1]]
        return np.clip(total / np.maximum(length, 1)[:, None], 0, 1)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", docs_per_label: int = SAMPLE_DOCS) -> LanguageModel | None:
    """A network trained on words of about docs_per_label documents of each label, SAMPLE_WORDS of each.

    Documents are drawn by a hash of their id, words by a hash over the whole text. Rows
    without label or text don't count; None if there are no others.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"), F.col(label_col).cast("string").alias("label"))
    rows = rows.where("label is not null and text is not null")
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    labels = sorted(counts)
    share = F.create_map(*[F.lit(x) for label in labels for x in (label, min(1.0, docs_per_label / counts[label]))])
    drawn = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit("")), F.length("text")), F.lit(1 << 30)) < share[F.col("label")] * float(1 << 30)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                found, out = Words(part.column(0), longest=LONGEST), []
                for a, b in zip(found.offsets, found.offsets[1:]):
                    chosen = a + np.argsort(found.hashes[a:b], kind="stable")[: 4 * SAMPLE_WORDS]
                    chosen = chosen[group_starts(found.hashes[chosen])][:SAMPLE_WORDS] if b > a else []
                    out.append([found.data[found.starts[i] : found.ends[i]].tobytes() for i in chosen])
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(out, pa.list_(pa.binary()))], names=["label", "words"])

    sample = rows.where(drawn).select("text", "label").mapInArrow(words, "label string, words array<binary>").collect()
    pairs = sorted((bytes(w), labels.index(r.label)) for r in sample for w in r.words)
    if not pairs:
        return None
    return LanguageModel(labels, train([w for w, _ in pairs], np.array([k for _, k in pairs]), len(labels)))


def predict(docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row.

    lang_pred is the label of the largest mean probability over all positions of the text
    (the alphabetically first of equals), score that probability. Null texts, texts without a
    letter, and all texts where there is no model are `und` with score 0. Ids may be null or
    repeat; other columns are ignored, whatever their names; an empty table gives an empty
    result; texts are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                column = part.column(1)
                letters = [t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()]
                names, scores = ["und"] * len(letters), [0.0] * len(letters)
                if model:
                    p = model.documents(column)
                    for i in np.flatnonzero(letters):
                        k = int(p[i].argmax())
                        names[i], scores[i] = model.labels[k], float(p[i, k])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(id_col: str = "doc_id", folds: int = 4) -> Column:
    """crc32 of the id as text, modulo `folds`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
