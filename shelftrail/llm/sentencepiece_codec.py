"""SentencePiece encoding and decoding with a table of distinct marked words.

The library marks white space and puts a mark in front of the text. Where no piece of the
vocabulary has a mark behind another character, no merge crosses from one marked word to
the next, so a text's ids are those of its marked words in order. Each distinct marked word
is segmented once and looked up afterwards; the table lives as long as the Python worker
and starts afresh when it is full, so memory is bounded and results don't depend on it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Words in the table, and the longest word that is kept there.
TABLE, LONGEST = 400_000, 128

_MARKED = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_CODECS: dict[str, Codec] = {}
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def marks_lead(model: sentencepiece.SentencePieceProcessor) -> bool:
    """No piece crosses from a word to the mark of the next, and texts are taken as they are."""
    crossing = re.compile(f"[^{MARK}]{MARK}")
    probe = "  a  b\tc ﬁ é Ａ\n "
    return (
        model.piece_to_id(MARK) != model.unk_id()
        and not any(crossing.search(model.id_to_piece(i)) for i in range(model.vocab_size()))
        and model.normalize(probe) == MARK + probe.replace(" ", MARK)
    )


class Codec:
    """One model in one Python worker."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_word = marks_lead(self.model)
        self.table: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> Codec:
        if path not in _CODECS:
            _CODECS[path] = cls(path)
        return _CODECS[path]

    def _segment(self, words: list[str]) -> list[bytes]:
        # The library adds the first mark itself, but not to nothing: a mark alone is a piece.
        alone = [self.model.piece_to_id(MARK)]
        found = self.model.encode([w[1:] for w in words], num_threads=1)
        return [np.array(alone if w == MARK else ids, "<u4").tobytes() for w, ids in zip(words, found)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers, without begin and end."""
        if not self.by_word:
            return [np.array(ids, "<u4").tobytes() for ids in self.model.encode(texts, num_threads=1)]
        split = []
        for text in texts:
            plain = "  " not in text and MARK not in text and text[:1] != " " and text[-1:] != " "
            if not text:
                split.append([])
            elif plain:
                split.append([MARK + w for w in text.split(" ")])
            else:
                split.append(_MARKED.findall(MARK + text.replace(" ", MARK)))
        if len(self.table) > TABLE:
            self.table.clear()
        new = list({w for words in split for w in words if w not in self.table})
        self.table.update(zip(new, self._segment(new)))
        out = [b"".join(map(self.table.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > LONGEST:
                del self.table[word]
        return out

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.model.decode([np.frombuffer(x, "<u4").tolist() for x in ids]) if ids else []


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary, little-endian 32-bit, with begin and end) and decoded for every row.

    `model` is the path of a SentencePiece model that every executor can read. ids equal
    the library's for the whole text; decoded is the library's decode(ids). Null text counts
    as empty and gives begin and end only. Ids may be null or repeat; other columns are
    ignored, whatever their names; an empty table gives an empty result. A model whose
    pieces cross marks, or which rewrites texts, is applied to whole texts instead.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        begin, end = (np.array([i], "<u4").tobytes() for i in (codec.model.bos_id(), codec.model.eos_id()))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [begin + x + end for x in codec.encode(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(codec.decode(ids), pa.string())], schema=_SCHEMA
                )

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(run, "doc_id long, ids binary, decoded string")
