"""Token-id files of independent zstandard frames with a trailing seek table.

A file is a valid zstandard stream:

    frame per document   its ids, little-endian, with zstandard's own content checksum
    skippable frame 0    index: bytes per id (1 byte), rows (8), then a flag per row that
                         its id is known (1 each) and the document ids (8 each)
    skippable frame 14   seek table of the zstandard seekable format: compressed size,
                         plain size and checksum (low half of XXH64) of each frame, 4 bytes
                         each; then the number of frames (4), a descriptor (1), a magic (4)

A reader takes the two tables from the end of the file and decompresses only the frames of
the documents it was asked for.

Encoding uses a table of distinct runs: the tokenizer lowers texts, drops white space and
cuts the rest into runs before merging, so ids of a text are those of its runs in order. Texts
of plain characters are cut together, as arrays, and each run that occurs among them is looked
up once. The table lives as long as the Python worker and starts afresh when it is full.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelftrail import session
from shelftrail.llm.tables import written

#: Fixed values of the zstandard formats.
SKIPPABLE, SEEKABLE, HAS_CHECKSUMS = 0x184D2A50, 0x8F92EAB1, 0x80
SEEK_FRAME = SKIPPABLE + 14

#: Runs in the table, and the longest that is kept there.
TABLE, LONGEST = 800_000, 128
#: Characters that are cut together, and of a longer text up to the next space.
PIECE = 1 << 21
#: Plain characters: ASCII without control characters, and the letters of Latin-1, which are
#: in normal form and are lowered one by one.
_CAPITALS = [*range(0x41, 0x5B), *(c for c in range(0xC0, 0xDF) if c != 0xD7)]
_LETTERS = {*_CAPITALS, *(c + 32 for c in _CAPITALS), 0xDF, 0xFF}
_PLAIN = bytes(sorted({*range(0x09, 0x0E), *range(0x20, 0x7F), *_LETTERS}))
_LOWER = bytes(c + 32 if c in _CAPITALS else c for c in range(256))
_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_CLASS = bytes(
    _SPACE if c == 0x20 or 0x09 <= c <= 0x0D else _LETTER if c in _LETTERS else _DIGIT if 0x30 <= c <= 0x39 else _MARK for c in range(256)
)
#: Texts of other characters are cut into words. Texts with control characters or marks of
#: special tokens are left to the library.
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_ODD = re.compile(r"<\||[\x00-\x08\x0E-\x1F\x7F]")
_CODERS: dict[str, WordCoder] = {}

_MANIFEST = "place long, path string, first long, n_docs long, n_tokens long"
_READ = "doc_id long, start long, n_tokens long, ids binary"
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


class WordCoder:
    """A tokenizer that lowers text, drops white space and cuts it as _cut does; one per Python worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.table: dict[bytes | str, bytes] = {}
        # The library takes long texts much faster than many short ones, so runs are handed over
        # many at a time. Where each run ends with an id of a kind that only ends runs, the ids
        # are cut apart there, else at a special token between the runs.
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.ends = np.array([bool(suffix) and t.endswith(suffix) for t in tokens])
        self.between, self.mark = next((i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special)

    @classmethod
    def of(cls, path: str) -> WordCoder:
        if path not in _CODERS:
            _CODERS[path] = cls(path)
        return _CODERS[path]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _apart(self, words: list[str]) -> list[bytes]:
        """Ids of words of any characters, by a special token between them."""
        joined = [self.mark.join(words[i : i + 256]) for i in range(0, len(words), 256)]
        out = []
        for found in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(found.ids, self.kind)
            out += [x.tobytes() for x in np.split(ids, np.flatnonzero(ids == self.between))]
        # All but the first of a text begin with the mark.
        return [x[self.kind.itemsize :] if i % 256 else x for i, x in enumerate(out)]

    def _by_ends(self, runs: list[bytes]) -> list[bytes]:
        """Ids of runs of plain characters, by the ids that end a run."""
        out = []
        for lo in range(0, len(runs), 1024):
            part = [r.decode("latin-1") for r in runs[lo : lo + 1024]]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                out += self._apart(part)
                continue
            data, cuts = ids.tobytes(), (ends * self.kind.itemsize).tolist()
            out += [data[a:b] for a, b in zip([0, *cuts], cuts)]
        return out

    def _of_plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text of plain characters, in Latin-1."""
        runs, upto = _cut(texts)
        coded = runs.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.table.get, distinct))
        new = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(new, self._by_ends([distinct[i] for i in new])):
            found[i] = x
            if len(distinct[i]) <= LONGEST:
                self.table[distinct[i]] = x
        ids = np.frombuffer(b"".join(found), self.kind)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        which = coded.indices.to_numpy()
        n = sizes[which]
        after = np.cumsum(n)
        # The place in `ids` of each id of the texts: that of its run's first, and so many further.
        ids = ids[np.repeat((np.cumsum(sizes) - sizes)[which] - (after - n), n) + np.arange(n.sum())]
        cuts = np.concatenate(([0], after))[upto] * self.kind.itemsize
        data, cuts = ids.tobytes(), cuts.tolist()
        return [data[a:b] for a, b in zip([0, *cuts], cuts)]

    def _of_words(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of each text, given in words of any characters."""
        new = list(set().union(*texts).difference(self.table))
        self.table.update(zip(new, self._apart(new)))
        out = [b"".join(map(self.table.__getitem__, words)) for words in texts]
        for word in new:
            if len(word) > LONGEST:
                del self.table[word]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, `kind` each."""
        if len(self.table) > TABLE:
            self.table.clear()
        pieces, words, out = [], {}, dict.fromkeys(range(len(texts)), b"")
        for i, text in enumerate(texts):
            data = _latin(text)
            if "<|" in text or data is None and _ODD.search(text):
                out[i] = self._whole(text)
            elif data is None:
                words[i] = _WORDS.findall(text)
            else:
                pieces += [(i, piece) for piece in _pieces(data)]
        out.update(zip(words, self._of_words(list(words.values()))))
        upto = np.cumsum([len(piece) for _, piece in pieces]) // PIECE
        for part in np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(upto)) + 1):
            for at, ids in zip(part, self._of_plain([pieces[at][1] for at in part])):
                out[pieces[at][0]] += ids
        return [out[i] for i in range(len(texts))]


def _latin(text: str) -> bytes | None:
    """The text in Latin-1 if all its characters are plain."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return None if data.translate(None, _PLAIN) else data


def _pieces(data: bytes) -> Iterator[bytes]:
    """A long text in parts that begin with a space, which no run holds."""
    lo = 0
    while len(data) - lo > PIECE and (hi := data.find(b" ", lo + PIECE)) > 0:
        yield data[lo:hi]
        lo = hi
    yield data[lo:]


def _cut(texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Runs of all texts of plain characters, lowered, and how many there are up to the end of each text.

    A run is letters, one digit or marks; an apostrophe that is no part of more marks goes with
    s, t, m, d, re, ve or ll after it. The two characters added at the end keep looks ahead in bounds.
    """
    data = b"".join(t + b"\n" for t in texts).translate(_LOWER) + b"\n\n"
    chars, kinds = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(_CLASS), np.uint8)
    starts = kinds != _SPACE
    starts[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    at = np.flatnonzero(starts & (chars == ord("'")))
    one, two = chars[at + 1], chars[at + 1].astype(np.uint16) << 8 | chars[at + 2]
    for size, short in ((1, np.isin(one, list(b"stmd"))), (2, np.isin(two, [int.from_bytes(x) for x in (b"re", b"ve", b"ll")]))):
        starts[at[short] + 1] = False
        behind = at[short] + 1 + size
        starts[behind] |= kinds[behind] == _LETTER
    upto = np.searchsorted(np.flatnonzero(starts), np.cumsum([len(t) + 1 for t in texts], dtype=np.int64))
    kept = kinds != _SPACE
    letters, offsets = chars[kept], np.flatnonzero(starts[kept])
    offsets = np.append(offsets, len(letters)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)]), upto


class Writer:
    """Writes one file of documents' ids."""

    def __init__(self, out, kind: np.dtype, level: int):
        self.out, self.kind = out, kind
        self.frames = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.ids: list[int | None] = []
        self.entries: list[bytes] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.frames.compress(ids)
        self.out.write(frame)
        self.ids.append(doc_id)
        self.entries.append(struct.pack("<III", len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.tokens += len(ids) // self.kind.itemsize

    def close(self) -> None:
        known = bytes(i is not None for i in self.ids)
        index = struct.pack("<BQ", self.kind.itemsize, len(self.ids)) + known + np.array([i or 0 for i in self.ids], "<i8").tobytes()
        seek = b"".join(self.entries) + struct.pack("<IBI", len(self.entries), HAS_CHECKSUMS, SEEKABLE)
        for magic, data in ((SKIPPABLE, index), (SEEK_FRAME, seek)):
            self.out.write(struct.pack("<II", magic, len(data)) + data)
        self.out.close()


class Reader:
    """Reads documents of one file; `file` needs seek and read."""

    def __init__(self, file):
        self.file = file
        frames, _, magic = struct.unpack("<IBI", self._tail(0, 9))
        if magic != SEEKABLE:
            raise ValueError("no seek table at the end")
        size = 12 * frames
        self.entries = np.frombuffer(self._tail(9, size), "<u4").reshape(frames, 3).astype(np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.entries[:, 0])))
        data = self._at(int(self.offsets[-1]) + 8, 9)
        width, rows = struct.unpack("<BQ", data)
        index = self._at(int(self.offsets[-1]) + 17, rows * 9)
        self.kind = np.dtype(f"<u{width}")
        known = np.frombuffer(index[:rows], bool)
        self.ids = [int(i) if k else None for i, k in zip(np.frombuffer(index[rows:], "<i8"), known)]
        self.frames = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def _tail(self, before: int, size: int) -> bytes:
        self.file.seek(0, 2)
        return self._at(self.file.tell() - before - size, size)

    def read(self, row: int) -> np.ndarray:
        """The ids of the row-th document."""
        data = self._at(int(self.offsets[row]), int(self.entries[row, 0]))
        ids = self.frames.decompress(data, max_output_size=int(self.entries[row, 1]))
        if len(ids) != self.entries[row, 1] or xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF != self.entries[row, 2]:
            raise ValueError(f"frame {row} is damaged")
        return np.frombuffer(ids, self.kind)


def _open(path: str):
    store, name = pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)
    return store, name


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", level: int = 1
) -> DataFrame:
    """Encodes every text, appends `end_id` and writes the files; returns their manifest.

    Documents are written in ascending order of id over the files in order of `place`; null
    ids come first, equal ids in order of text. `folder` and the tokenizer file must be
    within reach of every executor. A task that is run again writes a file of a new name,
    and the manifest names only those of tasks that counted. Null text has only `end_id`.
    Other columns are ignored, whatever their names; an empty table gives no file.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, first = WordCoder.of(tokenizer), None, None
        end = np.array([end_id], coder.kind).tobytes()
        place = TaskContext.get().partitionId()
        path = f"{folder}/part-{place:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                ids, texts = (c.to_pylist() for c in batch.slice(lo, 1024).columns)
                if writer is None and ids:
                    store, name = _open(path)
                    store.create_dir(name.rpartition("/")[0], recursive=True)
                    writer, first = Writer(store.open_output_stream(name, compression=None), coder.kind, level), ids[0]
                for doc_id, data in zip(ids, coder.encode([t or "" for t in texts])):
                    writer.add(doc_id, data + end)
        if writer:
            writer.close()
            row = [[place], [path], [first], [len(writer.ids)], [writer.tokens]]
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["place", "path", "first", "n_docs", "n_tokens"])

    return written(ordered.mapInArrow(run, _MANIFEST), "token-files")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, little-endian 32-bit) of every document in the files.

    start counts the ids of all documents before it. Checksums are verified.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                store, name = _open(path)
                with store.open_input_file(name) as file:
                    reader, rows = Reader(file), []
                    for row, doc_id in enumerate(reader.ids):
                        ids = reader.read(row)
                        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                        start += len(ids)
                        if len(rows) == 256 or row + 1 == len(reader.ids):
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ_ARROW)], schema=_READ_ARROW)
                            rows = []

    # One row per file; the files are dealt out again to be read in parallel.
    before = F.sum("n_tokens").over(Window.orderBy("place")) - F.col("n_tokens")
    files = manifest.select("path", before.alias("start"))
    files = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return files.mapInArrow(run, _READ)


_INDEX = "doc_id long, path string, row long"
_PICKED = "doc_id long, path string, row long, n_tokens long, ids binary"
#: Documents that one task picks out of a file.
PICKED = 4096


def token_index(manifest: DataFrame) -> DataFrame:
    """doc_id, path and row of every document in the files, from the ends of the files alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = _open(path)
                with store.open_input_file(name) as file:
                    ids = Reader(file).ids
                for lo in range(0, len(ids), 1 << 16):
                    part = ids[lo : lo + (1 << 16)]
                    columns = [pa.array(part, pa.int64()), pa.array([path] * len(part)), pa.array(range(lo, lo + len(part)), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "path", "row"])

    files = manifest.select("path").repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    return files.mapInArrow(run, _INDEX)


def read_documents(manifest: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """doc_id, path, row, n_tokens and ids of the documents whose id is in `wanted`.

    Ids are looked up in the files' indexes, and only the frames of those found are read and
    decompressed, by as many tasks as their number asks for. Checksums are verified. An id that
    several documents have gives them all; ids that are null or in no file give none. Repeated
    wanted ids count once.
    """
    def run(table: pa.Table) -> pa.Table:
        store, name = _open(table["path"][0].as_py())
        with store.open_input_file(name) as file:
            reader = Reader(file)
            found = [reader.read(row) for row in table["row"].to_pylist()]
        sizes, ids = [len(x) for x in found], [x.astype("<u4").tobytes() for x in found]
        return table.select(["doc_id", "path", "row"]).append_column("n_tokens", pa.array(sizes, pa.int64())).append_column("ids", pa.array(ids, pa.binary()))

    ids = wanted.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    places = token_index(manifest).join(ids, "doc_id").withColumn("piece", F.expr(f"row div {PICKED}"))
    return places.groupBy("path", "piece").applyInArrow(run, _PICKED)


def new_folder(docs: DataFrame) -> str:
    """A folder for files that every executor can reach."""
    return session.scratch_path(docs.sparkSession, "token-frames")
