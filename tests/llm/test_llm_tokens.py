"""Packing, tokenizers, token files, nearest neighbours and the pipeline."""

import hashlib
import io
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from cases import ROWS, SF, empty, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelftrail.llm import nearest, packing, queries, sentencepiece_codec, token_frames
from shelftrail.llm.tables import Scratch

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= n) - n for n in lengths)


@pytest.mark.parametrize("seed", range(5))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(1, 40) for _ in range(rng.randrange(1, 60))]
    bins = sorted(Counter(lengths).items())
    for buckets in (1, 2, 3, 4):
        ends = packing.boundaries([(n, c, n * c) for n, c in bins], buckets)
        values = [n for n, _ in bins]
        best = min(padding(lengths, [*c, values[-1]]) for k in range(buckets) for c in itertools.combinations(values[:-1], min(k, len(values) - 1)))
        assert len(ends) <= buckets and ends[-1] == values[-1] and padding(lengths, ends) == best


@pytest.mark.parametrize("seed", range(5))
def test_boundaries_of_many_lengths(seed):
    """The plain dynamic program, also where choices are equally good."""
    rng = np.random.default_rng(seed)
    bins = sorted(Counter(rng.choice([rng.integers(1, 300, 400), 7 * rng.integers(0, 9, 400)][seed % 2], 400).tolist()).items())
    lengths, counts = np.array(bins).T
    rows, tokens = np.append(0, np.cumsum(counts)), np.append(0, np.cumsum(lengths * counts))
    cost, ways = np.append(0, lengths * rows[1:] - tokens[1:]).tolist(), [[]] + [[int(n)] for n in lengths]
    for buckets in range(1, 9):
        assert packing.boundaries([(int(n), int(c), int(n * c)) for n, c in bins], buckets) == ways[-1]
        new, longer = list(cost), list(ways)
        for j in range(2, len(lengths) + 1):
            total = [cost[i] + int(lengths[j - 1] * (rows[j] - rows[i]) - tokens[j] + tokens[i]) for i in range(1, j)]
            if min(total) < cost[j]:
                i = 1 + total.index(min(total))
                new[j], longer[j] = total[i - 1], ways[i] + [int(lengths[j - 1])]
        cost, ways = new, longer


def test_one_huge_text_does_not_coarsen_boundaries(spark):
    rng = random.Random(1)
    lengths = [rng.randrange(1, 300) for _ in range(500)] + [5_000_000]
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n long")
    rows = packing.pack(docs, budget=1000, buckets=3, length=F.col("n")).collect()
    values = sorted(set(lengths))
    best = min(padding(lengths, [*c, values[-1]]) for c in itertools.combinations(values[:-1], 2))
    assert sum(r.boundary - r.n_tokens for r in rows) == best


def test_batches(spark):
    rows = packing.pack(frame(spark), budget=500, buckets=3).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    sizes = {r[0]: len((r[1] or "").encode().split()) for r in ROWS}
    batches = {}
    for r in rows:
        assert r.n_tokens == sizes[r.doc_id] and r.n_tokens <= r.boundary
        batches.setdefault((r.bucket, r.boundary, r.batch), []).append(r.slot)
    for (bucket, boundary, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) == 1 or len(slots) * boundary <= 500
        if batch < max(b for k, _, b in batches if k == bucket):
            assert len(slots) == max(1, 500 // max(boundary, 1))
    assert packing.pack(empty(spark)).count() == 0


def test_batches_over_many_slices(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 30)
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), (F.col("id") % 50).alias("n"))
    rows = packing.pack(docs, budget=100, buckets=4, length=F.col("n")).collect()
    places = {}
    for r in rows:
        places.setdefault((r.bucket, r.boundary), []).append(r.batch * max(1, 100 // max(r.boundary, 1)) + r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


ODD = [r[1] or "" for r in ROWS] + [" a", "a ", "  ", "▁", "a▁ b", "a\nb\tc", "Don't STOP! it's 'tis o''s 'Re're", "ΑΣ. İx ½２３", "\x1c's \x00 x<|y", "é ́a"]


def test_sentencepiece_is_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    for r in sentencepiece_codec.round_trip(docs, PIECES).collect():
        ids = model.encode(ODD[r.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == model.decode(ids)
    odd = sentencepiece_codec.round_trip(frame(spark), PIECES).collect()
    assert Counter(r.doc_id for r in odd) == Counter(r[0] for r in ROWS)
    assert sentencepiece_codec.round_trip(empty(spark), PIECES).count() == 0


def test_sentencepiece_table_may_overflow(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "TABLE", 5)
    monkeypatch.setattr(sentencepiece_codec, "LONGEST", 4)
    codec = sentencepiece_codec.Codec(PIECES)
    for text in ODD * 2:
        assert np.frombuffer(codec.encode([text, "again"])[0], "<u4").tolist() == codec.model.encode(text)


def test_sentencepiece_query(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.op6_sentencepiece(spark, SF).collect():
        ids = model.encode(texts[r.doc_id] or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_word_coder_is_the_library(monkeypatch):
    tokenizer = Tokenizer.from_file(WORDS)
    for table, longest in ((800_000, 128), (5, 3)):
        monkeypatch.setattr(token_frames, "TABLE", table)
        monkeypatch.setattr(token_frames, "LONGEST", longest)
        coder = token_frames.WordCoder(WORDS)
        for _ in range(2):
            for text, ids in zip(ODD, coder.encode(ODD)):
                assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_word_coder_looks_up_each_run_once(monkeypatch):
    """Capitals and marks beside a word make no entry of their own, and long texts are cut at spaces."""
    tokenizer, coder = Tokenizer.from_file(WORDS), token_frames.WordCoder(WORDS)
    coder.encode(["Größe, größe. GRÖSSE!", "größe GRÖßE, !"])
    assert set(coder.table) == {x.encode("latin-1") for x in ("größe", "grösse", ",", ".", "!")}
    rng = random.Random(7)
    parts = [*"aAsStTmMdDrReEvVlL'!.,-<|/w> \t\n019éÉßÿÞ×÷ñ", "'", "'", "'re", "'LL", "</w>", " '", "''"]
    for piece, more in ((1 << 21, []), (20, [*"œ’ İ̌J\x85\xa0\x1c²ªſΣ中", "<|endoftext|>"])):
        monkeypatch.setattr(token_frames, "PIECE", piece)
        texts = ["".join(rng.choices(parts + more, k=rng.randrange(60))) for _ in range(3000)]
        for text, ids in zip(texts, coder.encode(texts)):
            assert np.frombuffer(ids, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert coder.encode([]) == [] and coder.encode([""]) == [b""] and coder.encode([" ", "œ"])[0] == b""


def test_frames_are_independent_and_checked():
    out = io.BytesIO()
    out.close, data = (lambda: None), [np.arange(n, dtype="<u2") for n in (3, 0, 70_000 % 65_536, 5)]
    writer = token_frames.Writer(out, np.dtype("<u2"), 1)
    for doc_id, ids in zip((7, None, 9, 9), data):
        writer.add(doc_id, ids.tobytes())
    writer.close()
    raw = out.getvalue()
    reader = token_frames.Reader(io.BytesIO(raw))
    assert reader.ids == [7, None, 9, 9]
    assert all((reader.read(i) == ids).all() for i, ids in reversed(list(enumerate(data))))
    # The whole file is one valid zstandard stream.
    with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True) as stream:
        assert stream.read() == b"".join(x.tobytes() for x in data)
    # Damage to one frame doesn't touch the others.
    place = int(reader.offsets[2]) + 12
    hurt = token_frames.Reader(io.BytesIO(raw[:place] + bytes([raw[place] ^ 255]) + raw[place + 1 :]))
    assert (hurt.read(3) == data[3]).all()
    with pytest.raises((ValueError, zstandard.ZstdError)):
        hurt.read(2)
    with pytest.raises(ValueError):
        token_frames.Reader(io.BytesIO(raw[:-1]))


def test_token_files(spark, tmp_path):
    tokenizer = Tokenizer.from_file(WORDS)
    files = token_frames.write_tokens(frame(spark), str(tmp_path / "tokens"), WORDS, end_id=2)
    assert files.agg(F.sum("n_docs")).first()[0] == len(ROWS)
    rows = sorted(token_frames.read_tokens(files).collect(), key=lambda r: r.start)
    at = 0
    for r, (doc_id, text, *_) in zip(rows, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (doc_id, at, len(ids), ids)
        at += len(ids)
    assert token_frames.read_tokens(token_frames.write_tokens(empty(spark), str(tmp_path / "none"), WORDS, end_id=2)).count() == 0


def test_token_query(spark):
    tokenizer, at = Tokenizer.from_file(WORDS), 0
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: r for r in queries.op9_token_frames(spark, SF).collect()}
    for doc_id in sorted(texts):
        ids = tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def brute(ids, x, query, k):
    d = np.sqrt(((x - query[1]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != query[0]][:k]
    return [(int(ids[i]), float(d[i])) for i in order]


def test_nearest_recall_and_ties(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2500, 24))
    x[1000:1400] = x[0]  # one vector that many rows share
    x[1500:1503] = x[7]
    rows = [(i, v.tolist(), 7) for i, v in enumerate(x)]
    bad = [(9000, None, 1), (9100, [0.0] * 24, 1), (9200, [float("nan")] * 24, 1), (9300, [1.0] * 5, 1), (9400, [None] + [1.0] * 23, 1), (None, [1.0] * 24, 1)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, node int")
    found = {}
    for r in nearest.nearest(df, df.where("vec_id % 100 = 0"), 10).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(found) == set(range(0, 2500, 100))
    ids, hits = np.arange(2500), 0
    for query, got in found.items():
        got.sort()
        expected = brute(ids, x, (query, x[query]), 10)
        assert [r for r, _, _ in got] == list(range(1, 11))
        assert all(s == pytest.approx(np.linalg.norm(x[v] - x[query]), abs=1e-12) for _, v, s in got)
        assert [(s, v) for _, v, s in got] == sorted((s, v) for _, v, s in got)
        hits += len({v for _, v, _ in got} & {v for v, _ in expected})
        if 1000 <= query < 1400:
            assert [v for _, v, _ in got] == [v for v, _ in expected]
    assert hits >= 0.9 * 10 * len(found)


def of_random(spark, rows, size, seed=5):
    x = np.random.default_rng(seed).normal(size=(rows, size))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def hits(found, x, k):
    """Share of the k nearest that `found` (query, neighbour) has."""
    ids, got = np.arange(len(x)), {}
    for query, neighbour in found:
        got.setdefault(query, set()).add(neighbour)
    return np.mean([len(n & {v for v, _ in brute(ids, x, (q, x[q]), k)}) / k for q, n in got.items()])


def test_nearest_widens_a_narrow_search(spark):
    x, df = of_random(spark, 3000, 32)
    found = nearest.nearest(df, df.where("vec_id % 100 = 0"), 10, beam=12, width=4)
    assert hits([(r.query_id, r.vec_id) for r in found.collect()], x, 10) >= 0.9


def test_nearest_scans_where_the_graph_does_not_help(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SCAN_QUERIES", 7)
    x, df = of_random(spark, 400, 8)
    got = nearest.nearest(df, df.where("vec_id % 10 = 0"), 10, recall=1.1).collect()
    assert len(got) == 400 and hits([(r.query_id, r.vec_id) for r in got], x, 10) == 1


def test_graph_rounds_go_on_until_few_neighbours_are_new(spark, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 20)  # a poor start
    x, df = of_random(spark, 3000, 16)
    with Scratch(spark) as steps:
        rows = nearest.build(df.select(F.col("vec_id").alias("node"), F.col("embedding").alias("vector")), steps).collect()
    new = np.concatenate([np.frombuffer(r.fresh, bool) for r in rows])
    assert len(new) == 3000 * nearest.NEIGHBOURS and new.mean() <= 0.02
    assert hits([(r.node, int(v)) for r in rows[::20] for v in np.frombuffer(r.ids, np.int64)[:10]], x, 10) >= 0.9


def test_nearest_of_more_nodes_than_pivots(spark, monkeypatch):
    """The graph is of the pivots; every other node is found by its cell, crowds of near copies too."""
    for name, value in (("LEAST_PIVOTS", 60), ("PIVOTS", 1), ("BLOCK_BYTES", 16 * 8 * 100)):
        monkeypatch.setattr(nearest, name, value)
    sizes, build = [], nearest.build
    monkeypatch.setattr(nearest, "build", lambda base, steps: sizes.append(base.count()) or build(base, steps))
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 16))
    x[500:1200] = x[500] + 1e-3 * rng.normal(size=(700, 16))  # more than a block holds
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = [(r.query_id, r.vec_id) for r in nearest.nearest(df, df.where("vec_id % 20 = 0"), 10, beam=8, width=4).collect()]
    assert len(found) == 150 * 10 and hits(found, x, 10) >= 0.9
    # With all cells in sight, the result is exact.
    rows = sorted(tuple(r) for r in nearest.nearest(df, df.where("vec_id % 50 = 0"), 10, recall=1.1).collect())
    expected = [(q, i + 1, *n) for q in range(0, 3000, 50) for i, n in enumerate(brute(np.arange(3000), x, (q, x[q]), 10))]
    assert [r[:3] for r in rows] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in rows], [r[3] for r in expected], rtol=0, atol=1e-12)
    assert all(20 <= n <= 120 for n in sizes)


def test_nearest_ties_and_repeated_ids(spark, monkeypatch):
    """Many nodes are equally near; an id may have several vectors, and a vector several rows of one id."""
    monkeypatch.setattr(nearest, "LEAST_PIVOTS", 20)
    monkeypatch.setattr(nearest, "PIVOTS", 1)
    places = [[float(a), float(b), 1.0] for a in range(-15, 15) for b in range(-15, 15)]
    rows = [(2 * i, v) for i, v in enumerate(places)] * 2 + [(2 * i, [v[0], v[1], 2.0]) for i, v in enumerate(places[:40])] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = df.where("vec_id % 180 = 0 and vec_id > 100")
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    got = sorted(tuple(r) for r in nearest.nearest(df, asked, 10, recall=1.1).collect())
    expected = [(q, i + 1, *n) for q in range(180, 1800, 180) for i, n in enumerate(brute(ids, x, (q, np.array(places[q // 2])), 10))]
    assert [r[:3] for r in got] == [r[:3] for r in expected] and np.allclose([r[3] for r in got], [r[3] for r in expected])


def test_nearest_of_two_frequent_lengths(spark):
    rng = np.random.default_rng(8)
    sets = {5: rng.normal(size=(300, 5)), 9: rng.normal(size=(280, 9))}
    rows = [(i * 2 + (size == 9), v.tolist()) for size, x in sets.items() for i, v in enumerate(x)] + [(3000, [1.0] * 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {}
    for r in nearest.nearest(df, df.where("vec_id % 25 = 0"), 10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    # Half of each set, by id; the only vector of its length has no neighbour.
    assert set(found) == {q for q in range(0, 600, 25) if q % 2 == 0 or q < 560}
    share = []
    for q, got in found.items():
        x = sets[9 if q % 2 else 5]
        ids = np.arange(len(x)) * 2 + q % 2
        share.append(len(set(got) & {v for v, _ in brute(ids, x, (q, x[q // 2]), 10)}) / 10)
        assert len(got) == 10 and all(v % 2 == q % 2 for v in got)
    assert np.mean(share) >= 0.9


def test_nearest_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0]), (100, [-0.0, 2.0])], schema)
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in nearest.nearest(df, df.where("vec_id % 100 = 0")).collect())
    far = round(5**0.5, 6)
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, far), (0, 3, 100, far), (100, 1, 2, 0.0), (100, 2, 0, far), (100, 3, 1, far)]
    none = spark.createDataFrame([], schema)
    assert nearest.nearest(none, none).count() == 0
    one = df.where("vec_id = 0")
    assert nearest.nearest(one, one).count() == 0


def test_stages(spark, tmp_path):
    """Every stage on the odd rows, each on what its predecessor kept."""
    spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = Counter(r.doc_id for r in docs.collect())
        assert name == "packing" or docs.columns == columns
    assert kept["exact_dedup"][9] == 1 and kept["exact_dedup"][6] == 0
    assert kept["ngram_jaccard_join"] == kept["exact_dedup"] - Counter([15])
    assert kept["packing"] == kept["secret_scans"] == kept["ngram_jaccard_join"]
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == kept["packing"]


def test_stages_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
