"""Substring dedup, exact dedup and the n-gram Jaccard join against brute force and SQL."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from cases import ROWS, SF, empty, frame, words

import check_oracles
from shelftrail.llm import exact_dedup, jaccard_join, queries, substring_dedup
from shelftrail.llm.hashing import Words
from shelftrail.llm.tables import Scratch, components, keyed, only


def test_words_and_windows():
    texts = ["a bb  a bb\n", None, "", " \t ", "a bb", "é a"]
    found = Words(pa.array(texts))
    assert found.counts.tolist() == [len((t or "").encode().split()) for t in texts]
    assert len(set(found.hashes.tolist())) == 3
    pairs = found.windows(2)[found.room() >= 2]
    assert pairs[0] == pairs[2] == pairs[3] and len(set(pairs.tolist())) == 3
    cut = Words(pa.array(["abcdefg hi"]), longest=3)
    assert [(int(s), int(e)) for s, e in zip(cut.starts, cut.ends)] == [(0, 3), (3, 6), (6, 7), (8, 10)]


def removed(rows, window):
    """doc_id -> kept words, by comparing all windows."""
    first = {}
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    for doc, w in split:
        for s in range(len(w) - window + 1) if doc is not None else ():
            t = tuple(w[s : s + window])
            first[t] = min(first.get(t, doc), doc)
    out = []
    for doc, w in split:
        gone = set()
        for s in range(len(w) - window + 1) if doc is not None else ():
            if first[tuple(w[s : s + window])] < doc:
                gone.update(range(s, s + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((doc, len(w), len(gone), sha256(b" ".join(kept)).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window, rows", [
    (50, ROWS),
    (7, [(i, words(i % 4, 60, 3) + " " + words(i, 25, 2), None, None, None) for i in range(30)]),
    (6, [(i, " ".join(["sh"] * (i % 9)) + " " + words(i % 3, 30), None, None, None) for i in range(40)]),
])
def test_substring_dedup(spark, window, rows):
    got = substring_dedup.remove_repeats(frame(spark, rows), window).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == removed(rows, window)
    assert all(sum(e - s for s, e in r.spans) == r.n_removed for r in got)


def test_dedup_of_nothing(spark):
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    assert jaccard_join.jaccard_join(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [4, 4096])
def test_exact_dedup(spark, block):
    got = exact_dedup.exact_dedup(frame(spark), block=block).collect()
    groups = {}
    for doc, text, *_ in ROWS:
        groups.setdefault(b"".join((text or "").encode().split()), []).append((-len(text or ""), doc is None, doc))
    expected = []
    for plain, members in groups.items():
        keep = min(members)[2]
        for _, _, doc in members:
            expected.append((doc, keep, len(members), sha256(plain).hexdigest()))
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(expected)
    assert sum(r.kept for r in got) == len(groups)
    assert sorted(r.doc_id for r in got if r.kept and r.group_size > 1) == [5, 7, 9]


def test_names_do_not_depend_on_the_number_of_buckets(spark, monkeypatch):
    plain = exact_dedup.exact_dedup(frame(spark), block=8).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    monkeypatch.setattr(exact_dedup, "_BLOCKS_SORTED", 100)
    monkeypatch.setattr(exact_dedup, "_PAIRS_SORTED", 50)
    blocks = spark.range(1000).selectExpr("id % 300 as block")
    buckets = exact_dedup._buckets(blocks, 100)
    named = exact_dedup._named(blocks, buckets, "block")
    # More rows, more tasks, each with its share; a name for each block and a block for each name.
    assert buckets == named.rdd.getNumPartitions() == 10
    pairs = {(r.block, r.name) for r in named.collect()}
    assert len(pairs) == len({b for b, _ in pairs}) == len({n for _, n in pairs}) == 300
    assert Counter(exact_dedup.exact_dedup(frame(spark), block=8).select(*plain[0].__fields__).collect()) == Counter(plain)


def test_exact_kept_documents(spark):
    docs = frame(spark)
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([2, 5, 7, 8, 9, None, 11, 12, 13, 14, 15])


def shingles(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(low[i : i + size]) for i in range(len(low) - size + 1)} if len(low) >= size else ({tuple(low)} if low else set())


def linked(rows, size, least, of):
    sets = [shingles(r[1], size) for r in rows]
    links, label = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and of * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                label[max(find(i), find(j))] = min(find(i), find(j))
    best = {}
    for i, r in enumerate(rows):
        best[find(i)] = min(best.get(find(i), (True, 0)), (r[0] is None, r[0] or 0))
    return Counter((r[0], len(sets[i]), None if best[find(i)][0] else best[find(i)][1], links[i]) for i, r in enumerate(rows))


def variants(seed, groups, copies, count):
    """Groups of texts that differ from one another in a few words."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = words(seed * 100 + g, count + 5 * g).split()
        for _ in range(copies):
            changed = list(base)
            for _ in range(rng.randrange(4)):
                changed[rng.randrange(len(changed))] = f"x{rng.randrange(50)}"
            rows.append((len(rows), " ".join(changed), None, None, None))
    return rows


@pytest.mark.parametrize("tile, size, least, rows", [
    (1 << 20, 3, 90, ROWS),
    (1 << 20, 5, 80, variants(1, 6, 9, 60)),
    (300, 3, 80, variants(2, 3, 25, 50)),
    (50, 2, 60, variants(3, 2, 30, 12) + [(100 + i, words(i, i % 7, 2), None, None, None) for i in range(30)]),
])
def test_jaccard_join(spark, monkeypatch, tile, size, least, rows):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    got = jaccard_join.jaccard_join(frame(spark, rows), size, least, 100).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in got) == linked(rows, size, least, 100)
    assert sum(r.kept for r in got) == len({r.component_id if r.n_links else id(r) for r in got})


def test_jaccard_kept_documents(spark):
    docs = frame(spark)
    kept = jaccard_join.kept_documents(docs, size=5, least=80, of=100)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 8, 9, None, 11, 12, 13, 14])


def test_bands_hold_all_links():
    bands = jaccard_join.Bands(90, 100)
    for n in range(1, 3000):
        m = n * 100 // 90
        assert bands.band(m) - bands.band(n) in (0, 1)
        # Sets of sizes n and m with the least overlap that links differ in fewer n-grams than there are slices.
        least = -(-90 * (n + m) // 190)
        assert n + m - 2 * least + 1 < bands.slices(bands.band(n)) + 1


def test_bitmap_bound_is_exact_in_the_end():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(rng.permutation(base)[: rng.integers(200, 300)]) for _ in range(40)]
    a, b = jaccard_join._pairs(sets, np.arange(40), None, 80, 100)
    expected = {(i, j) for i in range(40) for j in range(i + 1, 40)
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert set(zip(a.tolist(), b.tolist())) == expected and expected


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)]
    label = {v: v for e in edges for v in e}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    with Scratch(spark) as steps:
        got = dict(components(spark.createDataFrame(edges, "a long, b long"), steps).collect())
    assert got == {v: find(v) for v in {v for a, b in edges if a != b for v in (a, b)}}


@pytest.mark.parametrize("key", ["op1_substring_dedup", "op2_packing", "op3_jaccard_join", "op7_exact_dedup"])
def test_sql(spark, monkeypatch, key):
    monkeypatch.setattr(check_oracles, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(check_oracles, "ORACLES", queries.ORACLES)
    assert check_oracles.compare(spark, check_oracles.connect(SF), SF, key) == ""


def test_only_kept_rows(spark, tmp_path):
    """Rows on both sides of the limits of bytes and of bitmaps."""
    spark.range(70_000).repartition(2).write.parquet(str(tmp_path / "t"))
    docs, key = keyed(spark.read.parquet(str(tmp_path / "t")))
    keep = docs.where("id % 7 = 3 or id < 40").select(key)
    got = only(docs, key, keep)
    assert got.columns == ["id"]
    assert sorted(r.id for r in got.collect()) == [i for i in range(70_000) if i % 7 == 3 or i < 40]
    assert only(docs, key, keep.where("false")).count() == 0
