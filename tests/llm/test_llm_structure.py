"""Merkle manifest, conversation repair, sharding and positions, against brute force and SQL."""

import itertools
import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import public_tokenizers
import pytest
from cases import CLASHING, ROWS, SF, empty, frame, words
from pyspark.sql import functions as F

import check_oracles
from shelftrail.llm import conversations, merkle, order, packing, queries, sharding, token_frames
from shelftrail.llm.tables import Scratch, written

LARGER = "/root/testdata/sf0.01"
WORD_PIECES = public_tokenizers.path("word_bpe_49k.json")


# --- positions ------------------------------------------------------------------


def test_numbered(spark, monkeypatch):
    """Gapless, in order, nulls first, also where all rows are equal."""
    monkeypatch.setattr(order, "PART_ROWS", 100)
    rows = [(random.Random(i).choice([None, "a", "b", "b", "b"]), i % 3) for i in range(2000)] + [("b", 1)] * 1000
    with Scratch(spark) as steps:
        df = steps.written(spark.createDataFrame(rows, "k string, n int"), "t")
        got = order.numbered(df, steps, "x", "k", "n").orderBy("place").collect()
        sizes = order.numbered(df, steps, "x", "k", "n").groupBy(F.floor(F.col("place") / 100)).count().collect()
        nothing = order.numbered(steps.written(df.limit(0), "none"), steps, "x", "k").count()
    assert [r.place for r in got] == list(range(len(rows)))
    assert [(r.k or "", r.n) for r in got] == sorted((k or "", n) for k, n in rows)
    assert nothing == 0 and {r["count"] for r in sizes} == {100}


# --- Merkle manifest ------------------------------------------------------------


def recursive_log(leaves, height):
    """(level, index) of all nodes in postorder, and the root, by recursion."""
    out = []

    def node(level, index):
        if level == 0:
            digest = leaves[index]
        else:
            count = -(-len(leaves) // 8 ** (level - 1))
            digest = merkle.node_hash([node(level - 1, c) for c in range(8 * index, min(8 * index + 8, count))])
        out.append((level, index))
        return digest

    return node(height, 0), out


@pytest.mark.parametrize("count", [1, 2, 7, 8, 9, 15, 63, 64, 65, 72, 100, 511, 512, 513, 577, 4095, 4096, 4097])
def test_log_and_positions(count):
    leaves = [sha256(str(i).encode()).digest() for i in range(count)]
    height = merkle.height_of(count)
    root, places = recursive_log(leaves, height)
    log = merkle.append_log(leaves, height)
    assert log[-1] == root and len(log) == len(places)
    assert [merkle.position(level, index, count) for level, index in places] == list(range(len(log)))


def hashed(values):
    text = "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return sha256(text.encode()).hexdigest()


def run_hash(digests):
    return sha256("".join(digests).encode()).hexdigest()


def proven(leaves, i):
    """The root over leaves, and the siblings of leaf i with their places, level by level."""
    path = []
    while len(leaves) > 1:
        run = i // 8 * 8
        path.append((leaves[run:i], leaves[i + 1 : run + 8]))
        leaves, i = [run_hash(leaves[j : j + 8]) for j in range(0, len(leaves), 8)], i // 8
    return leaves[0], path


def plain_merkle(rows):
    def low(text):
        return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    trees = defaultdict(list)
    for doc, text, lang, source, n in rows:
        tampered = doc is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        leaf = hashed((doc, source, lang, n, text))
        trees[lang].append((doc is not None, doc or 0, leaf, doc, hashed((doc, source, lang, n, low(text))) if tampered else leaf))
    langs = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for leaves in trees.values():
        leaves.sort(key=lambda x: x[:3])
    subroots = [proven([x[2] for x in trees[k]], 0)[0] for k in langs]
    out = []
    for t, lang in enumerate(langs):
        root, over = proven(subroots, t)
        for i, (_, _, leaf, doc, now) in enumerate(trees[lang]):
            path = proven([x[2] for x in trees[lang]], i)[1] + over
            for left, right in path:
                now = run_hash([*left, now, *right])
            proof = sha256("".join("".join(a + b) for a, b in path).encode()).hexdigest()
            out.append((doc, leaf, subroots[t], root, proof, now, now == root))
    return Counter(out)


def tampered_proofs(docs, height):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_hash(*fields, low))
    return merkle.proofs(docs, F.col("lang"), F.col("doc_id"), merkle.leaf_hash(*fields, F.col("text")), changed, height)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_proofs(spark, height):
    """Trees of one to hundreds of leaves in blocks of 8 and more; nulls, ties, repeats, more than 8 trees."""
    rows = ROWS + [(i, f"Text {i} of MANY", "xx", "s", i) for i in range(300)] + [(i, "One", f"l{i % 11}", None, 1) for i in range(60)]
    rows += [(5, "Same Row", "xx", "s", 1)] * 20 + [(None, f"No Id {i}", None, "s", 1) for i in range(9)]
    got = tampered_proofs(frame(spark, rows), height).collect()
    assert Counter(tuple(r) for r in got) == plain_merkle(rows)
    assert {r.verified for r in got} == {True, False}


def test_proofs_of_one_and_of_nothing(spark):
    one = tampered_proofs(frame(spark, ROWS[:1]), 3).collect()
    assert one[0].leaf == one[0].subroot == one[0].root and one[0].proof_sha256 == sha256(b"").hexdigest()
    assert tampered_proofs(empty(spark), 3).count() == 0


# --- conversations --------------------------------------------------------------

BLANKS = " \t\n\x0b\x0c\r"
DUE = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
ROLE = {2: "user", 3: "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        kind = "blank" if not text.strip(BLANKS) else "duplicate" if (role, text) in seen else "truncated" if text.strip(BLANKS)[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(kind)
    return out


def cheapest(rows):
    """(cost, audit, repaired lines), from costs to go of all suffixes with whole audits."""
    kinds = faults(rows)
    best = {0: (0, "", []), 1: (4, "II", ["user:", "assistant:"]), 2: (2, "I", ["assistant:"]), 3: (0, "", [])}
    for (_, role, text), kind in zip(reversed(rows), reversed(kinds)):
        def after(cost, initial, state, line, ahead):
            c, a, r = ahead[state]
            return cost + c, initial + a, line + r

        own = {}
        for s in range(4):
            options = [after(3, "D", s, [], best)]
            if kind not in ("blank", "duplicate"):
                extra = kind == "truncated"
                if (role[:1], s) in KEPT:
                    options.append(after(extra, "K", KEPT[role[:1], s], [f"{role}:{text}"], best))
                options.append(after(2 + extra, "R", DUE[s], [f"{ROLE[DUE[s]]}:{text}"], best))
            own[s] = min(options, key=lambda o: o[:2])
        full = dict(own)
        for _ in range(3):
            full = {s: min(own[s], after(2, "I", DUE[s], [f"{ROLE[DUE[s]]}:"], full), key=lambda o: o[:2]) for s in range(4)}
        best = full
    return best[0]


def plain_repair(rows):
    """conv, turn, role, text -> the expected row of each conversation."""
    groups, out = defaultdict(list), {}
    for conv, turn, role, text in rows:
        groups[conv].append((turn, role, text))
    for conv, items in groups.items():
        items.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha256(r[2].encode()).hexdigest()))
        turns, kinds = [t for t, _, _ in items if t is not None], Counter(faults(items))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(items, items[1:]))
        cost, audit, lines = cheapest(items)
        out[conv] = (gaps, kinds["blank"], kinds["duplicate"], kinds["truncated"], illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return out


def random_conversations(seed, lengths):
    rng, rows = random.Random(seed), []
    for conv, length in enumerate(lengths):
        for turn in range(length):
            role = rng.choice(["user", "assistant", "system", "tool", "", " "] if rng.random() < 0.3 else [["user", "assistant"][turn % 2]])
            text = rng.choice(["", " \n", "yes.", "no", "what?", f"say {turn}!", f"cut {turn}", "é　 ok.\t"])
            rows.append((conv or None, rng.choice([None, turn, turn, turn, turn + 5, turn - 1]), role, text))
    return rows


@pytest.mark.parametrize("seed, chunk, lengths", [
    (1, 1024, [0, 1, 1, 2, 3, 5, 8, 13, 40]), (2, 3, [7, 1, 0, 2, 60, 3, 3, 9]), (3, 1, [5, 12, 1]), (4, 50, [700, 3, 3, 200]),
])
def test_repair(spark, seed, chunk, lengths):
    """Conversations within a chunk and over many; every state at a chunk's border."""
    rows = random_conversations(seed, lengths)
    ids = spark.createDataFrame([(c or None,) for c in range(len(lengths))], "conv long")
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    got = {r.conv: tuple(r)[1:] for r in conversations.repair(df, ids, chunk).collect()}
    none = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert got == {**{c or None: none for c in range(len(lengths))}, **plain_repair(rows)}


def test_repaired_rows(spark):
    rows = random_conversations(5, [9, 30, 2])
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    found = defaultdict(list)
    for r in conversations.repaired_rows(df, 4).collect():
        found[r.conv].append(r)
    expected = plain_repair(rows)
    for conv, items in found.items():
        kept = sorted((r for r in items if r.number is not None), key=lambda r: r.number)
        assert [r.number for r in kept] == list(range(len(kept)))
        assert sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == expected[conv][7]
        assert Counter(r.edit for r in items) == Counter(expected[conv][6])


def test_passes_end_where_costs_never_agree(spark):
    """Rows that allow no reset carry a guess through every chunk, so each pass puts one more right."""
    rows = [(1, t, ["user", "assistant"][t % 2], f"fine {t}.") for t in range(41)]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    got = conversations.repair(df, chunk=4).first()
    assert (got.cost, got.audit) == plain_repair(rows)[1][5:7]


def test_damage_and_clashing_columns(spark):
    rows = [(1, None, None, None), (1, 1, "user", "Hi."), (2, 0, "user", "A?"), (2, 0, "user", "A?")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *[F.lit(7).alias(c) for c in [*CLASHING, "chunk", "conv", "kind", "draw"]])
    plain = conversations.plain(df)
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted([(1, None, " ", " "), (1, 1, "user", "Hi."), (2, 0, "user", "A?"), (2, 0, "user", "A?")], key=repr)
    for draw, expected in enumerate([[], [""] * 4, [" ", "Hi", "A", "A"], [" ", " ", "Hi.", "Hi.", "A?", "A?", "A?", "A?"], [" ", "Hi.", "A?", "A?"], [" ", "Hi.", "A?", "A?"]]):
        out = conversations.damaged(plain, F.lit(draw)).collect()
        assert sorted(r.text for r in out) == sorted(expected)
        assert draw != 4 or {r.role for r in out} == {"user"}
    assert conversations.repair(conversations.damaged(plain, F.lit(0)), plain).count() == 2
    assert conversations.repair(plain.limit(0)).count() == 0


# --- sharding -------------------------------------------------------------------


def greedy(sizes, shards, capacity):
    """Shard of each group, or None if they don't fit."""
    out, shard, full = [], 0, 0
    for size in sizes:
        if size > capacity:
            return None
        if full + size > capacity:
            shard, full = shard + 1, 0
        full += size
        out.append(shard)
    return out if not out or out[-1] < shards else None


def plain_shards(rows, shards):
    groups = defaultdict(list)
    for doc, text, *_ in rows:
        groups[sha256((text or "").encode()).hexdigest()].append((doc is not None, doc or 0, doc, len((text or "").encode()) + 1, zlib.crc32((text or "").encode())))
    keys = sorted(groups)
    sizes = [sum(r[3] for r in groups[k]) for k in keys]
    runs = [sum(sizes[a:b]) for a, b in itertools.combinations(range(len(sizes) + 1), 2)]
    capacity = min((c for c in runs if greedy(sizes, shards, c)), default=0)
    out, slots = [], Counter()
    for key, shard in zip(keys, greedy(sizes, shards, capacity)):
        for _, _, doc, size, crc in sorted(groups[key], key=lambda r: r[:2]):
            out.append((doc, size, crc, shard, slots[shard]))
            slots[shard] += 1
    return Counter(out)


@pytest.mark.parametrize("shards, points", [(1, 4), (2, 2), (8, 3), (8, 32_768), (40, 5)])
def test_shards(spark, shards, points):
    rows = ROWS + [(i, words(i % 37, i % 50), None, None, None) for i in range(100)] + [(i, "copy " * 40, None, None, None) for i in range(60)]
    got = sharding.shard(frame(spark, rows), shards, points=points).collect()
    assert Counter(tuple(r) for r in got) == plain_shards(rows, shards)


def test_shards_of_few_rows(spark):
    assert sharding.shard(empty(spark)).count() == 0
    assert [tuple(r) for r in sharding.shard(frame(spark, [(1, None, None, None, None)])).collect()] == [(1, 1, 0, 0, 0)]
    hot = [(i, "x" * 300, None, None, None) for i in range(50)] + [(100 + i, str(i), None, None, None) for i in range(30)]
    got = sharding.shard(frame(spark, hot)).collect()
    assert len({r.shard for r in got if r.doc_id < 50}) == 1
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_running_sums_over_many_cells(spark, monkeypatch):
    """Cells gathered over two levels."""
    monkeypatch.setattr(sharding, "CELL", 2)
    monkeypatch.setattr(sharding, "DIGITS", 1)
    rows = sorted((sha256(str(i).encode()).hexdigest(), i + 1, i % 5 + 1) for i in range(1500))
    df = spark.createDataFrame(rows, "key string, bytes long, rows long")
    got = sharding.running(df, len(rows)).orderBy("key").collect()
    bytes_, counts = list(itertools.accumulate(r[1] for r in rows)), list(itertools.accumulate(r[2] for r in rows))
    assert [(r.bytes_end, r.rows_end, r.groups_end) for r in got] == list(zip(bytes_, counts, range(1, 1501)))


def test_shards_use_no_python(spark):
    plan = sharding.running(spark.createDataFrame([("a", 1, 1)], "key string, bytes long, rows long"), 1)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- token files ----------------------------------------------------------------


def test_only_wanted_frames_are_read(spark, tmp_path):
    """All other frames of the files are overwritten, and nobody notices."""
    files = token_frames.write_tokens(frame(spark), str(tmp_path / "tokens"), WORD_PIECES, end_id=2)
    expected = Counter((r.doc_id, r.ids) for r in token_frames.read_tokens(files).collect())
    wanted = spark.createDataFrame([(2,), (9,), (9,), (11,), (None,), (12345,)], "doc_id long")
    picked = {2, 9, 11}
    for r in files.collect():
        with open(r.path, "r+b") as file:
            reader = token_frames.Reader(file)
            for row, doc_id in enumerate(reader.ids):
                if doc_id not in picked:
                    file.seek(int(reader.offsets[row]))
                    file.write(b"\xff" * int(reader.entries[row, 0]))
    got = token_frames.read_documents(files, wanted).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == Counter({k: n for k, n in expected.items() if k[0] in picked})
    assert all(4 * r.n_tokens == len(r.ids) for r in got)
    with pytest.raises(Exception, match="zstd|Zstd|damaged"):
        token_frames.read_tokens(files).collect()
    assert token_frames.read_documents(files, wanted.limit(0)).count() == 0


# --- SQL ------------------------------------------------------------------------


@pytest.mark.parametrize("sf", [SF, LARGER])
@pytest.mark.parametrize("key", ["op2_packing", "op11_merkle", "op12_conversations", "op13_sharding"])
def test_sql(spark, monkeypatch, key, sf):
    monkeypatch.setattr(check_oracles, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(check_oracles, "ORACLES", queries.ORACLES)
    assert check_oracles.compare(spark, check_oracles.connect(sf), sf, key) == ""


def test_packing_sql_with_one_huge_text(spark):
    """The longest text doesn't blur the boundaries of the others."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = written(docs.unionByName(spark.createDataFrame([(10**6, "w " * 500_000)], "doc_id long, text string")), "huge")
    duck = check_oracles.duckdb.connect()
    files = [f.removeprefix("file://") for f in docs.inputFiles()]
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet({files})")
    answer = duck.execute(queries.ORACLES["op2_packing"])
    names = [c[0] for c in answer.description]
    expected = check_oracles._normal(answer.fetchall(), names)
    got = packing.pack(docs, budget=32768, buckets=8)
    assert check_oracles._normal([tuple(r) for r in got.collect()], got.columns) == expected
