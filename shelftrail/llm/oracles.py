"""DuckDB SQL of the manifest, the repair of conversations and sharding."""

from __future__ import annotations

#: The byte table of CRC-32, made from its polynomial.
_TABLE = """crc_table AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, x: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) r(i))"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a SQL text, with crc_table in the FROM clause."""
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex({text}), '..'), lambda h: CAST('0x' || h AS BIGINT))),
        lambda c, b: xor(t[CAST((xor(c, b) & 255) AS INTEGER) + 1], c >> 8)), 4294967295)"""


def merkle_sql(levels: int = 9, over: int = 4) -> str:
    """One CTE per level: n<l> has the nodes, s<l> the runs, f<l> each leaf's ancestor as folded and its siblings so far."""
    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [_TABLE, f"""
        d AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {leaf('text')} AS d,
              CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf('low')} END AS changed
              FROM (SELECT *, {lower} AS low FROM documents), crc_table),
        f0 AS (SELECT doc_id, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS j,
               d, coalesce(changed, d) AS f, '' AS p FROM d),
        n0 AS (SELECT g, j, d FROM f0)"""]

    def level(l: int) -> None:
        parts.append(f"""
        s{l} AS (SELECT g, j // 8 AS j, list(d ORDER BY j) AS ds, count(*) > 1 OR max(j) > 0 AS open_ FROM n{l} GROUP BY g, j // 8),
        o{l} AS (SELECT g, j, ds, bool_or(open_) OVER (PARTITION BY g) AS open_ FROM s{l}),
        n{l + 1} AS (SELECT g, j, CASE WHEN open_ THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM o{l}),
        f{l + 1} AS (SELECT doc_id, g, j, d,
               CASE WHEN open_ THEN sha256(before || f || after) ELSE f END AS f, CASE WHEN open_ THEN p || before || after ELSE p END AS p
               FROM (SELECT f.doc_id, f.g, f.j // 8 AS j, f.d, f.f, f.p, open_, coalesce(array_to_string(ds[1:f.j % 8], ''), '') AS before,
                            coalesce(array_to_string(ds[f.j % 8 + 2:], ''), '') AS after
                     FROM f{l} f JOIN o{l} o ON f.g = o.g AND f.j // 8 = o.j))""")

    for l in range(levels):
        level(l)
    parts.append(f"""
        n{levels + 1} AS (SELECT 0 AS g, g - 1 AS j, d FROM n{levels}),
        f{levels + 1} AS (SELECT f.doc_id, 0 AS g, f.g - 1 AS j, struct_pack(leaf := f.d, subroot := n.d) AS d, f.f, f.p
               FROM f{levels} f JOIN n{levels} n USING (g))""")
    for l in range(levels + 1, levels + 1 + over):
        level(l)
    last = levels + 1 + over
    return f"""WITH {",".join(parts)}
        SELECT doc_id, f.d.leaf AS leaf, f.d.subroot AS subroot, n.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f.f = n.d AS verified
        FROM f{last} f, n{last} n"""


def repair_sql() -> str:
    """Costs, audits and repaired rows to go, per state, from a conversation's last row to its first."""
    due, kept = (2, 2, 3, 2), {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
    said = {2: "user", 3: "assistant"}

    def best(*moves: str) -> str:
        return f"list_sort([{', '.join(moves)}])[1]"

    def move(cost: str, initial: str, to: str, row: str) -> str:
        return f"{{'c': {cost} + {to}.c, 'a': '{initial}' || {to}.a, 'r': {row} || {to}.r}}"

    def own(s: int) -> str:
        moves = [move("3", "D", f"s{s}", "''"), move("CASE WHEN drop_ THEN 1000000 ELSE 2 + extra END", "R", f"s{due[s]}", f"chr(10) || '{said[due[s]]}:' || text")]
        for initial, to in kept.items():
            if to[s] is not None:
                moves.append(move(f"CASE WHEN drop_ OR left(role, 1) <> '{initial}' THEN 1000000 ELSE extra END", "K", f"s{to[s]}", "chr(10) || role || ':' || text"))
        return f"{best(*moves)} AS o{s}"

    def full(s: int) -> str:
        a, b = due[s], due[due[s]]
        return best(f"o{s}", move("2", "I", f"o{a}", f"chr(10) || '{said[a]}:'"), move("4", "II", f"o{b}", f"chr(10) || '{said[a]}:' || chr(10) || '{said[b]}:'")) + f" AS s{s}"

    ends = [(0, "", "''"), (4, "II", "chr(10) || 'user:' || chr(10) || 'assistant:'"), (2, "I", "chr(10) || 'assistant:'"), (0, "", "''")]
    last = ", ".join(f"{{'c': {c}, 'a': '{a}', 'r': {r}}} AS s{s}" for s, (c, a, r) in enumerate(ends))
    blank = r"[\x20\x09-\x0D]"
    return f"""WITH RECURSIVE {_TABLE},
        d AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
              {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS k FROM conversations, crc_table),
        e AS (SELECT g, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
              CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
              unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM d WHERE k > 0),
        i AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM e),
        j AS (SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again,
              NOT regexp_matches(text, '[.!?]{blank}*\\z') AS cut, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) || left(role, 1) AS pair FROM i),
        f AS (SELECT g, i, turn, role, text, pair, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND cut AS truncated FROM j),
        r AS (SELECT g, i, role, text, blank OR duplicate AS drop_, CASE WHEN truncated THEN 1 ELSE 0 END AS extra FROM f),
        b AS (SELECT g, max(i) + 1 AS i, {last} FROM r GROUP BY g
              UNION ALL
              SELECT g, i, {', '.join(full(s) for s in range(4))} FROM (
                  SELECT r.g, r.i, {', '.join(own(s) for s in range(4))} FROM b JOIN r ON r.g = b.g AND r.i = b.i - 1)),
        n AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
              count_if(truncated) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY g),
        c AS (SELECT DISTINCT conv_id, g FROM d)
        SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
               CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost,
               coalesce(s0.a, '') AS audit, sha256(coalesce(substr(s0.r, 2), '')) AS repaired_sha256
        FROM c LEFT JOIN n USING (g) LEFT JOIN (SELECT g, s0 FROM b WHERE i = 1) USING (g)"""


def sharding_sql(shards: int = 8) -> str:
    """Running sizes as a list; a binary search over capacities, each tried by a greedy fill."""
    def fill(capacity: str, from_: str) -> str:
        return f"coalesce(list_max(list_filter(ends, lambda e: e <= {from_} + {capacity})), 0)"

    tried = f"list_reduce(list_prepend(CAST(0 AS BIGINT), range({shards})), lambda x, k: {fill('middle', 'x')})"
    cuts = [f"k1 AS (SELECT ends, least_, [{fill('least_', '0')}] AS cuts FROM sizes, (SELECT low AS least_ FROM search WHERE low = high))"]
    for k in range(2, shards):
        cuts.append(f"k{k} AS (SELECT ends, least_, list_append(cuts, {fill('least_', f'cuts[{k - 1}]')}) AS cuts FROM k{k - 1})")
    return f"""WITH RECURSIVE {_TABLE},
        d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, {_crc32("coalesce(text, '')")} AS text_crc32,
              sha256(coalesce(text, '')) AS key FROM documents, crc_table),
        g AS (SELECT key, CAST(sum(sum(size)) OVER (ORDER BY key) AS BIGINT) AS end_ FROM d GROUP BY key),
        sizes AS (SELECT list(end_ ORDER BY end_) AS ends, max(end_) AS total FROM g),
        search AS (SELECT CAST(0 AS BIGINT) AS low, total AS high FROM sizes
                   UNION ALL
                   SELECT CASE WHEN enough THEN low ELSE middle + 1 END, CASE WHEN enough THEN middle ELSE high END
                   FROM (SELECT low, high, middle, {tried} >= total AS enough
                         FROM (SELECT low, high, (low + high) // 2 AS middle FROM search WHERE low < high), sizes)),
        {", ".join(cuts)},
        p AS (SELECT doc_id, size, text_crc32, key, CAST(len(list_filter(cuts, lambda c: c < end_)) AS INTEGER) AS shard FROM d JOIN g USING (key), k{shards - 1})
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY key, doc_id NULLS FIRST) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM p"""


ORACLES = {
    "op11_merkle": merkle_sql(),
    "op12_conversations": repair_sql(),
    "op13_sharding": sharding_sql(),
}
