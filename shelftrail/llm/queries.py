"""The registered queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelftrail.llm import (
    conversations, exact_dedup, jaccard_join, language_id, merkle, nearest, oracles, packing, quality, secret_scan, sentencepiece_codec, sharding,
    substring_dedup, token_frames,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(_documents(spark, sf_dir), window=50)
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), budget=32768, buckets=8)


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.jaccard_join(_documents(spark, sf_dir), size=3, least=90, of=100)
    return out.select("doc_id", "n_shingles", "component_id", "n_links")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    fold = F.coalesce(language_id.fold(), F.lit(-1))
    model = language_id.fit(docs.where(fold.isin(0, 1, 3)))
    return language_id.predict(docs, model).select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def _tokenizer(name: str) -> str:
    """Place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_codec.round_trip(_documents(spark, sf_dir), _tokenizer("piece_bpe_32k.model"))
    return out.select(
        "doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    out = secret_scan.scan(docs, secret_scan.fit(docs))
    listed = "concat_ws(',', transform({}, x -> concat_ws(':', x.kind, x.start, x.end)))"
    counts = [F.expr(f"cast(size(filter(found, x -> x.kind = '{k}')) as long)").alias(f"n_{k}") for k in secret_scan.KINDS]
    base = F.expr(listed.format("filter(found, x -> x.kind <> 'random')"))
    return out.select("doc_id", *counts, F.sha2(base.cast("binary"), 256).alias("base_sha256"), F.expr(listed.format("found")).alias("spans"))


def op9_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    files = token_frames.write_tokens(docs, token_frames.new_folder(docs), _tokenizer("word_bpe_49k.json"), end_id=2)
    return token_frames.read_tokens(files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, merkle.leaf_hash(*fields, F.translate("text", upper, lower)),
    )
    out = merkle.proofs(_documents(spark, sf_dir), F.col("lang"), F.col("doc_id"), merkle.leaf_hash(*fields, F.col("text")), tampered)
    return out.withColumnRenamed("id", "doc_id")


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.plain(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn"))
    draw = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return conversations.repair(conversations.damaged(rows, draw), rows).withColumnRenamed("conv", "conv_id")


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(_documents(spark, sf_dir), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality": op4_quality,
    "op5_language_id": op5_language_id,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_secret_scan": op8_secret_scan,
    "op9_token_frames": op9_token_frames,
    "op10_nearest": op10_nearest,
    "op11_merkle": op11_merkle,
    "op12_conversations": op12_conversations,
    "op13_sharding": op13_sharding,
}

def _packing_sql(buckets: int = 8, budget: int = 32768) -> str:
    """The dynamic program as one CTE per bucket: c<k>(j, cost, came) over the distinct lengths 0..j."""
    levels = ["""c1 AS (SELECT j, ends * rows - tokens AS cost, 0 AS came FROM h)"""]
    for k in range(2, buckets + 1):
        levels.append(f"""
        t{k} AS (SELECT b.j, min(a.cost + b.ends * (b.rows - x.rows) - (b.tokens - x.tokens)) AS cost,
                 arg_min(a.j, (a.cost + b.ends * (b.rows - x.rows) - (b.tokens - x.tokens)) * 1000000 + a.j) AS came
                 FROM h b JOIN c{k - 1} a ON a.j < b.j JOIN h x ON x.j = a.j GROUP BY b.j),
        c{k} AS (SELECT j, least(c.cost, coalesce(t.cost, c.cost)) AS cost, CASE WHEN t.cost < c.cost THEN t.came ELSE 0 END AS came
                 FROM c{k - 1} c LEFT JOIN t{k} t USING (j))""")
    walk = [f"e{buckets} AS (SELECT max(j) AS j FROM h)"]
    for k in range(buckets, 1, -1):
        walk.append(f"e{k - 1} AS (SELECT CASE WHEN came > 0 THEN came ELSE j END AS j FROM e{k} JOIN c{k} USING (j))")
    ends = " UNION ".join(f"SELECT j FROM e{k}" for k in range(1, buckets + 1))
    return f"""
        WITH d AS (SELECT doc_id, CAST(len({_WORDS}) AS BIGINT) AS n_tokens FROM documents),
        g AS (SELECT greatest(1, (count(*) + 49999) // 50000) AS slices FROM d),
        i AS (SELECT n_tokens AS ends, count(*) AS rows, sum(n_tokens) AS tokens FROM d GROUP BY 1),
        h AS (SELECT row_number() OVER w AS j, ends, sum(rows) OVER w AS rows, sum(tokens) OVER w AS tokens FROM i WINDOW w AS (ORDER BY ends)),
        {",".join(levels)}, {", ".join(walk)},
        b AS (SELECT row_number() OVER (ORDER BY ends) - 1 AS bucket, ends AS boundary FROM ({ends}) JOIN h USING (j)),
        p AS (SELECT doc_id, n_tokens, min(bucket) AS bucket, min(boundary) AS boundary, any_value(doc_id % slices) AS slice
              FROM d JOIN b ON n_tokens <= boundary, g GROUP BY doc_id, n_tokens),
        r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY slice, doc_id) - 1 AS place,
              greatest(1, {budget} // greatest(boundary, 1)) AS per FROM p)
        SELECT doc_id, n_tokens, CAST(bucket AS INTEGER) AS bucket, boundary, place // per AS batch, place % per AS slot FROM r"""


_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLES = {
    **oracles.ORACLES,
    "op1_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        p AS (SELECT doc_id, unnest(generate_series(1, len(w) - 49)) AS s, w FROM d WHERE len(w) >= 50),
        g AS (SELECT doc_id, s, array_to_string(list_slice(w, s, s + 49), ' ') AS t FROM p),
        m AS (SELECT t, min(doc_id) AS least FROM g GROUP BY t),
        r AS (SELECT doc_id, list(s ORDER BY s) AS hits FROM g JOIN m USING (t) WHERE least < doc_id GROUP BY doc_id),
        c AS (SELECT DISTINCT doc_id, unnest(generate_series(s, s + 49)) AS i FROM g JOIN m USING (t) WHERE least < doc_id),
        n AS (SELECT doc_id, count(*) AS n_removed FROM c GROUP BY doc_id),
        k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM
              (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM d) ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op2_packing": _packing_sql(),
    "op3_jaccard_join": f"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
        g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, s, s + 2), ' ') AS t
              FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS s FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        j AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM g a JOIN g b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM j JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
        r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
        c AS (SELECT x AS doc_id, min(y) AS least FROM r GROUP BY x),
        k AS (SELECT x AS doc_id, count(*) AS n_links FROM l GROUP BY x)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(coalesce(least, doc_id), doc_id) AS component_id, coalesce(n_links, 0) AS n_links
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)""",
    "op7_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS c, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
        SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               row_number() OVER g = 1 AS kept, sha256(t) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY t ORDER BY c DESC, doc_id)""",
}
