"""The queries opN_<name>: each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitslice, chat, decontam, fingerprints, merkle, minhash, packing, quality, resample, secret_scan, shards, token_store, toxicity
from .common import read
from .learning import may_learn

#: The tokenizer of the token queries.
TOKENIZER = "word_bpe_49k.json"

# --- 1 ---


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = "</s>[INST] ok [/INST]"
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    out = chat.format_chats(rows.union(extra).withColumn("parts", chat.text_parts(F.col("text"))))
    turns = chat.parsed_turns(F.col("formatted"))
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat.loss_text(F.col("formatted"), F.col("loss"))
    return out.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP1_SQL = r"""
WITH m AS (
  SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, len(replace(replace(replace(replace(role, '\', '\e'), '<', '\l'), '[', '\b'), chr(10), '\n'))
    + len(replace(replace(replace(text, '\', '\e'), '<', '\l'), '[', '\b')) + 8 AS shown FROM m
), g AS (
  SELECT conv_id, count(*) AS n_turns, sum(shown)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS flat,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '') AS learned
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, len(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM g
"""

# --- 2 ---


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shards.shard_by_bytes(read(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


# --- 3 ---


def op3_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out rows lend no label. A row is kept unless its score is under 0.5."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    out = quality.scored(docs, quality.fitted(docs, labels))
    return out.select("doc_id", F.coalesce(~may_learn(), F.lit(False)).alias("held_out"), "content_score", "meta_score", F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))


# --- 4 ---


def op4_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), n=5, percent=75)


# --- 5 ---


def op5_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.packed(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1, length=2048, with_ids=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "window")


# --- 6 ---


def op6_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the store, then asks its index for every document and reads each one's ids back."""
    docs = read(spark, sf_dir, "documents")
    store = token_store.write_store(docs, "doc_id", token_store.new_store_path(spark), public_tokenizers.path(TOKENIZER), end_id=2)
    ids = token_store.fetch(store, token_store.lookup(store, token_store.numbered(docs, "doc_id")))
    rows = token_store.ids_crc(ids, store.width, ["key", "shard", "at", "length"])
    return rows.join(store.shards, "shard").select(F.col("key").alias("doc_id"), (F.col("tokens_before") + F.col("at")).cast("long").alias("start"), F.col("length").alias("n_tokens"), "ids_crc32")


# --- 7 ---


def op7_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared_with_next(read(spark, sf_dir, "documents"))


# --- 8 ---


def op8_latent_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


# --- 9 ---


def op9_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    out = toxicity.scored(docs, toxicity.fitted(docs, labels))
    return out.select("doc_id", F.coalesce(~may_learn(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.col("sentences").alias("toxic_sentences"))


# --- 10 ---


def op10_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read(spark, sf_dir, "documents"))


# --- 11 ---


def op11_bitslice_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(read(spark, sf_dir, "embeddings"), k=5, every=50).select("query_id", "rank", "vec_id", "score")


OP11_SQL = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q, row_number() OVER () AS nth FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, a.nth AS asker, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND a.nth <> b.nth
), r AS (
  SELECT *, row_number() OVER (PARTITION BY asker ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s
)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM r WHERE place <= 5
"""

# --- 12 ---


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id has a crc32 that 7 divides are tampered with: one more in n_chars."""
    more = merkle.leaf(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, more)
    out = merkle.manifest(read(spark, sf_dir, "documents"), tampered)
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "lang_no", "position")


#: crc32 of an ASCII string {s}, bit by bit; DuckDB has no function for it.
ASCII_CRC32_SQL = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen({s}) + 1), lambda i: ascii(substr({s}, i, 1))::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

_LEAF_SQL = "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "{n_chars}", "text")) + ")"

OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id::BIGINT AS id, doc_id::VARCHAR AS doc_id, source, lang, n_chars::VARCHAR AS n_chars, (n_chars + 1)::VARCHAR AS more, text FROM documents
), l AS (
  SELECT id, lang, {_LEAF_SQL.format(n_chars="n_chars")} AS leaf, CASE WHEN coalesce({ASCII_CRC32_SQL.format(s="doc_id")} % 7 = 0, false) THEN {_LEAF_SQL.format(n_chars="more")} END AS tampered FROM d
), p AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY id NULLS FIRST, leaf) - 1 AS pos,
    ceil(log2(count(*) OVER (PARTITION BY lang)))::INTEGER AS deep FROM l
), nodes AS (
  SELECT 0 AS k, tree, pos AS node, deep, leaf AS h FROM p
  UNION ALL SELECT k + 1, tree, node >> 1, deep, sha256(string_agg(h, '' ORDER BY node)) FROM nodes WHERE k < deep GROUP BY k, tree, node >> 1, deep
), subroots AS (
  SELECT tree, h, ceil(log2(count(*) OVER ()))::INTEGER AS deep FROM nodes WHERE k = deep
), tops AS (
  SELECT 0 AS k, tree AS node, deep, h FROM subroots
  UNION ALL SELECT k + 1, node >> 1, deep, sha256(string_agg(h, '' ORDER BY node)) FROM tops WHERE k < deep GROUP BY k, node >> 1, deep
), every AS (
  SELECT k, tree, node, h, deep AS last FROM nodes UNION ALL SELECT 1000 + k, -1, node, h, 1000 + deep FROM tops
), walk AS (
  SELECT id, tree AS own, pos, leaf, tree, pos AS spot, 0 AS k, deep AS last, '' AS proof, coalesce(tampered, leaf) AS fold FROM p
  UNION ALL SELECT w.id, w.own, w.pos, w.leaf, CASE WHEN w.k = w.last THEN -1 ELSE w.tree END, CASE WHEN w.k = w.last THEN w.own ELSE w.spot >> 1 END, CASE WHEN w.k = w.last THEN 1000 ELSE w.k + 1 END,
    CASE WHEN w.k = w.last THEN (SELECT 1000 + max(deep) FROM subroots) ELSE w.last END, CASE WHEN w.k = w.last THEN w.proof ELSE w.proof || coalesce(s.h, '') END,
    CASE WHEN w.k = w.last THEN w.fold WHEN w.spot & 1 = 1 THEN sha256(s.h || w.fold) ELSE sha256(w.fold || coalesce(s.h, '')) END
  FROM walk AS w LEFT JOIN every AS s ON s.tree = w.tree AND s.k = w.k AND s.node = xor(w.spot, 1) WHERE w.k < w.last OR w.tree >= 0
)
SELECT w.id AS doc_id, w.leaf, r.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.fold AS folded_root, w.fold = t.h AS verified, w.own AS lang_no, w.pos AS position
FROM walk AS w JOIN subroots AS r ON r.tree = w.own JOIN tops AS t ON t.k = t.deep WHERE w.tree = -1 AND w.k = w.last
"""

# --- 13 ---


def op13_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), percent=10, least=20, buckets=10_000, n=1, seed=2024)


OP13_SQL = r"""
WITH tab AS MATERIALIZED (
  SELECT list(list_reduce(list_concat([i], range(8)), lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) ORDER BY i) AS t FROM range(256) AS r(i)
), w AS MATERIALIZED (
  SELECT which, nth, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM (SELECT 's' AS which, row_number() OVER () AS nth, doc_id AS id, text FROM documents UNION ALL SELECT 't', 0, NULL, text FROM benchmark)
), u AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, strlen(word) + 1), lambda i: ('0x' || substr(hex(encode(word)), 2 * i - 1, 2))::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM w), tab
), b AS (
  SELECT bucket, count(*) FILTER (WHERE which = 's')::DOUBLE AS s, count(*) FILTER (WHERE which = 't')::DOUBLE AS t FROM w JOIN u USING (word) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM b) + 10000) / ((s + 1) * ((SELECT sum(t) FROM b) + 10000))))::BIGINT AS gain FROM b
), d AS (
  SELECT nth, id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM w JOIN u USING (word) JOIN g USING (bucket) WHERE which = 's' GROUP BY nth, id
), a AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM (SELECT doc_id, row_number() OVER () AS nth FROM documents) AS o LEFT JOIN d USING (nth)
), r AS (
  SELECT *, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id) AS place, 10 * count(*) FILTER (WHERE n_features >= 20) OVER () // 100 AS k FROM a
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= k THEN place END AS rank FROM r
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_byte_shards,
        op3_cotraining_quality,
        op4_minmax_dedup,
        op5_mixture_packing,
        op6_token_index,
        op7_chunk_fingerprints,
        op8_latent_decontam,
        op9_mil_toxicity,
        op10_entropy_secrets,
        op11_bitslice_topk,
        op12_merkle_manifest,
        op13_importance_resample,
    )
}

ORACLE_SQL: dict[str, str] = {"op1_chat_format": OP1_SQL, "op11_bitslice_topk": OP11_SQL, "op12_merkle_manifest": OP12_SQL, "op13_importance_resample": OP13_SQL}
