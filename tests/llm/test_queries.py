"""The registered queries: columns and types of their contracts, and SQL where there is some."""

import os

import duckdb
import pandas as pd
import pytest

pytest.importorskip("public_tokenizers")
from chainspark.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
CONTRACT = {
    "op1_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op2_byte_shards": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op4_minmax_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op5_mixture_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_token_index": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7_chunk_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op9_mil_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op10_entropy_secrets": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_bitslice_topk": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op12_merkle_manifest": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_importance_resample": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}
#: The id column and the table of a query, where they aren't doc_id and documents; of it, the rows that are asked for.
IDS = {"op1_chat_format": ("conv_id", "conversations", "true"), "op11_bitslice_topk": ("query_id", "embeddings", "vec_id % 50 = 0")}


@pytest.mark.parametrize("name", list(QUERIES))
def test_contract(spark, name):
    out = QUERIES[name](spark, DATA)
    have = dict(out.dtypes)
    for column in filter(None, CONTRACT.get(name, "").split(", ")):
        c, kind = column.split()
        assert have[c] == kind
    ids, name_of, rows = IDS.get(name, ("doc_id", "documents", "true"))
    read = spark.read.parquet(f"{DATA}/{name_of}.parquet").where(rows)
    want = {r[0] for r in read.select(ids if ids in read.columns else "vec_id").distinct().collect()}
    assert {r[0] for r in out.select(ids).collect()} == want | ({-1} if ids == "conv_id" else set())


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_matches_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    got, want = QUERIES[name](spark, DATA).toPandas(), c.execute(ORACLE_SQL[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    plain = lambda df: sorted(tuple("" if pd.isna(v) else str(int(v) if isinstance(v, float) and v.is_integer() else v) for v in r) for r in df[cols].astype(object).to_numpy().tolist())
    assert plain(got) == plain(want)
