"""A training corpus from `documents`: low quality goes, one document of each group of near copies stays,
benchmark passages go, secrets are blotted out, and what is left is packed into sequences.

STAGES lists (name, function). A function takes (spark, docs, sf_dir) and returns a DataFrame; all but
the last return the columns of `documents`. Each works on every row and the whole text of what its
predecessor kept.

Stages that compare rows number them first (a table in the shared folder), so each decision is on a row,
whatever its doc_id is. `run` writes each stage's result before the next one begins.

Edge cases, in every stage: null texts are empty texts; rows without a doc_id, and rows that share one, are
judged each by its own text, and of equal texts one row stays; empty tables pass through; further
columns of `documents` are left out.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainspark.llm import decontam, minhash, packing, quality, secret_scan
from chainspark.scratch import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "word_bpe_49k.json"


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier scores under 0.5 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.select(COLUMNS)
    return quality.scored(rows, quality.fitted(rows, labels)).where("quality_score >= 0.5").select(COLUMNS)


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows with a number each, written once so that every later read sees the same numbers."""
    return Scratch(spark, "rows").keep(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row")), "rows")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays; rows without a doc_id come last."""
    rows = numbered(spark, docs)
    groups = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    stay = groups.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(F.min(first).alias("first")).select("first.row")
    return rows.join(stay, "row", "left_semi").select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    rows = numbered(spark, docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    bad = decontam.contaminated(rows.select(F.col("row").alias("doc_id"), "text"), benchmark).where("contaminated").select(F.col("doc_id").alias("row"))
    return rows.join(bad, "row", "left_anti").select(COLUMNS)


def blot_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets inside texts are replaced; every document stays."""
    return secret_scan.redact(docs.select(COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids, mixed by source."""
    return packing.packed(docs, public_tokenizers.path(TOKENIZER), end_id=1, length=2048)


STAGES = [
    ("quality", keep_quality),
    ("minhash_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", blot_secrets),
    ("packing", pack),
]

#: Trained models and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
