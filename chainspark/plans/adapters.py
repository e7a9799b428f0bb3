"""Genome-shaped views of general tables, in Spark and as SQL text.

The test tables hold no genomes. These views give their columns the shapes that the operators take;
each has a twin in SQL, so that both engines start from the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import flat
from ..scratch import small_batches

_LOW = "abcdefghijklmnopqrstuvwxyz"
_TO_BASES = ("ACGT" * 7)[:26]
_FROM, _TO = f"{_LOW}{_LOW.upper()} ", f"{_TO_BASES}{_TO_BASES.lower()}A"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sizes(spark: SparkSession, d: str) -> DataFrame:
    """Documents as chromosomes: their lengths."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("chrom"), F.col("n_chars").alias("size"), F.col("doc_id").alias("ord"))


SIZES_SQL = "sizes AS (SELECT doc_id AS chrom, n_chars AS size, doc_id AS ord FROM documents)"


def query_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Pages as the query's chromosomes."""
    return table(spark, d, "pages").select(F.col("page_id").alias("chrom"), F.length("html").cast("long").alias("size"), F.col("page_id").alias("ord"))


QUERY_SIZES_SQL = "query_sizes AS (SELECT page_id AS chrom, length(html)::BIGINT AS size, page_id AS ord FROM pages)"


_BASE = np.full(256, ord("N"), dtype=np.uint8)
_BASE[list(_FROM.encode())] = list(_TO.encode())


def _bases(text):
    """Each character as a base, a batch's bytes at once."""

    def run(texts: pa.Array) -> pa.Array:
        raw, ends = flat(texts)
        begins = (raw[: ends[-1]] & 0xC0) != 0x80  # a character's first byte
        upto = np.append(0, np.cumsum(begins))[ends]
        bases = _BASE[raw[: ends[-1]][begins]]
        got = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(upto.astype(np.int64).tobytes()), pa.py_buffer(bases.tobytes())).cast(pa.string())
        return pc.if_else(texts.is_valid(), got, pa.scalar(None, pa.string()))

    return F.arrow_udf(run, "string")(text)


def _bases_sql(text: str) -> str:
    return f"replace(translate(regexp_replace({text}, '[^A-Za-z ]', '#', 'g'), '{_FROM}', '{_TO}'), '#', 'N')"


def genome(spark: SparkSession, d: str) -> DataFrame:
    """Documents as sequences: letters and blanks become bases, capitals masked ones, all else N."""
    return small_batches(table(spark, d, "documents")).select(F.col("doc_id").alias("chrom"), _bases(F.col("text")).alias("seq"))


GENOME_SQL = f"genome AS (SELECT doc_id AS chrom, {_bases_sql('text')} AS seq FROM documents)"


def query_genome(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items as the query's sequences; documents hold some of them."""
    return small_batches(table(spark, d, "benchmark")).select(F.col("item_id").alias("chrom"), _bases(F.col("text")).alias("seq"))


QUERY_GENOME_SQL = f"query_genome AS (SELECT item_id AS chrom, {_bases_sql('text')} AS seq FROM benchmark)"


def present(spark: SparkSession, d: str) -> DataFrame:
    """Chromosomes that have alignments: the parts that lineitems name."""
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("chrom")).distinct()


PRESENT_SQL = "present AS (SELECT DISTINCT l_partkey AS chrom FROM lineitem)"


def blocks(spark: SparkSession, d: str, of: DataFrame | None = None) -> DataFrame:
    """Orders as chains, their lines as blocks; only chains in `of` (cid), if given, are shuffled."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    # named before the window, so that what goes by cid afterwards finds its rows in place; only columns of the table are shuffled
    w = Window.partitionBy("cid").orderBy(*order)
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cid"), *order)
    rows = rows if of is None else rows.join(of, "cid", "left_semi")
    rows = rows.select("*", F.row_number().over(w).cast("long").alias("i"), F.lead("cid").over(w).isNull().alias("last"))
    gap = lambda key, c: F.when(F.col("last"), F.lit(0)).otherwise(F.col(key) % 50).cast("long").alias(c)
    return rows.select("cid", "i", F.col("l_quantity").cast("long").alias("size"), gap("l_partkey", "dt"), gap("l_suppkey", "dq"))


BLOCKS_SQL = """raw_blocks AS (
  SELECT l_orderkey AS cid, row_number() OVER w AS i, lead(l_orderkey) OVER w IS NULL AS last_one,
    l_quantity::BIGINT AS size, l_partkey % 50 AS dt, l_suppkey % 50 AS dq
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)
), blocks AS (SELECT cid, i, size, CASE WHEN last_one THEN 0 ELSE dt END::BIGINT AS dt, CASE WHEN last_one THEN 0 ELSE dq END::BIGINT AS dq FROM raw_blocks)"""


def headers(spark: SparkSession, d: str) -> DataFrame:
    """Lines as chain headers; odd orders are the candidate set, even ones the baseline."""
    n = F.col("l_quantity").cast("long") * 10
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("long")
    key = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], cents.cast("string"), F.col("l_quantity").cast("long").cast("string"))
    t, q = F.col("l_partkey") * 100, F.col("l_suppkey") * 1000
    return table(spark, d, "lineitem").select(
        key.alias("id"), F.floor(F.col("l_extendedprice") + 0.5).cast("long").alias("score"), F.col("l_returnflag").alias("t_name"), F.lit("+").alias("t_strand"), t.alias("t_start"), (t + n).alias("t_end"),
        F.col("l_linestatus").alias("q_name"), F.when(F.col("l_linenumber") % 3 == 0, "-").otherwise("+").alias("q_strand"), q.alias("q_start"), (q + n).alias("q_end"), (F.col("l_orderkey") % 2 == 1).alias("candidate"),
    )


HEADERS_SQL = """headers AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(l_extendedprice * 100 + 0.5)::BIGINT, l_quantity::BIGINT) AS id,
    floor(l_extendedprice + 0.5)::BIGINT AS score, l_returnflag AS t_name, '+' AS t_strand,
    l_partkey * 100 AS t_start, l_partkey * 100 + l_quantity::BIGINT * 10 AS t_end, l_linestatus AS q_name,
    CASE WHEN l_linenumber % 3 = 0 THEN '-' ELSE '+' END AS q_strand,
    l_suppkey * 1000 AS q_start, l_suppkey * 1000 + l_quantity::BIGINT * 10 AS q_end, l_orderkey % 2 = 1 AS candidate
  FROM lineitem
), baseline AS (SELECT * FROM headers WHERE NOT candidate), candidates AS (SELECT * FROM headers WHERE candidate)"""

#: The comparison's condition: same names and strands, overlap on both axes, the baseline widened.
MATCH_SQL = """EXISTS (SELECT 1 FROM candidates c WHERE c.t_name = b.t_name AND c.q_name = b.q_name AND c.t_strand = b.t_strand AND c.q_strand = b.q_strand
    AND greatest(b.t_start - {tol}, c.t_start) < least(b.t_end + {tol}, c.t_end) AND greatest(b.q_start - {tol}, c.q_start) < least(b.q_end + {tol}, c.q_end))"""


def psl(spark: SparkSession, d: str) -> DataFrame:
    """Lines with their part and supplier as alignment rows."""
    li, p, s = (table(spark, d, t) for t in ("lineitem", "part", "supplier"))
    n = F.col("l_quantity").cast("long")
    rows = li.join(p.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).join(s.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5).cast("long")
    return rows.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")], cents.cast("string"), n.cast("string")).alias("id"),
        F.col("p_brand").alias("t_name"), F.concat(F.lit("q"), F.col("s_nationkey").cast("string")).alias("q_name"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        (F.col("l_partkey") * 100).alias("t_start"), (F.col("l_partkey") * 100 + n).alias("t_end"), (F.col("l_suppkey") * 1000).alias("q_start"), n.alias("matches"),
    )


PSL_SQL = """psl AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, floor(l_extendedprice * 100 + 0.5)::BIGINT, l_quantity::BIGINT) AS id,
    p_brand AS t_name, 'q' || s_nationkey AS q_name, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
    l_partkey * 100 AS t_start, l_partkey * 100 + l_quantity::BIGINT AS t_end, l_suppkey * 1000 AS q_start, l_quantity::BIGINT AS matches
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def anchors(spark: SparkSession, d: str) -> DataFrame:
    """Events as anchors: time on the target, value on the query, one group a user and type."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("t_name"), F.col("event_type").alias("q_name"), F.lit("+").alias("q_strand"), F.col("event_id").alias("aid"),
        (F.unix_seconds(F.col("ts").cast("timestamp")) / 60).cast("long").alias("t"), F.floor(F.coalesce("value", F.lit(0.0)) * 100).cast("long").alias("q"), F.lit(20).cast("long").alias("size"),
    )
