"""Incremental ingest of chain files: each file is taken once, and running totals follow."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.chain_text import _fields


def header_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of the chain files that arrive in a folder."""
    rows = spark.readStream.format("text").load(folder).where(F.col("value").startswith("chain "))
    return rows.select(*_fields(F.substring("value", 7, 2**31 - 1)))


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the headers of all files not seen yet to a Parquet table, then ends."""
    return header_stream(spark, folder).writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def totals(headers: DataFrame) -> DataFrame:
    """Chains and scores by reference chromosome; works on a stream and on a table."""
    return headers.groupBy("t_name").agg(F.count("*").alias("chains"), F.max("score").alias("best"), F.sum("score").alias("score"))
