"""Contiguous shards of near-equal byte size, in DataFrame functions only.

Documents keep their doc_id order. Rows are dealt into key ranges; totals by range give each
range's global start (prefix sums of the totals), a running sum inside the range gives each
document's, and equal byte targets cut the whole order into shards: a document goes to the shard
that holds its middle byte. Texts are read once, for (doc_id, size, crc32); all else works on that.

Edge cases: a null text has no bytes (size 1) and crc32 0; null doc_id sorts first; rows with one
doc_id sort by crc32, then size (rows equal in all three are alike, so any order is the same
result); one doc_id with very many rows is dealt by crc32 as well, and so are rows without one; an empty table gives no rows;
further columns are ignored. Equal texts are not held together: this law cuts by bytes alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, group_starts, key_cuts, range_of, tasks

#: Ranges by crc32 of one very frequent doc_id, and of rows without one.
TIES = 16


def shard_by_bytes(documents: DataFrame, shards: int = 8, ranges: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, start_byte): `start_byte` counts all bytes before it."""
    spark = documents.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = Scratch(spark, "shards").keep(documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit(1).cast("long").alias("one")), "sizes")
    cuts = key_cuts(rows, "doc_id", ranges or 4 * tasks(spark, 16))
    tie = F.floor(F.col("text_crc32") * TIES / 2**32).cast("long")
    # by ranges of doc_id, and inside a doc_id by ranges of its texts' checksums: the order is (doc_id, crc32)
    at_cut = F.col("doc_id").isin(cuts) if cuts else F.lit(False)
    known = F.lit(2 * TIES) * (1 + range_of("doc_id", cuts)) + F.when(at_cut, TIES + tie).otherwise(F.lit(0))
    part = F.when(F.col("doc_id").isNull(), tie).otherwise(known).cast("long")
    rows = rows.withColumn("part", part)
    totals = rows.groupBy("part").agg(F.sum("size").alias("size"), F.sum("one").alias("one"))
    starts = group_starts(totals, "part", ["size", "one"], groups=2 * TIES * (len(cuts) + 2))
    w = Window.partitionBy("part").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"in_{c}") for c in ("size", "one")])
    total = F.broadcast(totals.agg(F.sum("size").alias("all_bytes")))  # one row
    placed = (
        inner.join(starts, "part")
        .crossJoin(total)
        .select("doc_id", "size", "text_crc32", (F.col("in_size") + F.col("size_before")).alias("start_byte"), (F.col("in_one") + F.col("one_before")).alias("row"), "all_bytes")
        .withColumn("shard", F.least(F.lit(shards - 1), F.floor((F.col("start_byte") + F.col("size") / 2) * shards / F.col("all_bytes"))).cast("int"))
    )
    first = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("first_row")))  # a row a shard
    return placed.join(first, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"), "start_byte")
