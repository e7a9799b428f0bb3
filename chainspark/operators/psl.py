"""Pairwise alignment rows: grouping by reference, sorted merges, and conversion from aligned blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ordering
from ..functions.text import bucket_key
from ..scratch import small_batches

_UPPER = np.frombuffer(bytes(range(256)).upper(), dtype=np.uint8)
_MASKED = np.isin(np.arange(256), list(b"acgt"))


def by_bucket(rows: DataFrame) -> DataFrame:
    """(bucket, alignments, matches) of rows with the reference partition `part` they came from."""
    return rows.groupBy(bucket_key(F.col("part")).alias("bucket")).agg(F.count("*").alias("alignments"), F.sum("matches").cast("long").alias("matches"))


def split_by_reference(psl: DataFrame, tasks: int | None = None) -> DataFrame:
    """`psl` dealt by reference chromosome, for a write with `partitionBy("t_name")`."""
    n = tasks or int(psl.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return psl.repartition(n, "t_name", F.floor(F.col("t_start") / 10_000_000))


def totals_by_reference(psl: DataFrame) -> DataFrame:
    return psl.groupBy("t_name").agg(F.count("*").alias("alignments"), F.min("t_start").alias("first"), F.max("t_end").alias("last"), F.sum("matches").cast("long").alias("matches"))


def merge_sorted(*parts: DataFrame) -> DataFrame:
    """The union, ordered by reference: a range-partitioned sort."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("t_name", "t_start", "t_end", "q_name", "q_start")


def ranked(psl: DataFrame) -> DataFrame:
    """`psl` with its place (from 0) in the merge by reference: (t_name, t_start, t_end, q_name, q_start, id)."""
    return ordering.ranked(psl, [F.col(c) for c in ("t_name", "t_start", "t_end", "q_name", "q_start", "id")])


def _compared(t: pd.Series, q: pd.Series) -> pd.DataFrame:
    """Counts of equal, other, masked and unknown pairs of two strings side by side; a blank on the query is no base."""
    out = []
    for a, b in zip(t, q, strict=True):
        x, y = (np.frombuffer(s.encode(), dtype=np.uint8) for s in (a, b))
        masked = int(_MASKED[x].sum())
        x, y = _UPPER[x], _UPPER[y]
        unknown, same = (x == 78) | (y == 78), x == y
        out.append((int((same & ~unknown).sum()), int((~same & ~unknown & (y != 32)).sum()), masked, int(unknown.sum())))
    return pd.DataFrame(out, columns=["matches", "mismatches", "rep_matches", "n_count"])


def from_blocks(alignments: DataFrame) -> DataFrame:
    """PSL rows from aligned blocks with sequences.

    alignments: (q_name, q_size, strand, t_name, t_size, blocks array<struct<t,q,size,t_seq,q_seq>>),
    q on the strand. A projection: counts come from comparing the block sequences base by base, as bytes of
    an alignment's joined sequences.
    """
    # the query's bases are cut or filled up with blanks to the target's, block by block
    t_all = F.array_join(F.transform("blocks", lambda b: b["t_seq"]), "")
    q_all = F.array_join(F.transform("blocks", lambda b: F.rpad(b["q_seq"], F.length(b["t_seq"]), " ")), "")
    rows = small_batches(alignments).withColumn("_c", F.pandas_udf(_compared, "matches long, mismatches long, rep_matches long, n_count long")(t_all, q_all))
    n = F.size("blocks")
    step = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: i)
    gap = lambda c: F.transform(F.filter(step, lambda i: i < n), lambda i: F.get(F.col("blocks"), i)[c] - F.get(F.col("blocks"), i - 1)[c] - F.get(F.col("blocks"), i - 1)["size"])
    total = lambda c: F.aggregate(gap(c), F.lit(0).cast("long"), lambda a, x: a + x)
    some = lambda c: F.size(F.filter(gap(c), lambda x: x > 0)).cast("long")
    first, last = F.get(F.col("blocks"), F.lit(0)), F.get(F.col("blocks"), n - 1)
    q_lo, q_hi = first["q"], last["q"] + last["size"]
    return rows.select(
        "_c.*",
        some("q").alias("q_num_insert"),
        total("q").alias("q_base_insert"),
        some("t").alias("t_num_insert"),
        total("t").alias("t_base_insert"),
        "strand",
        "q_name",
        "q_size",
        F.when(F.col("strand") == "-", F.col("q_size") - q_hi).otherwise(q_lo).alias("q_start"),
        F.when(F.col("strand") == "-", F.col("q_size") - q_lo).otherwise(q_hi).alias("q_end"),
        "t_name",
        "t_size",
        first["t"].alias("t_start"),
        (last["t"] + last["size"]).alias("t_end"),
        n.cast("long").alias("block_count"),
        F.transform("blocks", lambda b: b["size"]).alias("block_sizes"),
        F.transform("blocks", lambda b: b["q"]).alias("q_starts"),
        F.transform("blocks", lambda b: b["t"]).alias("t_starts"),
    )
