"""Positions under a global order: rows are range-sorted once and numbered where they lie.

`repartitionByRange` deals the rows by ranges of the whole order, each range is sorted, and Spark's own
row ids count on inside a range; the totals of the ranges, at most one row a range and group, give
each range's start. No window sees rows, and no second shuffle is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, tasks


def range_sorted(df: DataFrame, order: list[Column], scratch: Scratch, name: str, parts: int | None = None) -> DataFrame:
    """`df` as a table sorted by `order`, with `_at`: range number times 2^33 plus the place in the range."""
    n = parts or tasks(df.sparkSession)
    return scratch.keep(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), name)


def range_starts(dealt: DataFrame, group: list[str]) -> DataFrame:
    """(group, _range, _rows, _shift) for each range and group: `_at` + `_shift` is the position in the group, from 0."""
    totals = dealt.groupBy(*group, F.shiftright("_at", 33).alias("_range")).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    w = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*group, "_range", "_rows", (F.coalesce(F.sum("_rows").over(w), F.lit(0)) - F.col("_first")).alias("_shift"))


def with_starts(dealt: DataFrame, starts: DataFrame, group: list[str]) -> DataFrame:
    """Each row of `dealt` beside the row of `starts` of its range and group; nulls are a group."""
    s = starts.select(*[F.col(g).alias(f"_g_{g}") for g in group], *[c for c in starts.columns if c not in group])
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group], F.shiftright("_at", 33) == F.col("_range"))
    return dealt.join(s, same).drop("_range", *[f"_g_{g}" for g in group])


def positions(df: DataFrame, order: list[Column], scratch: Scratch, name: str, parts: int | None = None) -> DataFrame:
    """`df` with `idx`, its place under `order`, from 0. Ties are broken somehow, once."""
    dealt = range_sorted(df, order, scratch, name, parts)
    return with_starts(dealt, range_starts(dealt, []), []).select(*df.columns, (F.col("_at") + F.col("_shift")).alias("idx"))
