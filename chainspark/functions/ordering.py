"""Positions and running sums over a global order, without a window that sees the whole table.

Rows are dealt into value ranges of a leading column; totals by range give each range's start, and a
window inside the range gives the rest. The result is exact whatever the ranges are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch

#: Groups that one window may see when totals are summed; more are summed level by level.
FAN = 4096


def cuts(df: DataFrame, lead: str, parts: int) -> list[float]:
    """At most `parts` - 1 ascending values that cut the column into even ranges; a few numbers."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(F.col(lead).cast("double"), F.array(*map(F.lit, at)), F.lit(10 * parts)).alias("q")).first()["q"]
    return sorted(set(got or []))


def starts(totals: DataFrame, key: str, sums: list[str], fan: int = FAN) -> DataFrame:
    """Exclusive running sums over ascending integer `key`, one row a key."""
    top = totals.agg(F.max(key)).first()[0] or 0
    if top < fan:
        w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(key, *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"{s}_before") for s in sums])
    up = totals.withColumn("_up", F.floor(F.col(key) / fan).cast("long"))
    above = starts(up.groupBy("_up").agg(*[F.sum(s).alias(s) for s in sums]), "_up", sums, fan)
    w = Window.partitionBy("_up").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inner = up.select(key, "_up", *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_{s}") for s in sums])
    return inner.join(above, "_up").select(key, *[(F.col(f"_{s}") + F.col(f"{s}_before")).alias(f"{s}_before") for s in sums])


def indexed(df: DataFrame, lead: str, order: list[Column], sums: list[str] | None = None, descending: bool = False, parts: int | None = None) -> DataFrame:
    """`df` with `idx` (from 0) under `order`, and `<s>_before` for each of `sums`.

    `lead` is the numeric column that `order` begins with; `descending` says which way.
    """
    sums = sums or []
    n = parts or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    at = cuts(df, lead, n)
    below = F.size(F.filter(F.array(*[F.lit(float(x)) for x in at]), lambda x: x < F.col(lead))) if at else F.lit(0)
    rows = df.withColumn("_g", (F.lit(len(at)) - below if descending else below).cast("long")).withColumn("_one", F.lit(1).cast("long"))
    totals = rows.groupBy("_g").agg(*[F.sum(s).alias(s) for s in ["_one", *sums]])
    first = starts(totals, "_g", ["_one", *sums])
    w = Window.partitionBy("_g").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.select("*", *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_in_{s}") for s in ["_one", *sums]])
    out = inner.join(first, "_g")
    added = {"_one": "idx"} | {s: f"{s}_before" for s in sums}
    return out.select(*df.columns, *[(F.col(f"_in_{s}") + F.col(f"{s}_before")).cast("long").alias(name) for s, name in added.items()])


def ranked(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """`df` with `idx` (from 0) under any order, of strings too: rows are dealt by ranges of the whole order.

    The ranges come from a sample, so the dealt rows are written once, sorted and with Spark's row ids, which
    count on inside a range; what lies before a range is a row a range, which is broadcast. Rows are shuffled once.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = Scratch(spark, "ranked").keep(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    total = dealt.groupBy(F.shiftright("_at", 33).alias("_g")).agg(F.count("*").alias("_one"), F.min("_at").alias("_first"))
    first = total.select("_g", "_first").join(starts(total, "_g", ["_one"]), "_g").select(F.col("_g").alias("_range"), (F.col("_one_before") - F.col("_first")).alias("_shift"))
    return dealt.join(F.broadcast(first), F.shiftright("_at", 33) == F.col("_range")).select(*df.columns, (F.col("_at") + F.col("_shift")).cast("long").alias("idx"))
