"""Cleaning on the hierarchical net: pieces of chains that break a better one are cut out.

A suspect is a fill in a gap of a better chain, so it may be a small part of its own chain. It goes when
the chain that it breaks scores well on both sides of that gap compared with the suspect's own blocks, and
only it goes: its blocks are taken out, and what lies before and behind become chains of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.gaps import gap_cost
from ..scratch import Scratch

CHAIN = ["t_name", "id"]


def overlaps(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """(by, a, b) as structs for all rows that overlap, where in each group the rows [start, end) of either side are disjoint.

    Both sides are merged by their starts: a row overlaps the other side's last row before it, if that
    reaches so far, and those that begin inside it. One shuffle, no bins, however long the ranges are.
    """
    side = lambda df, mine, other, n: df.select(*by, "start", F.lit(n).alias("side"), F.struct(*df.columns).alias(mine), F.lit(None).cast(other.schema.simpleString()).alias("b" if mine == "a" else "a"))
    w = Window.partitionBy(*by).orderBy("start", "side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = side(b, "b", a, 0).unionByName(side(a, "a", b, 1))
    met = rows.select(*by, "start", "side", F.last("a", ignorenulls=True).over(w).alias("a"), F.last("b", ignorenulls=True).over(w).alias("b"))
    reach = F.when(F.col("side") == 1, F.col("b.end")).otherwise(F.col("a.end"))
    return met.where(reach > F.col("start")).select(*by, "a", "b")


def piece_scores(fills: DataFrame, blocks: DataFrame, per_base: int = 91, table: str = "loose") -> DataFrame:
    """`fills` with score: of the chain's blocks in the fill, clipped to it, less the gaps between them.

    fills: (t_name, id, start, end, ...); blocks: (t_name, id, i, start, end, dt, dq), the gap after a block.
    Only blocks of chains that have fills are merged with them.
    """
    blocks = blocks.join(fills.select(*CHAIN), CHAIN, "left_semi")
    pairs = overlaps(fills, blocks.select(*CHAIN, "i", "start", "end", "dt", "dq"), CHAIN)
    size = F.least("a.end", "b.end") - F.greatest("a.start", "b.start")
    cost = gap_cost(F.col("b.dt"), F.col("b.dq"), table)
    total = pairs.groupBy("a").agg(F.sum(size * per_base).alias("own"), F.sum(cost).alias("cost"), F.max_by(cost, F.col("b.i")).alias("last"))
    return total.select("a.*", (F.col("own") - F.col("cost") + F.col("last")).cast("long").alias("score"))


def breaking_pieces(net: DataFrame, blocks: DataFrame, flanks: DataFrame, heads: DataFrame, max_suspect: int = 100_000, min_broken: int = 75_000, per_base: int = 91, table: str = "loose") -> DataFrame:
    """(t_name, id, start, end, breaks, score, left_fold, right_fold) of the fills in gaps of better chains.

    net: of `net_levels`; flanks: (id, t_from, left, right), gaps by where they begin on the reference; heads: (id, score).
    """
    inner = net.where("kind = 'fill' AND parent IS NOT NULL").select(*CHAIN, "start", "end", F.col("parent").alias("breaks"), F.col("parent_gap").alias("t_from"))
    # a table, as fills are few beside blocks: what they choose of heads, flanks and blocks is chosen where those are read
    kept = Scratch(net.sparkSession, "inner")
    inner = kept.keep(inner, "fills")
    broken = heads.join(inner.select(F.col("breaks").alias("id")), "id", "left_semi").where(F.col("score") >= min_broken).select(F.col("id").alias("breaks"))
    sides = flanks.select(F.col("id").alias("breaks"), "t_from", "left", "right").join(inner.select("breaks"), "breaks", "left_semi")
    inner = kept.keep(inner.join(broken, "breaks", "left_semi").join(sides, ["breaks", "t_from"]), "flanked")
    scored = piece_scores(inner, blocks, per_base, table).where(F.col("score") <= max_suspect)
    fold = lambda c: (F.col(c).cast("double") / F.greatest("score", F.lit(1))).alias(f"{c}_fold")
    return scored.select(*CHAIN, "start", "end", "breaks", "score", fold("left"), fold("right"))


def falling_pieces(found: DataFrame, fold: float = 2.5) -> DataFrame:
    """Of breaking pieces those that fall to both flanks."""
    return found.where((F.col("left_fold") >= fold) & (F.col("right_fold") >= fold))


def falling_pairs(found: DataFrame, fold: float = 10.0, distance: int = 10_000) -> DataFrame:
    """Breaking pieces of one chain within `distance` that fall together: the outer flank of each has the higher ratio."""
    w = Window.partitionBy("t_name", "breaks").orderBy("start", "id")
    near = lambda first, second: (second("start") - first("end") <= distance) & (first("left_fold") >= fold) & (second("right_fold") >= fold)
    here, after, before = F.col, lambda c: F.lead(c).over(w), lambda c: F.lag(c).over(w)
    marked = found.select("*", F.coalesce(near(here, after), F.lit(False)).alias("_left"), F.coalesce(near(before, here), F.lit(False)).alias("_right"))
    return marked.where("_left OR _right").select(found.columns)


def cut_out(blocks: DataFrame, cuts: DataFrame) -> DataFrame:
    """(t_name, id, part, start, end, q): what is left of each chain's blocks; `part` counts the cuts before it.

    blocks: (t_name, id, start, end, q), q where the block begins on the query; cuts: (t_name, id, start, end),
    disjoint in a chain. A chain without cuts is part 0, whole, and takes no part in the merge.
    """
    scratch = Scratch(blocks.sparkSession, "cuts")
    cuts = scratch.keep(cuts.select(*CHAIN, "start", "end").distinct(), "cuts")
    whole = blocks.join(cuts, CHAIN, "left_anti").select(*CHAIN, F.lit(0).cast("long").alias("part"), "start", "end", "q")
    blocks = scratch.keep(blocks.join(cuts, CHAIN, "left_semi").select(*CHAIN, "start", "end", "q"), "touched")
    hit = overlaps(blocks, cuts, CHAIN).groupBy(*CHAIN, F.col("a.start").alias("start"), F.col("a.end").alias("end"), F.col("a.q").alias("q")).agg(F.sort_array(F.collect_list(F.struct("b.start", "b.end"))).alias("cut"))
    n = F.size("cut")
    left = F.transform(F.sequence(F.lit(0), n), lambda k: F.struct(F.when(k == 0, F.col("start")).otherwise(F.get(F.col("cut")["end"], k - 1)).alias("lo"), F.when(k == n, F.col("end")).otherwise(F.get(F.col("cut")["start"], k)).alias("hi")))
    rest = hit.select(*CHAIN, "start", "q", F.explode(F.filter(left, lambda x: x["lo"] < x["hi"])).alias("x")).select(*CHAIN, F.col("x.lo").alias("start"), F.col("x.hi").alias("end"), (F.col("q") + F.col("x.lo") - F.col("start")).alias("q"))
    kept = blocks.join(hit.select(*CHAIN, "start"), [*CHAIN, "start"], "left_anti").unionByName(rest)
    marks = cuts.select(*CHAIN, "start", "end", F.lit(None).cast("long").alias("q"), F.lit(1).alias("cut"))
    w = Window.partitionBy(*CHAIN).orderBy("start", "cut").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = kept.withColumn("cut", F.lit(0)).unionByName(marks).withColumn("part", F.sum("cut").over(w))
    return rows.where("cut = 0").select(*CHAIN, "part", "start", "end", "q").unionByName(whole)
