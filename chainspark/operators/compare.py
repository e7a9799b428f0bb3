"""Comparison of two chain sets by overlap.

A baseline chain is matched when a candidate chain with the same names and strands overlaps it on
target and query, the baseline widened by a tolerance on both sides; one match is enough.

The join is on bins of the target axis beside the names and strands, with the whole condition on the
joined rows. Bins come in levels, each `FACTOR` times as wide as the one below; a range belongs to the
first level whose bins are as wide as it is long, so it touches two of them at most, whatever its
length. Two ranges meet at the higher of their levels; a side is copied to those levels only that
the other side has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import indexed
from ..functions.text import near_boundary
from ..scratch import Scratch

KEYS = ["t_name", "q_name", "t_strand", "q_strand"]
PERCENTILES = (10, 25, 50, 75, 90, 95, 99)


#: Width of the narrowest bins, and of bins of each level over those of the one below. The last level is one bin.
WIDTH, FACTOR, LEVELS = 1024, 8, 8


def _level(lo: Column, hi: Column, width: int) -> Column:
    out = F.lit(LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        out = F.when(hi - lo <= width * FACTOR**k, k).otherwise(out)
    return out


def _binned(df: DataFrame, lo: str, hi: str, width: int, above: bool, others: list[int]) -> DataFrame:
    """`df` with (over, level, bin) for each bin in which a row may meet the other side.

    Where `over` equals `above` the row stands for itself, in the bins of its own level; where not, it
    looks for rows of the levels `others` over its own. Equal levels count on one side only.
    """
    own, last = _level(F.col(lo), F.col(hi), width), F.greatest(F.col(hi) - 1, F.col(lo))
    at = lambda c, k: F.floor(c / F.lit(float(width * FACTOR**k))).cast("long") if k < LEVELS else F.lit(0).cast("long")
    bins = lambda over, k: F.transform(F.sequence(at(F.col(lo), k), at(last, k)), lambda b: F.struct(F.lit(over).alias("over"), F.lit(k).alias("level"), b.alias("bin")))
    none = F.array().cast("array<struct<over:boolean,level:int,bin:bigint>>")
    mine = bins(above, LEVELS)
    for k in range(LEVELS - 1, -1, -1):
        mine = F.when(F.col("_own") == k, bins(above, k)).otherwise(mine)
    if others:  # a row stands for itself only where the other side has rows that look for it
        met = F.col("_own") >= others[0] if above else F.col("_own") > others[0]
        mine = F.when(met, mine).otherwise(none)
    higher = [F.when(F.col("_own") < k if above else F.col("_own") <= k, bins(not above, k)).otherwise(none) for k in others]
    return df.withColumn("_own", own).select("*", F.explode(F.concat(mine, *higher)).alias("_e")).select(*df.columns, "_e.over", "_e.level", "_e.bin")


def _sides(a: DataFrame, b: DataFrame, a_range: tuple[str, str], b_range: tuple[str, str], width: int) -> tuple[DataFrame, DataFrame]:
    """Both sides by bin; the levels that a side has are a few numbers."""
    have = [sorted(r[0] for r in df.select(_level(F.col(lo), F.col(hi), width).alias("k")).distinct().collect()) for df, (lo, hi) in ((a, a_range), (b, b_range))]
    return _binned(a, *a_range, width, True, have[1]), _binned(b, *b_range, width, False, have[0])


def matched_ids(baseline: DataFrame, candidate: DataFrame, tolerance: int = 100, width: int = WIDTH) -> DataFrame:
    """Distinct ids of the matched baseline chains."""
    b = baseline.select("id", *KEYS, (F.col("t_start") - tolerance).alias("t0"), (F.col("t_end") + tolerance).alias("t1"), (F.col("q_start") - tolerance).alias("q0"), (F.col("q_end") + tolerance).alias("q1"))
    c = candidate.select(*KEYS, F.col("t_start").alias("c_t0"), F.col("t_end").alias("c_t1"), F.col("q_start").alias("c_q0"), F.col("q_end").alias("c_q1"))
    b, c = _sides(b, c, ("t0", "t1"), ("c_t0", "c_t1"), width)
    on = (F.greatest("t0", "c_t0") < F.least("t1", "c_t1")) & (F.greatest("q0", "c_q0") < F.least("q1", "c_q1"))
    for k in [*KEYS, "over", "level", "bin"]:
        on = on & (b[k] == c[k])
    return b.join(c, on, "left_semi").select("id").distinct()


def matched(baseline: DataFrame, candidate: DataFrame, tolerance: int = 100, width: int = WIDTH) -> DataFrame:
    return baseline.join(matched_ids(baseline, candidate, tolerance, width), "id", "left_semi")


def missing(baseline: DataFrame, candidate: DataFrame, tolerance: int = 100, width: int = WIDTH) -> DataFrame:
    return baseline.join(matched_ids(baseline, candidate, tolerance, width), "id", "left_anti")


def overlap_pairs(a: DataFrame, b: DataFrame, width: int = WIDTH) -> DataFrame:
    """(a_id, b_id, t_overlap): pairs of chains with equal names and strands that overlap on both axes.

    A pair that shares two bins is reported in the one where its overlap begins.
    """
    side = lambda df, s: df.select(*KEYS, F.col("id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in ("t_start", "t_end", "q_start", "q_end")])
    left, right = _sides(side(a, "a"), side(b, "b"), ("a_t_start", "a_t_end"), ("b_t_start", "b_t_end"), width)
    j = left.join(right, [*KEYS, "over", "level", "bin"])
    lo, hi = F.greatest("a_t_start", "b_t_start"), F.least("a_t_end", "b_t_end")
    first = F.when(F.col("level") == LEVELS, 0).otherwise(F.floor(lo / (F.lit(float(width)) * F.pow(F.lit(float(FACTOR)), "level"))))
    keep = (lo < hi) & (F.greatest("a_q_start", "b_q_start") < F.least("a_q_end", "b_q_end")) & (F.col("bin") == first)
    return j.where(keep).select("a_id", "b_id", (hi - lo).alias("t_overlap"))


def summary(baseline: DataFrame, candidate: DataFrame, tolerance: int = 100, width: int = WIDTH) -> DataFrame:
    """One row: (baseline_chains, candidate_chains, matched, missing, missing_percent)."""
    hit = matched_ids(baseline, candidate, tolerance, width).agg(F.count("*").alias("matched"))
    n = baseline.agg(F.count("*").alias("baseline_chains")).crossJoin(candidate.agg(F.count("*").alias("candidate_chains"))).crossJoin(hit)
    gone = F.col("baseline_chains") - F.col("matched")
    return n.select("baseline_chains", "candidate_chains", "matched", gone.alias("missing"), (F.lit(100.0) * gone / F.greatest(F.lit(1), F.col("baseline_chains"))).alias("missing_percent"))


def score_percentiles(chains: DataFrame, label: str, percentiles: tuple[int, ...] = PERCENTILES) -> DataFrame:
    """(label, pct, score): the score at index p / 100 * n of the ascending scores, and the maximum as 100.

    `chains` is evaluated once, for its number of rows by score; ranks are running sums of that table,
    and a score holds the ranks from its own sum up to the next.
    """
    scratch = Scratch(chains.sparkSession, "percentiles")
    tally = scratch.keep(chains.groupBy("score").agg(F.count("*").alias("rows")), "scores")
    n = tally.agg(F.sum("rows")).first()[0] or 0
    asked = [(p, min(n - 1, max(0, math.floor(p / 100 * n)))) for p in (*percentiles, 100)] if n else []
    wanted = F.broadcast(chains.sparkSession.createDataFrame(asked, "pct int, at long"))
    ranked = indexed(tally, "score", [F.col("score")], ["rows"])
    held = (F.col("at") >= F.col("rows_before")) & (F.col("at") < F.col("rows_before") + F.col("rows"))
    return ranked.join(wanted, held).select(F.lit(label).alias("label"), "pct", "score")


def boundary_summary(missed: DataFrame, chunk: int, overlap: int, window: int) -> DataFrame:
    """One row: (missing, near_boundary, near_percent)."""
    near = near_boundary(F.col("t_start"), F.col("t_end"), window, chunk, overlap).cast("long")
    out = missed.agg(F.count("*").alias("missing"), F.coalesce(F.sum(near), F.lit(0)).alias("near_boundary"))
    return out.select("missing", "near_boundary", (F.lit(100.0) * F.col("near_boundary") / F.greatest(F.lit(1), F.col("missing"))).alias("near_percent"))


def top_missing(missed: DataFrame, n: int = 20) -> DataFrame:
    """The best `n` missing chains, ties by id: a top-k report."""
    return missed.orderBy(F.desc("score"), "id").limit(n)
