"""Chains that owe their score to repeats go.

Two adjusted scores, each has to reach the least score. Degenerate sequence: where the two commonest
bases hold more than 80 % of the aligned bases, the score shrinks with the excess. Masked sequence:
the score shrinks with twice the share of unmasked bases. Chains above a high score aren't looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import base_count
from .tiles import TILE, tiles

#: Share of the two commonest bases that is still normal.
NORMAL = 0.80
LEAST, SURE = 5_000, 200_000


def degenerate_factor(a: Column, c: Column, g: Column, t: Column) -> Column:
    """1 up to the normal share of the two commonest bases, then falling to 0.01 at a share of 1."""
    four = F.sort_array(F.array(a, c, g, t), asc=False)
    total = a + c + g + t
    share = (four[0] + four[1]).cast("double") / F.greatest(total, F.lit(1)).cast("double")
    over = share - F.lit(NORMAL)
    return F.when(over > 0, F.lit(1.01) - over / F.lit(1 - NORMAL)).otherwise(F.lit(1.0))


def masked_factor(masked: Column, total: Column) -> Column:
    """Twice the share of unmasked bases, 1 at most."""
    return F.least(F.lit(1.0), F.lit(2.0) * (total - masked).cast("double") / F.greatest(total, F.lit(1)).cast("double"))


def adjusted(chains: DataFrame, least: int = LEAST) -> DataFrame:
    """`chains` (score, a, c, g, t, masked) with the factors and whether the chain is kept."""
    total = F.col("a") + F.col("c") + F.col("g") + F.col("t")
    d, m = degenerate_factor(*map(F.col, "acgt")), masked_factor(F.col("masked"), total)
    keep = (F.col("score") >= SURE) | ((F.col("score") * d >= least) & (F.col("score") * m >= least))
    return chains.withColumns({"degenerate_factor": d, "masked_factor": m, "kept": keep})


def composition(chains: DataFrame, blocks: DataFrame, genome: DataFrame) -> DataFrame:
    """`chains` (cid, t_name, t_start, score) with counts of aligned target bases (a, c, g, t) and masked ones.

    blocks: (cid, t_off, size); genome: (chrom, seq), whole or in chunks. Blocks are cut at the edges of
    tiles; a chain's pieces in one tile are a row, put together where the blocks lie, and meet the tile once.
    """
    at = blocks.join(chains.select("cid", "t_name", "t_start"), "cid").select("cid", F.col("t_name").cast("string").alias("chrom"), (F.col("t_start") + F.col("t_off")).alias("t"), "size").where("size > 0")
    some = at.select("*", F.explode(F.sequence(F.floor(F.col("t") / TILE), F.floor((F.col("t") + F.col("size") - 1) / TILE))).alias("tile"))
    edge = F.col("tile") * TILE
    own = some.groupBy("cid", "chrom", "tile").agg(F.collect_list(F.struct(F.greatest("t", edge).alias("lo"), F.least(F.col("t") + F.col("size"), edge + TILE).alias("hi"))).alias("p"))
    j = own.join(tiles(genome), ["chrom", "tile"])
    # in bytes, as a place in a string is searched from its beginning
    lo, hi = lambda x: F.greatest(x["lo"], "at") - F.col("at"), lambda x: F.least(x["hi"] - F.col("at"), F.length("bases"))
    cut = F.transform("p", lambda x: F.substring("bases", (lo(x) + 1).cast("int"), F.greatest(hi(x) - lo(x), F.lit(0)).cast("int")).cast("string"))
    part = j.select("cid", F.array_join(cut, "").alias("s"))
    n = part.select("cid", *[base_count(F.col("s"), b).alias(b.lower()) for b in "ACGT"], F.length(F.regexp_replace("s", "[^acgt]+", "")).alias("masked"))
    n = n.groupBy("cid").agg(*[F.sum(c).cast("long").alias(c) for c in ("a", "c", "g", "t", "masked")])
    none = F.lit(0).cast("long")
    return chains.join(n, "cid", "left").select(*chains.columns, *[F.coalesce(c, none).alias(c) for c in ("a", "c", "g", "t", "masked")])
