"""Chains as rows of blocks: offsets, headers, gaps, scores, merging, sorting, splitting.

A block table has (cid, i, size, dt, dq): the i-th aligned block of chain cid, then the gap that
follows it on target and query. Everything is by chain, so a shuffle by cid serves all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.gaps import gap_cost
from ..functions.ordering import indexed, ranked
from ..functions.sequences import DEFAULT, Scoring, pairs_total, reverse_complement
from .tiles import TILE, whole_tiles


def offsets(blocks: DataFrame) -> DataFrame:
    """`blocks` with t_off and q_off: where each block begins, counted from the chain's start."""
    w = Window.partitionBy("cid").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    run = lambda gap: F.coalesce(F.sum(F.col("size") + F.col(gap)).over(w), F.lit(0)).cast("long")
    return blocks.select("cid", "i", "size", "dt", "dq", run("dt").alias("t_off"), run("dq").alias("q_off"))


def headers(blocks: DataFrame) -> DataFrame:
    """(cid, n_blocks, aligned, t_span, q_span) of every chain: one aggregation, no sort."""
    long = lambda c: F.sum(c).cast("long")
    return blocks.groupBy("cid").agg(F.count("*").alias("n_blocks"), long("size").alias("aligned"), long(F.col("size") + F.col("dt")).alias("t_span"), long(F.col("size") + F.col("dq")).alias("q_span"))


def broken(blocks: DataFrame, heads: DataFrame) -> DataFrame:
    """Chains whose blocks don't add up to their header's (t_span, q_span)."""
    mine = headers(blocks).select("cid", F.col("t_span").alias("t_sum"), F.col("q_span").alias("q_sum"))
    j = heads.select("cid", "t_span", "q_span").join(mine, "cid", "full")
    return j.where(~(F.col("t_span").eqNullSafe(F.col("t_sum")) & F.col("q_span").eqNullSafe(F.col("q_sum"))))


def gaps(blocks: DataFrame) -> DataFrame:
    """(cid, i, t_from, t_to, q_from, q_to) of the gap after each block but the last, from the chain's start."""
    last = F.lead("i").over(Window.partitionBy("cid").orderBy("i")).isNull()
    at = offsets(blocks).withColumn("last", last)
    t, q = F.col("t_off") + F.col("size"), F.col("q_off") + F.col("size")
    return at.where(~F.col("last")).select("cid", "i", t.alias("t_from"), (t + F.col("dt")).alias("t_to"), q.alias("q_from"), (q + F.col("dq")).alias("q_to"))


def fillable(gap_rows: DataFrame, least: int = 30, most: int = 20_000) -> DataFrame:
    """Gaps whose length lies in [least, most] on both sides."""
    t, q = F.col("t_to") - F.col("t_from"), F.col("q_to") - F.col("q_from")
    return gap_rows.where(t.between(least, most) & q.between(least, most))


def scores(blocks: DataFrame, per_base: Column | int = 91, table: str = "loose") -> DataFrame:
    """(cid, score): aligned bases by their score, less the cost of each gap inside the chain."""
    base = F.lit(per_base) if isinstance(per_base, int) else per_base
    part = F.col("size") * base - gap_cost(F.col("dt"), F.col("dq"), table)
    return blocks.groupBy("cid").agg(F.sum(part).cast("long").alias("score"))


def scored_offsets(blocks: DataFrame, per_base: int = 91, table: str = "loose") -> DataFrame:
    """`offsets` with the score of the whole chain, in one shuffle."""
    part = F.col("size") * per_base - gap_cost(F.col("dt"), F.col("dq"), table)
    return offsets(blocks).withColumn("score", F.sum(part).over(Window.partitionBy("cid")).cast("long"))


def sequence_scores(blocks: DataFrame, genome_t: DataFrame, genome_q: DataFrame, chains: DataFrame, table: str = "loose", scoring: Scoring = DEFAULT) -> DataFrame:
    """(cid, score) from the bases themselves: each block's pairs by their substitution scores, less the cost of the gaps.

    chains: (cid, t_name, t_start, q_name, q_start, q_size, q_strand), query places counted on the
    strand; genomes: (chrom, seq) or (chrom, chunk_start, seq). Blocks are cut at the edges of tiles on
    both sides, so a piece finds its bases in one tile of each. A chain's pieces in one pair of tiles are one row,
    which meets the target's tile, then the query's; its bases travel joined. Pairs with an unknown base count as such,
    those outside a genome not at all.
    """
    at = offsets(blocks).join(chains, "cid").where("size > 0")
    t, q, minus = F.col("t_start") + F.col("t_off"), F.col("q_start") + F.col("q_off"), F.col("q_strand") == "-"
    rows = at.select("cid", F.col("t_name").cast("string").alias("t_name"), F.col("q_name").cast("string").alias("q_name"), minus.alias("minus"), t.alias("t"), F.when(minus, F.col("q_size") - q - F.col("size")).otherwise(q).alias("q"), "size")
    over = lambda c: F.sequence(F.floor(F.col(c) / TILE), F.floor((F.col(c) + F.col("size") - 1) / TILE))
    rows = rows.select("*", F.explode(over("t")).alias("t_tile")).select("*", F.explode(over("q")).alias("q_tile"))
    # bases of the block, counted along the target, that lie in both tiles; on the minus strand the query runs backwards
    lo, hi = F.col("q_tile") * TILE - F.col("q"), (F.col("q_tile") + 1) * TILE - F.col("q")
    first = F.greatest(F.lit(0), F.col("t_tile") * TILE - F.col("t"), F.when(F.col("minus"), F.col("size") - hi).otherwise(lo))
    last = F.least(F.col("size"), (F.col("t_tile") + 1) * TILE - F.col("t"), F.when(F.col("minus"), F.col("size") - lo).otherwise(hi))
    n = (last - first).cast("int")
    t_in = (F.col("t") + first - F.col("t_tile") * TILE).cast("int").alias("t")
    q_in = (F.when(F.col("minus"), F.col("q") + F.col("size") - last).otherwise(F.col("q") + first) - F.col("q_tile") * TILE).cast("int").alias("q")
    by = ["cid", "t_name", "t_tile", "q_name", "q_tile", "minus"]
    own = rows.where(first < last).groupBy(*by).agg(F.collect_list(F.struct(t_in, q_in, n.alias("n"))).alias("p"))
    # a tile's bases by place, with a blank where the genome has none
    held = lambda g, s: whole_tiles(g).select(F.col("chrom").alias(f"{s}_name"), F.col("tile").alias(f"{s}_tile"), F.col("bases").alias("_bases"))
    cut = lambda s: F.transform("p", lambda x: F.rpad(F.substring(F.col("_bases"), x[s] + 1, x["n"]), x["n"], " "))
    met = own.join(held(genome_t, "t"), ["t_name", "t_tile"]).select("cid", "q_name", "q_tile", "minus", F.transform("p", lambda x: F.struct(x["q"].alias("q"), x["n"].alias("n"))).alias("p"), F.array_join(cut("t"), "").alias("t_seq"))
    turned = F.transform(cut("q"), lambda x: F.when(F.col("minus"), reverse_complement(x)).otherwise(x))
    both = met.join(held(genome_q, "q"), ["q_name", "q_tile"]).select("cid", "t_seq", F.array_join(turned, "").alias("q_seq"))
    aligned = both.select("cid", pairs_total(F.col("t_seq"), F.col("q_seq"), scoring).alias("s")).groupBy("cid").agg(F.sum("s").alias("aligned"))
    cost = blocks.groupBy("cid").agg(F.sum(gap_cost(F.col("dt"), F.col("dq"), table)).alias("cost"))
    return cost.join(aligned, "cid", "left").select("cid", (F.coalesce("aligned", F.lit(0)) - F.col("cost")).cast("long").alias("score"))


# --- sets of chains ---


def merged(*parts: DataFrame) -> DataFrame:
    """The bag union of chain tables with one schema."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def renumbered(chains: DataFrame) -> DataFrame:
    """`chains` with new_id from 1 in the order of their ids, as a merge renames them.

    Ids that are numbers go by number, before all others, which go by text; ids that several files use
    follow each other by score, best first, then by place.
    """
    number = F.when(F.col("id").cast("string").rlike("^[0-9]{1,38}$"), F.col("id").cast("string").try_cast("decimal(38,0)"))
    order = [number.asc_nulls_last(), F.col("id").asc(), F.desc("score"), *[F.col(c).asc() for c in ("t_name", "t_start", "q_name", "q_start", "q_strand")]]
    return ranked(chains, order).withColumn("new_id", F.col("idx") + 1).drop("idx")


def numbered_by_score(chains: DataFrame) -> DataFrame:
    """`chains` with new_id from 1, best score first, ties by old id; ranks come from score ranges."""
    order = indexed(chains, "score", [F.desc("score"), F.asc("id")], descending=True)
    return order.withColumn("new_id", F.col("idx") + 1).drop("idx")


def by_score(chains: DataFrame) -> DataFrame:
    return chains.orderBy(F.desc("score"), "id")


def at_least(chains: DataFrame, score: int) -> DataFrame:
    return chains.where(F.col("score") >= score)


def selected(chains: DataFrame, min_score: int | None = None, t_name: str | None = None, q_name: str | None = None, strand: str | None = None, ids: list[str] | None = None, max_gap: int | None = None) -> DataFrame:
    """Chains that pass every condition given; `max_gap` looks at all gaps inside a chain."""
    out = chains if min_score is None else at_least(chains, min_score)
    for c, v in (("t_name", t_name), ("q_name", q_name), ("q_strand", strand)):
        out = out if v is None else out.where(F.col(c) == v)
    out = out if ids is None else out.where(F.col("id").isin(ids))
    return out if max_gap is None else out.where(~F.exists("blocks", lambda b: F.greatest(F.coalesce(b["dt"], F.lit(0)), F.coalesce(b["dq"], F.lit(0))) > max_gap))


def split(chains: DataFrame, files: int) -> DataFrame:
    """`chains` with `file`: an even, repeatable deal by number, whatever the order of rows."""
    return chains.withColumn("file", F.pmod(F.col("cid"), F.lit(files)).cast("long"))


def nested(blocks: DataFrame) -> DataFrame:
    """(cid, blocks): a chain's blocks as one array, the last without a gap."""
    s = F.sort_array(F.collect_list(F.struct("i", "size", "dt", "dq")))
    rows = blocks.groupBy("cid").agg(s.alias("b"))
    n = F.size("b") - 1
    return rows.select("cid", F.transform("b", lambda x, k: F.struct(x["size"].alias("size"), F.when(k < n, x["dt"]).alias("dt"), F.when(k < n, x["dq"]).alias("dq"))).alias("blocks"))


def unnested(chains: DataFrame, key: str = "id") -> DataFrame:
    """(cid, i, size, dt, dq) of chains with a column blocks; the last gap is 0."""
    b = chains.select(F.col(key).alias("cid"), F.posexplode("blocks").alias("i", "b"))
    return b.select("cid", F.col("i").cast("long").alias("i"), "b.size", F.coalesce("b.dt", F.lit(0)).alias("dt"), F.coalesce("b.dq", F.lit(0)).alias("dq"))
