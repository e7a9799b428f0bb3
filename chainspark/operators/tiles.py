"""Stretches of sequence, fetched by place from genomes of any length.

A genome is cut into tiles; ranges meet the tiles that they touch in a join by (chrom, tile), take
their part of each, and the parts of a range are put together. So no row ever carries a chromosome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement

#: Bases of a tile.
TILE = 4096


def tiles(genome: DataFrame, width: int = TILE) -> DataFrame:
    """(chrom, tile, at, bases): pieces of (chrom, seq) or (chrom, chunk_start, seq) that lie in one tile each; tiles stay as they are."""
    if "tile" in genome.columns:
        return genome
    base = F.col("chunk_start").cast("long") if "chunk_start" in genome.columns else F.lit(0).cast("long")
    rows = genome.where("length(seq) > 0").select(F.col("chrom").cast("string").alias("chrom"), base.alias("base"), F.encode("seq", "US-ASCII").alias("raw"))
    end = F.col("base") + F.length("raw")
    tile = F.explode(F.sequence(F.floor(F.col("base") / width), F.floor((end - 1) / width))).alias("tile")
    cut = rows.select("chrom", "base", "raw", tile)
    lo, hi = F.greatest(F.col("base"), F.col("tile") * width), F.least(end, (F.col("tile") + 1) * width)
    return cut.select("chrom", "tile", lo.alias("at"), F.substring("raw", (lo - F.col("base") + 1).cast("int"), (hi - lo).cast("int")).alias("bases"))


def whole_tiles(genome: DataFrame, width: int = TILE) -> DataFrame:
    """(chrom, tile, bases): one row a tile, its bases by their place in it, blanks where the genome has none before or between them."""
    rows = tiles(genome, width)
    if "tile" not in genome.columns and "chunk_start" not in genome.columns:  # one row a chromosome: tiles are whole
        return rows.select("chrom", "tile", F.col("bases").cast("string").alias("bases"))
    parts = rows.groupBy("chrom", "tile").agg(F.sort_array(F.collect_list(F.struct((F.col("at") - F.col("tile") * width).cast("int").alias("at"), F.col("bases").cast("string").alias("s")))).alias("p"))
    # what is there so far, filled up to where the next part begins; where parts overlap, the later one counts on
    joined = F.aggregate("p", F.lit(""), lambda s, x: F.concat(F.rpad(s, x["at"], " "), x["s"], F.substr(s, x["at"] + F.length(x["s"]) + 1)))
    return parts.select("chrom", "tile", joined.alias("bases"))


def lengths(genome: DataFrame) -> DataFrame:
    """(chrom, size) of sequences, whole, in chunks or in tiles."""
    if "tile" in genome.columns:
        return genome.groupBy("chrom").agg(F.max(F.col("at") + F.length("bases")).cast("long").alias("size"))
    base = F.col("chunk_start") if "chunk_start" in genome.columns else F.lit(0)
    return genome.groupBy(F.col("chrom").cast("string").alias("chrom")).agg(F.max(base + F.length("seq")).cast("long").alias("size"))


def fetched(ranges: DataFrame, genome: DataFrame, width: int = TILE) -> DataFrame:
    """(chrom, start, end, seq) of the distinct ranges (chrom, start, end); bases outside the genome are left out."""
    want = ranges.select(F.col("chrom").cast("string").alias("chrom"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end")).distinct()
    some = want.where("start < `end`").select("*", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))).alias("tile"))
    j = some.join(tiles(genome, width), ["chrom", "tile"])
    lo, hi = F.greatest("start", "at"), F.least(F.col("end"), F.col("at") + F.length("bases"))
    part = F.substring("bases", (lo - F.col("at") + 1).cast("int"), (hi - lo).cast("int")).cast("string")
    parts = j.where(lo < hi).groupBy("chrom", "start", "end").agg(F.sort_array(F.collect_list(F.struct(lo.alias("lo"), part.alias("s")))).alias("parts"))
    got = parts.select("chrom", "start", "end", F.array_join(F.transform("parts", lambda p: p["s"]), "").alias("seq"))
    return want.join(got, ["chrom", "start", "end"], "left").select("chrom", "start", "end", F.coalesce("seq", F.lit("")).alias("seq"))


def with_bases(rows: DataFrame, genome: DataFrame, chrom: str, start: str, end: str, out: str) -> DataFrame:
    """`rows` with the bases of their range as column `out`."""
    mine = rows.withColumn("_c", F.col(chrom).cast("string")).withColumn("_s", F.col(start).cast("long")).withColumn("_e", F.col(end).cast("long"))
    got = fetched(mine.select(F.col("_c").alias("chrom"), F.col("_s").alias("start"), F.col("_e").alias("end")), genome)
    got = got.select(F.col("chrom").alias("_c"), F.col("start").alias("_s"), F.col("end").alias("_e"), F.col("seq").alias(out))
    return mine.join(got, ["_c", "_s", "_e"]).select(*rows.columns, out)


def on_strand(rows: DataFrame, query: DataFrame, start: str, end: str, out: str) -> DataFrame:
    """`rows` (q_name, q_strand, q_size) with the query's bases of a range that is counted on the strand."""
    minus = F.col("q_strand") == "-"
    placed = rows.withColumn("_lo", F.when(minus, F.col("q_size") - F.col(end)).otherwise(F.col(start))).withColumn("_hi", F.when(minus, F.col("q_size") - F.col(start)).otherwise(F.col(end)))
    got = with_bases(placed, query, "q_name", "_lo", "_hi", out)
    return got.withColumn(out, F.when(minus, reverse_complement(F.col(out))).otherwise(F.col(out))).select(*rows.columns, out)


def aligned_bases(pieces: DataFrame, target: DataFrame, query: DataFrame) -> DataFrame:
    """`pieces` (t_name, t, q_name, q_strand, q_size, q, n) with t_seq and q_seq, n bases each where the genomes have them."""
    rows = pieces.withColumn("t_to", F.col("t") + F.col("n")).withColumn("q_to", F.col("q") + F.col("n"))
    rows = with_bases(rows, target, "t_name", "t", "t_to", "t_seq")
    return on_strand(rows, query, "q", "q_to", "q_seq").select(*pieces.columns, "t_seq", "q_seq")
