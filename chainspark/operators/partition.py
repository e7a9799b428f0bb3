"""Genome partitions: overlapping chunks of long chromosomes, bulks of small ones, and their pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text
from ..functions.ordering import ranked
from ..scratch import Scratch
from .nextfit import next_fit

#: Chromosomes under this share of a chunk go to bulks.
SMALL = 0.45
#: A bulk closes before its size would pass this share of a chunk, or at this many members.
BULK_SHARE, BULK_MEMBERS = 0.75, 100
#: Rows of a block of a product's right side, and bytes of a block of either side: fewer than a Parquet file's list of distinct values may hold.
BLOCK, BYTES = 1024, 700_000


def _checked(chunk: int, overlap: int) -> None:
    if chunk < 1 or not 0 <= overlap < chunk:
        raise ValueError("the overlap has to be at least 0 and less than the chunk")


def is_small(size: Column, chunk: int) -> Column:
    return size < F.lit(chunk * SMALL)


def chunks(sizes: DataFrame, chunk: int, overlap: int = 0) -> DataFrame:
    """(chrom, start, end) of every chunk of the regular chromosomes.

    Starts advance by chunk - overlap, so a last chunk may lie inside the one before; it is kept.
    """
    _checked(chunk, overlap)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(chunk - overlap).cast("long")))
    regular = sizes.where(~is_small(F.col("size"), chunk) & (F.col("size") > 0))
    return regular.select("chrom", "size", starts.alias("start")).select("chrom", "start", F.least(F.col("start") + chunk, F.col("size")).alias("end"))


def small_scaffolds(sizes: DataFrame, chunk: int) -> DataFrame:
    return sizes.where(is_small(F.col("size"), chunk))


def bulks(sizes: DataFrame, chunk: int) -> DataFrame:
    """(bulk_no, pos, chrom, size) of the small chromosomes, filled in file order; bulks count from 1."""
    fits = next_fit(small_scaffolds(sizes, chunk), lead="ord", descending=False, tie="chrom", limit=chunk * BULK_SHARE, members=BULK_MEMBERS, close_after=False)
    return fits.select((F.col("bin") + 1).alias("bulk_no"), F.col("pos"), "chrom", "size")


def partitions(sizes: DataFrame, chunk: int, overlap: int = 0, file: str = "genome.2bit") -> DataFrame:
    """(kind, no, part): all partition strings of a genome, regular ones and bulks."""
    name = F.lit(file)
    regular = chunks(sizes, chunk, overlap).select(F.lit("chunk").alias("kind"), F.lit(None).cast("long").alias("no"), text.partition_string(name, F.col("chrom"), F.col("start"), F.col("end")).alias("part"))
    members = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col("chrom").cast("string").alias("chrom")))), lambda m: m["chrom"])
    packed = bulks(sizes, chunk).groupBy("bulk_no").agg(members.alias("chroms"))  # at most 100 members each
    return regular.union(packed.select(F.lit("bulk").alias("kind"), F.col("bulk_no"), text.bulk_string(F.col("bulk_no"), name, F.col("chroms")).alias("part")))


def ordered(sizes: DataFrame, chunk: int, overlap: int = 0, file: str = "genome.2bit") -> DataFrame:
    """(place, part): the partition list in its order, chunks as their chromosomes come in the size list, then bulks by number."""
    regular = chunks(sizes, chunk, overlap).join(sizes.select("chrom", "ord"), "chrom")
    text_of = text.partition_string(F.lit(file), F.col("chrom"), F.col("start"), F.col("end"))
    none = F.lit(0).cast("long")
    first = regular.select(F.struct(F.lit(False).alias("bulk"), F.col("ord"), F.col("chrom").cast("string").alias("chrom"), F.col("start")).alias("place"), text_of.alias("part"))
    packed = partitions(sizes, chunk, overlap, file).where("kind = 'bulk'")
    return first.union(packed.select(F.struct(F.lit(True).alias("bulk"), F.col("no").alias("ord"), F.lit("").alias("chrom"), none.alias("start")), "part"))


def _sized(df: DataFrame, name: str, scratch: Scratch) -> tuple[DataFrame, int, int]:
    """(`df` as a table, its rows, how many of them make `BYTES` bytes)."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) + 4 for f in df.schema.fields if f.dataType.typeName() == "string"]
    seen = Observation()
    out = scratch.keep(df.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(sum(text, F.lit(8))), F.lit(0)).alias("bytes")), name)
    n = int(seen.get["n"])
    return out, n, max(1, BYTES * n // max(1, int(seen.get["bytes"])))


def crossed(left: DataFrame, right: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every row of `left` with every row of `right`, in memory of one block and without a pair in any shuffle.

    Both sides are computed once and dealt into blocks by rank, the left one in the order of its columns. A task takes a
    block of each, the right one as an array in one row. So a task's rows have few distinct values, which a columnar
    file writes once each, and come in an order that repeats in whole bytes (blocks are multiples of 8 rows): a pair takes
    a fraction of a byte though its names are long.
    """
    scratch, spark = Scratch(left.sparkSession, "crossed"), left.sparkSession
    left, n, share = _sized(left, "left", scratch)
    right, m, most = _sized(right, "right", scratch)
    block = min(block, most)
    block -= block % 8 if block > 8 else 0
    blocks = max(1, -(-m // block))
    # enough to keep all tasks busy
    share = max(1, min(share, n * blocks // int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
    shares = max(1, -(-n // share))
    number = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    place = lambda c, size: F.floor(F.col("idx") / F.lit(float(size))).cast("int").alias(c)
    cell = (F.col("_share") * blocks + F.col("_block")).alias("_cell")
    held = ranked(right, [F.xxhash64(*right.columns), *map(F.col, right.columns)]).select(*right.columns, place("_block", block))
    packed = held.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct(*right.columns))).alias("_rows")).select("*", number(shares).alias("_share"))
    packed = packed.select(cell, "_rows").repartitionById(shares * blocks, "_cell")
    met = ranked(left, [F.col(c) for c in left.columns]).select(*left.columns, place("_share", share)).select("*", number(blocks).alias("_block"))
    met = met.select(*left.columns, cell).repartitionById(shares * blocks, "_cell").join(packed.hint("shuffle_hash"), "_cell")
    return met.select(*left.columns, F.explode("_rows").alias("_row")).select(*left.columns, "_row.*")


def pairs(reference: DataFrame, query: DataFrame) -> DataFrame:
    """(reference_part, query_part): every reference partition with every query partition.

    The pairs are the result, so its rows grow with the product of both lists; neither list has to fit in a task.
    """
    return crossed(reference.select(F.col("part").alias("reference_part")), query.select(F.col("part").alias("query_part")))


def expected_pairs(reference: DataFrame, query: DataFrame) -> DataFrame:
    """One row: how many pairs there have to be."""
    r, q = reference.agg(F.count("*").alias("r")), query.agg(F.count("*").alias("q"))
    return r.crossJoin(q).select((F.col("r") * F.col("q")).alias("expected"))


def checked_pairs(reference: DataFrame, query: DataFrame, done: DataFrame) -> DataFrame:
    """(expected, actual, missing): compares finished pairs with all that were asked for."""
    n = expected_pairs(reference, query).crossJoin(done.agg(F.count("*").alias("actual")))
    return n.select("expected", "actual", (F.col("expected") - F.col("actual")).alias("missing"))


def intervals(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(part, chrom, start, end): a regular partition's own range; the whole of each member of a bulk.

    A bulk that names a chromosome without a size is an error, and so is one with fewer than three fields.
    """
    fields = F.split("part", ":")
    bulk = parts.where(text.is_bulk(F.col("part"))).select("part", F.when(F.size(fields) >= 3, F.slice(fields, 3, F.size(fields))).otherwise(F.raise_error(F.concat(F.lit("not a bulk: "), F.col("part"))).cast("array<string>")).alias("names"))
    named = bulk.select("part", F.explode("names").alias("chrom")).join(sizes.select(F.col("chrom").cast("string").alias("chrom"), "size"), "chrom", "left")
    size = F.when(F.col("size").isNotNull(), F.col("size")).otherwise(F.raise_error(F.concat(F.lit("no size for chromosome "), F.col("chrom"))).cast("long"))
    whole = named.select("part", "chrom", F.lit(0).cast("long").alias("start"), size.alias("end"))
    own = parts.where(~text.is_bulk(F.col("part"))).select("part", text.parsed_spec(F.col("part")).alias("s"))
    return own.select("part", "s.chrom", "s.start", "s.end").union(whole)


def uncovered(parts: DataFrame, sizes: DataFrame) -> DataFrame:
    """(chrom, uncovered): chromosomes of which some bases are in none of the partitions, and how many.

    Partitions of other chromosomes are ignored, and so is what lies beyond a size. A name with a colon can't be
    read back from a bulk; it counts as not covered there.
    """
    spec = r"^(?:.*/)?[^:/]*:(.+):([0-9]+)-([0-9]+)$"
    at = lambda i: F.regexp_extract("part", spec, i)
    bulk = text.is_bulk(F.col("part"))
    size = sizes.select(F.col("chrom").cast("string").alias("chrom"), "size")
    own = parts.where(~bulk).select(at(1).alias("chrom"), at(2).cast("long").alias("start"), at(3).cast("long").alias("end"))
    fields = F.split("part", ":")
    names = parts.where(bulk & (F.size(fields) >= 3)).select(F.explode(F.slice(fields, 3, F.size(fields))).alias("chrom"))
    whole = names.join(size, "chrom").select("chrom", F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
    w = Window.partitionBy("chrom").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    laid = own.union(whole).withColumn("reach", F.coalesce(F.max("end").over(w), F.lit(0)))
    held = laid.groupBy("chrom").agg(F.sum(F.greatest(F.lit(0), F.col("start") - F.col("reach"))).alias("open"), F.max("end").alias("last"))
    left = F.greatest(F.lit(0), F.col("size") - F.coalesce("last", F.lit(0))) + F.coalesce("open", F.lit(0))
    return size.join(held, "chrom", "left").select("chrom", left.cast("long").alias("uncovered")).where("uncovered > 0")


def pair_totals(reference: DataFrame, query: DataFrame) -> DataFrame:
    """(reference_part, query_part, alignments, reference_bases, query_bases): what every pair's combinations of intervals add up to.

    Each partition's intervals are counted and summed once, and the totals of a pair are products of its sides', so
    no combination is ever a row (`interval_pairs` lists them).
    """
    # blocks are in the order of their columns: pairs whose products are alike follow each other
    side = lambda df, s: df.groupBy(F.col("part").alias(f"{s}_part")).agg(F.count("*").alias(f"{s}_n"), F.sum(F.col("end") - F.col("start")).cast("long").alias(f"{s}_sum")).select(f"{s}_n", f"{s}_sum", f"{s}_part")
    r, q = F.col("reference_n"), F.col("query_n")
    both = crossed(side(reference, "reference"), side(query, "query"))
    return both.select("reference_part", "query_part", (r * q).alias("alignments"), (F.col("reference_sum") * q).alias("reference_bases"), (F.col("query_sum") * r).alias("query_bases"))


def interval_pairs(pairs: DataFrame, reference: DataFrame, query: DataFrame) -> DataFrame:
    """Each partition pair with every combination of its intervals; joins by partition, not a cross join."""
    side = lambda df, s: df.select(F.col("part").alias(f"{s}_part"), *[F.col(c).alias(f"{s}_{c}") for c in ("chrom", "start", "end")])
    return pairs.join(side(reference, "reference"), "reference_part").join(side(query, "query"), "query_part")
