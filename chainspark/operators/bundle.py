"""Bundles of per-chromosome alignment files: largest chromosomes first, closed once large enough."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .nextfit import next_fit

#: A bundle closes when it has more chromosomes than this.
FILES = 1000


def bundles(sizes: DataFrame, present: DataFrame, max_bases: int) -> DataFrame:
    """(bundle, pos, chrom, size) of the chromosomes that have alignments; bundles count from 0.

    A bundle takes chromosomes until its bases reach `max_bases` or it has more than 1000 of them, so
    it may overshoot. A last bundle of chromosomes without bases is left out.
    """
    mine = sizes.join(present.select("chrom").distinct(), "chrom", "left_semi")
    fits = next_fit(mine, lead="size", descending=True, tie="ord", limit=max_bases, members=FILES + 1, close_after=True)
    last = fits.agg(F.max("bin").alias("last"))
    empty = fits.join(F.broadcast(last), F.col("bin") == F.col("last")).groupBy("last").agg(F.sum("size").alias("bases"), F.count("*").alias("n")).where((F.col("bases") <= 0) & (F.col("n") <= FILES)).select(F.col("last").alias("bin"))
    return fits.join(F.broadcast(empty), "bin", "left_anti").select(F.col("bin").alias("bundle"), "pos", "chrom", "size")


def bundle_totals(bundled: DataFrame) -> DataFrame:
    return bundled.groupBy("bundle").agg(F.count("*").alias("chroms"), F.sum("size").alias("bases"), F.max("size").alias("largest"))


def skipped(sizes: DataFrame, present: DataFrame) -> DataFrame:
    """Chromosomes without alignments."""
    return sizes.join(present.select("chrom").distinct(), "chrom", "left_anti").select("chrom", "size")


def unbundled(sizes: DataFrame, present: DataFrame) -> DataFrame:
    """Alignments of chromosomes that have no size."""
    return present.select("chrom").distinct().join(sizes, "chrom", "left_anti")


def bundled_rows(psl: DataFrame, bundled: DataFrame) -> DataFrame:
    """Alignment rows with their bundle; joined by chromosome, ready for `partitionBy("bundle")`."""
    return psl.join(bundled.select("bundle", F.col("chrom").alias("t_name")), "t_name")
