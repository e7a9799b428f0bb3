"""Lists of chromosome sizes: name, tab, size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value): lines with their place; a list is one small file, read in file order."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.posexplode(F.split(F.regexp_replace("value", "\r|\n$", ""), "\n")).alias("ord", "value")).select(F.col("ord").cast("long").alias("ord"), "value")


def deduplicated(rows: DataFrame) -> DataFrame:
    """(chrom, size, ord): a repeated chromosome keeps its last size and its first place."""
    return rows.groupBy("chrom").agg(F.max_by("size", F.struct("ord", "size")).alias("size"), F.min("ord").alias("ord"))


def read_sizes(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, size, ord) of a list; more columns are ignored, a line without a size is an error."""
    f = F.split("value", "\t")
    size = F.when(F.size(f) >= 2, F.trim(F.get(f, F.lit(1)))).otherwise(F.raise_error(F.concat(F.lit("no size in line "), (F.col("ord") + 1).cast("string"))).cast("string"))
    return deduplicated(_lines(spark, path).select(f[0].alias("chrom"), size.cast("long").alias("size"), "ord"))


def read_sizes_strict(spark: SparkSession, path: str) -> DataFrame:
    """As `read_sizes`, but a line that isn't exactly a name and an integer is an error with its number."""
    f = F.split("value", "\t")
    good = (F.size(f) == 2) & F.get(f, F.lit(1)).rlike("^[0-9]+$")
    size = F.when(good, F.get(f, F.lit(1))).otherwise(F.raise_error(F.concat(F.lit("line "), (F.col("ord") + 1).cast("string"), F.lit(" needs a name and an integer size"))).cast("string"))
    return deduplicated(_lines(spark, path).select(f[0].alias("chrom"), size.cast("long").alias("size"), "ord"))
