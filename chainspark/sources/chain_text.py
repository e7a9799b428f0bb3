"""Chain and PSL text, BED and manifests: readers and writers. Gzip is by suffix, as everywhere in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BED, BLOCKS, MANIFEST, PSL

_HEAD = ["score", "t_name", "t_size", "t_strand", "t_start", "t_end", "q_name", "q_size", "q_strand", "q_start", "q_end", "id"]
_LONG = {"score", "t_size", "t_start", "t_end", "q_size", "q_start", "q_end"}
_LINE = r"(?m)^chain ([^\n]*)$"


def _fields(line):
    f = F.split(F.trim(line), " +")
    return [(F.get(f, F.lit(i)).cast("long") if c in _LONG else F.get(f, F.lit(i))).alias(c) for i, c in enumerate(_HEAD)]


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """Chain headers only: lines that begin with `chain `, so block lines are never parsed."""
    rows = spark.read.text(path).where(F.col("value").startswith("chain "))
    return rows.select(*_fields(F.substring("value", 7, 2**31 - 1)))


def read_chains(spark: SparkSession, path: str) -> DataFrame:
    """Chains with their blocks: records end at a blank line; comments and other text are passed over."""
    rec = spark.read.text(path, lineSep="\n\n")
    body = F.regexp_replace("value", "\r", "")
    rec = rec.select(F.regexp_extract(body, _LINE, 1).alias("head"), F.element_at(F.split(body, r"(?m)^chain [^\n]*\n"), -1).alias("rest")).where("head <> ''")
    lines = F.filter(F.split("rest", "\n"), lambda x: x.rlike("^[0-9]"))
    block = lambda x: F.transform(F.split(F.trim(x), r"\s+"), lambda v: v.cast("long"))
    blocks = F.transform(lines, lambda x: F.struct(F.get(block(x), F.lit(0)).alias("size"), F.get(block(x), F.lit(1)).alias("dt"), F.get(block(x), F.lit(2)).alias("dq")))
    return rec.select(*_fields(F.col("head")), blocks.cast(BLOCKS).alias("blocks"))


def chain_lines(chains: DataFrame) -> DataFrame:
    """(value): one record a row, with a blank line after it."""
    head = F.concat_ws(" ", F.lit("chain"), *[F.col(c).cast("string") for c in _HEAD])
    lines = F.transform("blocks", lambda b: F.concat_ws("\t", b["size"].cast("string"), b["dt"].cast("string"), b["dq"].cast("string")))
    return chains.select(F.concat(head, F.lit("\n"), F.array_join(lines, "\n"), F.lit("\n")).alias("value"))


def write_chains(chains: DataFrame, path: str, gzip: bool = True, mode: str = "overwrite") -> None:
    """Text parts in the order of the rows; sort before for a sorted file set. `mode` append adds to what is there."""
    w = chain_lines(chains).write.mode(mode).option("lineSep", "\n")
    (w.option("compression", "gzip") if gzip else w).text(path)


def read_psl(spark: SparkSession, path: str) -> DataFrame:
    """PSL rows; lines that don't begin with a number are headings."""
    rows = spark.read.text(path).where(F.col("value").rlike("^[0-9]+\t"))
    f = F.split("value", "\t")
    longs = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("long"))
    out = []
    for i, field in enumerate(PSL.fields):
        kind = field.dataType.simpleString()
        v = F.get(f, F.lit(i))
        out.append((longs(v) if kind.startswith("array") else v.cast(kind)).alias(field.name))
    return rows.select(*out)


def write_psl(psl: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> None:
    """PSL text; `by` is a column whose values become folders, as bundles and references do."""
    cell = lambda f: F.concat(F.array_join(f.name, ","), F.lit(",")) if f.dataType.simpleString().startswith("array") else F.col(f.name).cast("string")
    out = psl.select(F.concat_ws("\t", *[cell(f) for f in PSL.fields]).alias("value"), *([by] if by else []))
    w = out.write.mode(mode)
    (w.partitionBy(by) if by else w).text(path)


def write_bed(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    rows.select(*BED.names).write.mode(mode).option("sep", "\t").csv(path)


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BED).option("sep", "\t").csv(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Genome pairs, four tab-separated fields each; an empty field is an error."""
    rows = spark.read.schema(MANIFEST).option("sep", "\t").option("mode", "FAILFAST").csv(path)
    bad = F.greatest(*[F.coalesce(F.trim(c) == "", F.lit(True)).cast("int") for c in MANIFEST.names])
    first = MANIFEST.names[0]
    checked = F.when(bad == 1, F.raise_error(F.lit("a manifest line needs four fields")).cast("string")).otherwise(F.col(first))
    return rows.select(checked.alias(first), *MANIFEST.names[1:])


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, chrom) of a .lst file: `path:chrom`; further fields are ignored, blank lines dropped."""
    f = F.split(F.trim("value"), ":")
    return spark.read.text(path).where(F.trim("value") != "").select(F.get(f, F.lit(0)).alias("path"), F.get(f, F.lit(1)).alias("chrom"))


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """(part) of a partition list, blanks trimmed and empty lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("part")).where("part <> ''")


def write_partitions(parts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A partition list in its order: parts (place, part) of `partition.ordered`; the files in name order are the list."""
    parts.orderBy("place").select("part").write.mode(mode).text(path)
