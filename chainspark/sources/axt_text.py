"""AXT text: pairwise alignments as a header line and two gapped sequence lines, records apart by a blank line.

Places in headers count from 1 and include the end; those of the query are on its strand. Lines that begin
with `#` are comments. Records are read and written as rows, so files split wherever a record ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import ranked
from ..functions.text import flat, pieces
from ..operators.tiles import with_bases
from ..scratch import small_batches

_HEAD = ["n", "t_name", "t_start", "t_end", "q_name", "q_start", "q_end", "strand", "score"]
_LONG = {"n", "t_start", "t_end", "q_start", "q_end", "score"}
BLOCKS = "array<struct<t:bigint,q:bigint,size:bigint,t_seq:string,q_seq:string>>"
#: Columns of alignments that a task turns to blocks at once.
COLUMNS = 1 << 20


def records(spark: SparkSession, path: str) -> DataFrame:
    """(value): one record a row, whatever stands around it."""
    return spark.read.text(path, lineSep="\n\n")


def parsed(rows: DataFrame) -> DataFrame:
    """(n, t_name, t_start, t_end, q_name, q_start, q_end, strand, score, t_line, q_line) of records; starts count from 0.

    Rows without a header and two lines, such as comments alone, are passed over.
    """
    lines = F.filter(F.split(F.regexp_replace("value", "\r", ""), "\n"), lambda x: (F.trim(x) != "") & ~x.startswith("#"))
    f = F.split(F.trim(F.get("lines", 0)), r"\s+")
    of = [(F.get(f, i).cast("long") if c in _LONG else F.get(f, i)).alias(c) for i, c in enumerate(_HEAD)]
    got = rows.select(lines.alias("lines")).where(F.size("lines") >= 3).select(*of, F.trim(F.get("lines", 1)).alias("t_line"), F.trim(F.get("lines", 2)).alias("q_line"))
    return got.withColumn("t_start", F.col("t_start") - 1).withColumn("q_start", F.col("q_start") - 1)


def read_axt(spark: SparkSession, path: str) -> DataFrame:
    return parsed(records(spark, path))


def _blocks(batch: pa.RecordBatch) -> pa.Array:
    """`BLOCKS` of the records of a batch: runs of columns without a gap, all records at once."""
    (t, t_ends), (q, q_ends) = flat(batch.column("t_line")), flat(batch.column("q_line"))
    size = np.diff(t_ends)
    for i in np.flatnonzero(size != np.diff(q_ends))[:1].tolist():
        raise ValueError(f"record {batch.column('n')[i].as_py()}: lines of {size[i]} and {q_ends[i + 1] - q_ends[i]} columns")
    t, q, first = t[t_ends[0] : t_ends[-1]], q[q_ends[0] : q_ends[-1]], t_ends - t_ends[0]
    t_there, q_there = t != 45, q != 45
    both = t_there & q_there
    new = np.zeros(len(both) + 1, dtype=bool)
    new[first] = True  # no run goes on from one record to the next
    begin = np.flatnonzero(both & (new[:-1] | ~np.append(False, both[:-1])))
    end = np.flatnonzero(both & (new[1:] | ~np.append(both[1:], False))) + 1
    record = np.searchsorted(first, begin, side="right") - 1
    place = []
    for there, start in ((t_there, "t_start"), (q_there, "q_start")):
        before = np.append(0, np.cumsum(there, dtype=np.int64))
        place.append(before[begin] - before[first[record]] + batch.column(start).to_numpy(zero_copy_only=False)[record])
    n = np.append(0, np.cumsum(end - begin)).astype(np.int64)
    cut = lambda line: pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(n.tobytes()), pa.py_buffer(line[both].tobytes())).cast(pa.string())
    rows = pa.StructArray.from_arrays([pa.array(place[0], pa.int64()), pa.array(place[1], pa.int64()), pa.array(end - begin, pa.int64()), cut(t), cut(q)], names=["t", "q", "size", "t_seq", "q_seq"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(record, np.arange(len(size) + 1)), pa.int32()), rows)


def with_blocks(axt: DataFrame) -> DataFrame:
    """Rows of `parsed` with `blocks`, as alignments have them, in place of both lines.

    A task holds the blocks of `COLUMNS` columns at a time, or of one record.
    """
    keep = [c for c in axt.columns if c not in ("t_line", "q_line")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in pieces(flat(batch.column("t_line"))[1], COLUMNS):
                some = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in keep], _blocks(some)], names=[*keep, "blocks"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in axt.select(keep).schema.fields)
    return small_batches(axt).mapInArrow(run, f"{kinds}, blocks {BLOCKS}")


def sized(axt: DataFrame, t_sizes: DataFrame, q_sizes: DataFrame) -> DataFrame:
    """`axt` with t_size and q_size of lists (chrom, size); rows with a name that a list lacks are left out."""
    size = lambda df, s: df.select(F.col("chrom").cast("string").alias(f"{s}_name"), F.col("size").cast("long").alias(f"{s}_size"))
    return axt.join(size(t_sizes, "t"), "t_name").join(size(q_sizes, "q"), "q_name")


def gapped_lines(alignments: DataFrame, target: DataFrame, query: DataFrame) -> DataFrame:
    """Alignments (t_name, q_name, strand, score, blocks) as rows of `parsed` without n; `query` holds the bases of their strand."""
    first, last = F.get("blocks", 0), F.element_at("blocks", -1)
    rows = alignments.where(F.size("blocks") > 0).select("t_name", first["t"].alias("t_start"), (last["t"] + last["size"]).alias("t_end"), "q_name", first["q"].alias("q_start"), (last["q"] + last["size"]).alias("q_end"), "strand", "score", F.transform("blocks", lambda b: F.struct(b["t"].alias("t"), b["q"].alias("q"), b["size"].alias("size"))).alias("blocks"))
    rows = with_bases(with_bases(rows, target, "t_name", "t_start", "t_end", "t_seq"), query, "q_name", "q_start", "q_end", "q_seq")
    names = _HEAD[1:]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            lines = []
            for t_seq, q_seq, t0, q0, blocks in pdf[["t_seq", "q_seq", "t_start", "q_start", "blocks"]].itertuples(index=False, name=None):
                a, b, t, q = [], [], t0, q0
                for x in blocks:
                    dt, dq, n = x["t"] - t, x["q"] - q, x["size"]
                    a += [t_seq[t - t0 : t - t0 + dt], "-" * dq, t_seq[x["t"] - t0 : x["t"] - t0 + n]]
                    b += ["-" * dt, q_seq[q - q0 : q - q0 + dq], q_seq[x["q"] - q0 : x["q"] - q0 + n]]
                    t, q = x["t"] + n, x["q"] + n
                lines.append(("".join(a), "".join(b)))
            yield pdf[names].assign(t_line=[x for x, _ in lines], q_line=[x for _, x in lines])

    return rows.mapInPandas(run, "t_name string, t_start long, t_end long, q_name string, q_start long, q_end long, strand string, score long, t_line string, q_line string")


def numbered(axt: DataFrame) -> DataFrame:
    """`axt` with n from 0 in the order of the target, then of the query."""
    order = [F.col(c) for c in ("t_name", "t_start", "t_end", "q_name", "strand", "q_start", "q_end", "score")]
    return ranked(axt.drop("n"), order).withColumnRenamed("idx", "n")


def axt_lines(axt: DataFrame) -> DataFrame:
    """(value): one record a row, with a blank line after it."""
    one = {"t_start", "q_start"}
    head = F.concat_ws(" ", *[(F.col(c) + 1 if c in one else F.col(c)).cast("string") for c in _HEAD])
    return axt.select(F.concat_ws("\n", head, "t_line", "q_line", F.lit("")).alias("value"))


def write_axt(axt: DataFrame, path: str, gzip: bool = True, mode: str = "overwrite") -> None:
    w = axt_lines(axt).write.mode(mode).option("lineSep", "\n")
    (w.option("compression", "gzip") if gzip else w).text(path)
