"""Functions on names, partition strings and options, and on Arrow columns of strings."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Default of the inner threshold; it also replaces 0, empty and null.
INNER_THRESHOLD = 2000


def partition_string(file: Column, chrom: Column, start: Column, end: Column) -> Column:
    """`file:chrom:start-end`"""
    return F.concat(file, F.lit(":"), chrom.cast("string"), F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"))


def bulk_string(number: Column, file: Column, chroms: Column) -> Column:
    """`BULK_n:file:chrom:chrom...`"""
    return F.concat(F.lit("BULK_"), number.cast("string"), F.lit(":"), file, F.lit(":"), F.array_join(chroms, ":"))


def is_bulk(part: Column) -> Column:
    return part.startswith("BULK")


def parsed_spec(spec: Column) -> Column:
    """struct<path, chrom, start, end> of a file spec; without `:` in the file name the last three are null.

    A file name with `:` has to have exactly three fields, the last one `start-end`; else an error.
    """
    folder = F.regexp_extract(spec, "^(.*/)?", 0)
    name = F.substr(spec, F.length(folder) + F.lit(1))
    fields = F.split(name, ":")
    span = F.split(fields[2], "-")
    wrong = F.raise_error(F.concat(F.lit("a file spec needs path:chrom:start-end, not "), spec))
    plain = ~F.contains(name, F.lit(":"))
    good = (F.size(fields) == 3) & F.get(fields, F.lit(2)).rlike("^[0-9]+-[0-9]+$")
    at = lambda i: F.get(F.split(F.get(fields, F.lit(2)), "-"), F.lit(i)).cast("long")
    del span
    return F.struct(
        F.when(plain, spec).when(good, F.concat(folder, F.get(fields, F.lit(0)))).otherwise(wrong.cast("string")).alias("path"),
        F.when(plain, None).otherwise(F.get(fields, F.lit(1))).alias("chrom"),
        F.when(plain, None).otherwise(at(0)).alias("start"),
        F.when(plain, None).otherwise(at(1)).alias("end"),
    )


def sequence_argument(path: Column, chrom: Column, start: Column, end: Column) -> Column:
    """What an aligner is asked for: 1-based, inclusive ranges."""
    span = F.concat(F.lit("["), (start + 1).cast("string"), F.lit(","), end.cast("string"), F.lit("]"))
    return F.when(chrom.isNull(), F.concat(path, F.lit("[multiple]"))).when(path.endswith(".2bit"), F.concat(path, F.lit("/"), chrom, span)).otherwise(F.concat(path, span))


def bucket_key(part: Column) -> Column:
    """The group of a reference partition: `bucket_ref_<chrom>_in_<start>_<end>` or `bucket_ref_bulk_<n>`."""
    fields = F.split(part, ":")
    span = F.split(F.get(fields, F.lit(2)), "-")
    number = F.regexp_extract(part, "^BULK_([0-9]+)", 1)
    return F.when(is_bulk(part), F.concat(F.lit("bucket_ref_bulk_"), number)).otherwise(
        F.concat(F.lit("bucket_ref_"), F.get(fields, F.lit(1)), F.lit("_in_"), F.get(span, F.lit(0)), F.lit("_"), F.get(span, F.lit(1)))
    )


def safe_name(part: Column) -> Column:
    """A name for files: `BULK_n` or `chrom_start-end`."""
    fields = F.split(part, ":")
    return F.when(is_bulk(part), F.get(fields, F.lit(0))).otherwise(F.concat(F.get(fields, F.lit(1)), F.lit("_"), F.get(fields, F.lit(2))))


def falsy_default(value: Column, default: int = INNER_THRESHOLD) -> Column:
    """The default where the value is missing or 0."""
    return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)


def aligner_options(params: Mapping[str, object]) -> str:
    """`K=... H=...` from the keys `lastz_*`, in the order given."""
    head = "lastz_"
    return " ".join(f"{k[len(head) :].upper()}={v}" for k, v in params.items() if k.startswith(head) and v is not None)


def options_column(params: Column) -> Column:
    """As `aligner_options`, for a column of map<string, string>."""
    mine = F.filter(F.map_entries(params), lambda e: e["key"].startswith("lastz_") & e["value"].isNotNull())
    return F.array_join(F.transform(mine, lambda e: F.concat(F.upper(F.substr(e["key"], F.lit(7))), F.lit("="), e["value"])), " ")


def near_boundary(start: Column, end: Column, window: int, chunk: int, overlap: int) -> Column:
    """Whether [start - window, end + window] spans a chunk boundary; floors, also below zero."""
    stride = chunk - overlap
    return F.floor((start - window) / F.lit(float(stride))) != F.floor((end + window) / F.lit(float(stride)))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends) of a column of strings: row i is bytes[ends[i]:ends[i + 1]]."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    held = column.buffers()[2]
    return np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8), ends


def pieces(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(from, to): rows in order, as many at a time as hold at most `most` bytes, one at least."""
    at = 0
    while at < len(ends) - 1:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield at, to
        at = to
