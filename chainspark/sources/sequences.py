"""Sequence files: FASTA and 2bit, read in chunks, so that a chromosome never has to fit in a row.

Both become rows (chrom, chunk_start, seq), and both split inside a sequence. A FASTA file is read by ranges of
its bytes: one pass counts each range's bases and finds its headers, running sums over the ranges say which
sequence a range begins in and how far on, and a second pass cuts it up. A 2bit file is a data source of Spark's
Python API whose partitions are ranges of bases; runs of unknown and masked bases are found by bisection.
Gzipped FASTA can't be split; such a file is a partition of a data source.
"""

from __future__ import annotations

import gzip
import struct
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..schemas import SEQUENCE
from ..scratch import Scratch

CHUNK = 1 << 20
#: Bytes of a FASTA file, or bases of a 2bit file, that one task reads.
SPLIT = 1 << 26
# --- fixed values: the 2bit format
MAGIC = 0x1A412743
CODES = "TCAG"
# --- end of fixed values


def _open(path: str):
    fs, at = pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    return fs, at


def _paths(path: str) -> list[str]:
    fs, at = _open(path)
    info = fs.get_file_info(at)
    if info.type != pafs.FileType.Directory:
        return [path]
    return sorted(x.path for x in fs.get_file_info(pafs.FileSelector(at)) if x.type == pafs.FileType.File)


class _Part(InputPartition):
    def __init__(self, *value):
        super().__init__(value)


class _FastaReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.chunk = options["path"], int(options.get("chunk", CHUNK))

    def partitions(self):
        return [_Part(p) for p in _paths(self.path)]

    def read(self, partition) -> Iterator[tuple]:
        (path,) = partition.value
        fs, at = _open(path)
        with fs.open_input_stream(at, compression=None) as raw:
            lines = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw
            chrom, start, held, size = None, 0, [], 0
            rest = b""
            while True:
                block = lines.read(1 << 16)
                rows = (rest + block).split(b"\n")
                rest = rows.pop() if block else b""
                for line in rows:
                    line = line.rstrip(b"\r")
                    if line.startswith(b">"):
                        if chrom is not None and (held or start == 0):
                            yield chrom, start, b"".join(held).decode()
                        name = line[1:].split()
                        chrom, start, held, size = (name[0].decode() if name else ""), 0, [], 0
                    elif chrom is not None and line:
                        held.append(line)
                        size += len(line)
                        if size >= self.chunk:
                            whole = b"".join(held)
                            for i in range(0, len(whole) - self.chunk + 1, self.chunk):
                                yield chrom, start, whole[i : i + self.chunk].decode()
                                start += self.chunk
                            held, size = [whole[len(whole) // self.chunk * self.chunk :]], len(whole) % self.chunk
                            held = [h for h in held if h]
                if not block:
                    break
            if chrom is not None and (held or start == 0):
                yield chrom, start, b"".join(held).decode()


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta"

    def schema(self) -> StructType:
        return SEQUENCE

    def reader(self, schema):
        return _FastaReader(self.options)


def header(raw: bytes) -> tuple[str, int]:
    """(byte order, version) of a 2bit file's first bytes; ValueError for anything else."""
    for order in "<>":
        magic, version = struct.unpack(f"{order}II", raw[:8]) if len(raw) >= 8 else (0, 0)
        if magic == MAGIC and version in (0, 1):
            return order, version
    raise ValueError("not a 2bit file")


def index(f) -> tuple[str, dict[str, int]]:
    """(byte order, offset by chromosome) of an open 2bit file."""
    order, version = header(f.read(8))
    count, _ = struct.unpack(f"{order}II", f.read(8))
    out = {}
    for _ in range(count):
        n = f.read(1)[0]
        name = f.read(n).decode()
        out[name] = struct.unpack(f"{order}{'Q' if version else 'I'}", f.read(8 if version else 4))[0]
    return order, out


class _TwoBitReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.chunk, self.split = options["path"], int(options.get("chunk", CHUNK)) // 4 * 4, int(options.get("split", SPLIT))
        self.only = set(filter(None, options.get("chroms", "").split(",")))

    def partitions(self):
        fs, at = _open(self.path)
        with fs.open_input_file(at) as f:
            order, places = index(f)
            sizes = {}
            for c, o in places.items():
                if not self.only or c in self.only:
                    f.seek(o)
                    sizes[c] = struct.unpack(f"{order}I", f.read(4))[0]
        # ranges of whole chunks; short sequences share a partition
        most, out, held, total = max(1, self.split // self.chunk) * self.chunk, [], [], 0
        for c, size in sizes.items():
            for lo in range(0, max(size, 1), most):
                held.append((c, places[c], lo, min(size, lo + most)))
                total += min(size, lo + most) - lo + 1024  # a sequence costs something besides its bases
                if total >= most:
                    out.append(_Part(order, tuple(held)))
                    held, total = [], 0
        return [*out, _Part(order, tuple(held))] if held or not out else out

    def read(self, partition) -> Iterator[tuple]:
        order, ranges = partition.value
        fs, at = _open(self.path)
        with fs.open_input_file(at) as f:
            for chrom, offset, lo, hi in ranges:
                yield from self._range(f, order, chrom, offset, lo, hi)

    def _range(self, f, order: str, chrom: str, offset: int, begin: int, stop: int) -> Iterator[tuple]:
        f.seek(offset)
        u = lambda n: np.frombuffer(f.read(4 * n), dtype=f"{order}u4").astype(np.int64)
        size = int(u(1)[0])
        spans = []
        for _ in range(2):
            n = int(u(1)[0])
            lo, hi = u(n), u(n)
            hi = lo + hi
            first, last = np.searchsorted(hi, begin, side="right"), np.searchsorted(lo, stop, side="left")
            spans.append((lo[first:last], hi[first:last]))  # runs are in order and disjoint
        u(1)
        base = f.tell()
        letters = np.frombuffer(CODES.encode(), dtype=np.uint8)
        for start in range(begin, stop, self.chunk) if size else (0,):
            n = min(self.chunk, stop - start)
            f.seek(base + start // 4)
            packed = np.frombuffer(f.read((n + 3) // 4), dtype=np.uint8)
            seq = letters[(packed[:, None] >> np.array([6, 4, 2, 0], dtype=np.uint8)) & 3].ravel()[:n].copy()
            for k, (lo, hi) in enumerate(spans):
                for i in range(np.searchsorted(hi, start, side="right"), np.searchsorted(lo, start + n, side="left")):
                    part = slice(max(0, int(lo[i]) - start), min(n, int(hi[i]) - start))
                    if k == 0:
                        seq[part] = ord("N")
                    else:
                        seq[part] |= 32
            yield chrom, start, seq.tobytes().decode()


class TwoBitSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "twobit"

    def schema(self) -> StructType:
        return SEQUENCE

    def reader(self, schema):
        return _TwoBitReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FastaSource)
    spark.dataSource.register(TwoBitSource)


def read_fasta(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """Sequences of a FASTA file or a folder of some, (chrom, chunk_start, seq); chunks hold at most `chunk` bases."""
    register(spark)
    files = _paths(path)
    whole = [spark.read.format("fasta").option("chunk", chunk).load(p) for p in files if p.endswith(".gz")]
    split = [p for p in files if not p.endswith(".gz")]
    out = [_split_fasta(spark, split, chunk)] if split else []
    return reduce(DataFrame.union, [*out, *whole]) if files else spark.createDataFrame([], SEQUENCE)


def _lines(path: str, lo: int, hi: int) -> Iterator[tuple[bool, bytes]]:
    """(whether it is a header, the bytes) of the lines of a range; bases by the range they lie in, a header by where it begins, whole."""
    fs, at = _open(path)
    with fs.open_input_file(at) as f:
        back = min(lo, NAME)
        f.seek(lo - back)
        before = f.read(back)
        inside = before.rpartition(b"\n")[2] if before else b""
        on_header, own, line_start = inside.startswith(b">"), False, not inside
        at, rest = lo, b""
        while at < hi:
            block = f.read(min(1 << 20, hi - at))
            if not block:
                break
            at += len(block)
            rows = block.split(b"\n")
            for n, row in enumerate(rows):
                last = n == len(rows) - 1
                if on_header:  # begun in an earlier range, or in the block before
                    rest += row
                    if not last:
                        if own:
                            yield True, rest
                        on_header, own, rest, line_start = False, False, b"", True
                elif line_start and row.startswith(b">"):
                    if last:
                        on_header, own, rest = True, True, row
                    else:
                        yield True, row
                else:
                    if row:
                        yield False, row.rstrip(b"\r") if not last else row.replace(b"\r", b"")
                        line_start = False
                    if not last:
                        line_start = True
        if own:  # ends beyond the range
            yield True, rest + f.read(NAME).partition(b"\n")[0]


#: Bytes of the longest header line.
NAME = 1 << 16
_RANGES = "path string, k long, lo long, hi long"


def _name(line: bytes) -> str:
    f = line[1:].split()
    return f[0].decode() if f else ""


def _split_fasta(spark: SparkSession, files: list[str], chunk: int) -> DataFrame:
    ranges = []
    for p in files:
        fs, at = _open(p)
        size = fs.get_file_info(at).size
        ranges += [(p, k, lo, min(size, lo + SPLIT)) for k, lo in enumerate(range(0, size, SPLIT))]
    if not ranges:
        return spark.createDataFrame([], SEQUENCE)
    # names of ranges only; each is a task of its own
    rows = spark.createDataFrame(ranges, _RANGES).repartition(len(ranges), "path", "k")

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Bases before a range's first header and behind its last one, and that one's name."""
        for pdf in it:
            out = []
            for path, k, lo, hi in pdf.itertuples(index=False, name=None):
                head, tail, name = 0, 0, None
                for is_header, line in _lines(path, lo, hi):
                    if is_header:
                        name, tail = _name(line), 0
                    elif name is None:
                        head += len(line)
                    else:
                        tail += len(line)
                out.append((path, k, lo, hi, head, tail, name))
            yield pd.DataFrame(out, columns=["path", "k", "lo", "hi", "head", "tail", "name"])

    seen = Scratch(spark, "fasta").keep(rows.mapInPandas(scan, f"{_RANGES}, head long, tail long, name string"), "ranges")
    w = Window.partitionBy("path").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    new = F.col("name").isNotNull()
    upto = seen.withColumn("sum", F.coalesce(F.sum(F.when(new, F.col("tail")).otherwise(F.col("head"))).over(w), F.lit(0)))
    at = upto.select("path", "k", "lo", "hi", F.last("name", ignorenulls=True).over(w).alias("name"), (F.col("sum") - F.coalesce(F.max(F.when(new, F.col("sum"))).over(w), F.lit(0))).alias("at"))

    def cut(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for path, _, lo, hi, name, start in pdf.itertuples(index=False, name=None):
                name = None if pd.isna(name) else name
                held, size, fresh = [], 0, False
                for is_header, line in _lines(path, lo, hi):
                    if is_header:
                        if name is not None and (held or fresh):
                            yield _chunk(name, start, held)
                        name, start, held, size, fresh = _name(line), 0, [], 0, True
                    elif name is not None:
                        held.append(line)
                        size += len(line)
                        while size >= chunk:
                            text = b"".join(held)
                            yield _chunk(name, start, [text[:chunk]])
                            start, held, size, fresh = start + chunk, [text[chunk:]] if size > chunk else [], size - chunk, False
                if name is not None and (held or fresh and next(_lines(path, hi, hi + NAME), (True,))[0]):
                    yield _chunk(name, start, held)  # without bases only if none follow in the next range

    return at.repartition(len(ranges), "path", "k").mapInPandas(cut, SEQUENCE)


def _chunk(name: str, start: int, held: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"chrom": [name], "chunk_start": [int(start)], "seq": [b"".join(held).decode()]})


def read_twobit(spark: SparkSession, path: str, chroms: list[str] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Sequences of a 2bit file; with `chroms`, only these are opened."""
    register(spark)
    return spark.read.format("twobit").option("chunk", chunk).option("split", SPLIT).option("chroms", ",".join(chroms or [])).load(path)


def read_listed(spark: SparkSession, lists: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Sequences that a .lst file names: (path, chrom) of `chain_text.read_list`; a path without a chromosome means all of it.

    A list names files, so it is short; of a 2bit file only the chromosomes asked for are opened.
    """
    by: dict[str, list[str] | None] = {}
    for r in lists.distinct().orderBy("path", "chrom").toLocalIterator():
        if not r["chrom"]:
            by[r["path"]] = None
        elif by.get(r["path"], []) is not None:
            by.setdefault(r["path"], []).append(r["chrom"])
    out = spark.createDataFrame([], SEQUENCE)
    for path, chroms in by.items():
        some = read_twobit(spark, path, chroms, chunk) if path.endswith(".2bit") else read_fasta(spark, path, chunk)
        out = out.union(some if chroms is None or path.endswith(".2bit") else some.where(F.col("chrom").isin(chroms)))
    return out


def read_genome(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: .2bit, else FASTA."""
    return read_twobit(spark, path) if path.endswith(".2bit") else read_fasta(spark, path)


def lengths(genome: DataFrame) -> DataFrame:
    """(chrom, size) of chunked sequences; only ends of chunks are aggregated."""
    return genome.groupBy("chrom").agg(F.max(F.col("chunk_start") + F.length("seq")).cast("long").alias("size"))


def write_genome(genome: DataFrame, path: str) -> None:
    """The genome store: Parquet by chromosome; a filter on chrom reads only that folder."""
    genome.write.partitionBy("chrom").mode("overwrite").parquet(path)


class _Record:
    """A chromosome's 2bit record, put together from chunks in order: packed bases, and runs of unknown and masked ones."""

    def __init__(self) -> None:
        self.size, self.packed, self.left = 0, [], np.zeros(0, dtype=np.uint8)
        self.runs: list[list[list[int]]] = [[], []]

    def add(self, seq: bytes) -> None:
        raw = np.frombuffer(seq, dtype=np.uint8)
        up = raw & ~np.uint8(32)
        for runs, mask in zip(self.runs, (up == ord("N"), (raw & 32) > 0), strict=True):
            edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
            for lo, hi in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                if runs and runs[-1][0] + runs[-1][1] == self.size + lo:
                    runs[-1][1] += hi - lo
                else:
                    runs.append([self.size + lo, hi - lo])
        code = np.zeros(len(raw), dtype=np.uint8)
        for i, c in enumerate(CODES):
            code[up == ord(c)] = i
        code = np.concatenate([self.left, code])
        whole = len(code) // 4 * 4
        self.left = code[whole:]
        self.packed.append(self._bytes(code[:whole]))
        self.size += len(raw)

    @staticmethod
    def _bytes(code: np.ndarray) -> bytes:
        return (code.reshape(-1, 4) << np.array([6, 4, 2, 0], dtype=np.uint8)).sum(axis=1).astype(np.uint8).tobytes()

    def parts(self) -> Iterator[bytes]:
        u = lambda x: np.asarray(x, dtype="<u4").tobytes()
        yield u([self.size])
        for runs in self.runs:
            yield u([len(runs)]) + u([r[0] for r in runs]) + u([r[1] for r in runs])
        yield u([0])
        yield from self.packed
        yield self._bytes(np.pad(self.left, (0, -len(self.left) % 4))) if len(self.left) else b""


def encoded_twobit(sequences: list[tuple[str, str]]) -> bytes:
    """A small 2bit file, version 0, for fixtures and exports of single scaffolds."""
    bodies = []
    for _, s in sequences:
        record = _Record()
        record.add(s.encode())
        bodies.append(b"".join(record.parts()))
    return _index([(n, len(b)) for (n, _), b in zip(sequences, bodies, strict=True)], 0) + b"".join(bodies)


def _index(records: list[tuple[str, int]], version: int) -> bytes:
    """Header and index of a 2bit file whose records have these names and lengths."""
    wide = 8 if version else 4
    at = 16 + sum(1 + wide + len(n.encode()) for n, _ in records)
    head = [struct.pack("<IIII", MAGIC, version, len(records), 0)]
    for n, size in records:
        head.append(bytes([len(n.encode())]) + n.encode() + struct.pack("<Q" if version else "<I", at))
        at += size
    return b"".join(head)


def write_twobit(genome: DataFrame, path: str) -> None:
    """A 2bit file of a genome of any size, with 64-bit places (version 1).

    Tasks write the records of their chromosomes beside the file, chunk by chunk from sorted rows, one
    packed chromosome in memory at a time; the driver then strings records together without reading
    them whole. Chromosomes come in the order of their names.
    """
    spark = genome.sparkSession
    base = F.col("chunk_start") if "chunk_start" in genome.columns else F.lit(0).cast("long")
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = genome.select(F.col("chrom").cast("string").alias("chrom"), base.alias("start"), "seq").repartition(n, "chrom").sortWithinPartitions("chrom", "start")
    beside = f"{path}.records-{uuid.uuid4().hex[:12]}"

    def run(batches):
        fs, root = _open(beside)
        fs.create_dir(root, recursive=True)
        chrom, record = None, None

        def close():
            own = f"{root}/{uuid.uuid4().hex}"
            size = 0
            with fs.open_output_stream(own) as f:
                for part in record.parts():
                    f.write(part)
                    size += len(part)
            return pa.RecordBatch.from_arrays([pa.array([chrom]), pa.array([own]), pa.array([size], pa.int64())], names=["chrom", "file", "size"])

        for b in batches:
            for c, s in zip(b.column("chrom").to_pylist(), b.column("seq").to_pylist(), strict=True):
                if c != chrom:
                    if record is not None:
                        yield close()
                    chrom, record = c, _Record()
                record.add(s.encode())
        if record is not None:
            yield close()

    found = sorted(rows.mapInArrow(run, "chrom string, file string, size long").collect())  # a row a chromosome
    fs, at = _open(path)
    with fs.open_output_stream(at) as out:
        out.write(_index([(r["chrom"], r["size"]) for r in found], 1))
        for r in found:
            with fs.open_input_stream(r["file"]) as f:
                while block := f.read(1 << 20):
                    out.write(block)
    if found:
        fs.delete_dir(_open(beside)[1])
