"""Token-id files with a minimal perfect hash index from document key to place.

Files below a store's folder:

* `payload/<shard>.ids`: raw ids, little-endian, of the documents of a shard one after another, in
  ascending key order; shards are key ranges, so the payloads in shard order are in key order;
* `index/<file>.mph`: parts one after another, then their places. For the keys whose hash falls to a
  part, it has a minimal perfect hash (bucket displacements) and, slot by slot, a stored fingerprint,
  the shard, the place and the length.

A lookup hashes the key, reads one displacement and one slot and compares the fingerprint: constant
time however large the store is; a key that isn't there fails the fingerprint (but for 2^-32).
Building and lookup are by part, each of about `PART_KEYS` keys, `FILE_PARTS` at most to a file; a
shard has about `SHARD_BYTES` of text at most, so numbers of files grow with the data, sizes don't.

Tasks write to a name of their own and rename, so a task that runs again, or twice, leaves the same
file. Paths go through pyarrow's file systems, so local, HDFS, S3 and GCS folders work.

Edge cases: a null text has only the end id; rows with one key are told apart by their number in
the order (key, ids), and are written by one task (keys are meant to be names); null keys come first and can be looked up like others; an empty table gives
an empty store; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, group_starts, key_cuts, mix64, range_of, schema_of, tasks, tuned
from .tokens import tokenised

PART_KEYS, FILE_PARTS, SHARD_BYTES = 20_000, 256, 256 << 20
_MAGIC, _END = b"MPHIDX01", b"MPHEND01"
_PLACE = np.dtype([("part", "<u8"), ("at", "<u8"), ("size", "<u8")])
_SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("length", "<u4")])


@dataclass(frozen=True)
class Store:
    path: str
    width: int  # bytes of an id
    parts: int  # parts of the index
    files: int  # files that hold them
    shards: DataFrame  # shard, tokens_before: ids in all earlier shards


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


# --- the hash ---


def _hash(h: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    return mix64(h + np.uint64(0x9E3779B97F4A7C15) * np.asarray(seed, dtype=np.uint64))


def build_index(h0: np.ndarray, h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacements, slot of each key) for distinct 128-bit keys (h0, h1): slots are 0 .. n - 1.

    Buckets of four keys on average, largest first: the first displacement that sends all keys of a
    bucket to free slots; a bucket of one key takes a free slot outright, stored as -1 - slot.
    """
    n = len(h0)
    buckets = max(1, (n + 3) // 4)
    home = (_hash(h0, 1) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    count = np.bincount(home, minlength=buckets)
    begin = np.concatenate([[0], np.cumsum(count)])
    move = np.zeros(buckets, dtype=np.int64)
    slot = np.full(n, -1, dtype=np.int64)
    free = np.ones(n, dtype=bool)
    many = np.argsort(-count, kind="stable")
    for b in many[: int((count > 1).sum())]:
        keys = order[begin[b] : begin[b + 1]]
        if len({(int(x), int(y)) for x, y in zip(h0[keys], h1[keys], strict=True)}) < len(keys):
            raise ValueError("two keys share a 128-bit hash")
        tries, at = 64, 1
        while True:  # many displacements at once
            to = (_hash(h1[keys][None, :], np.arange(at, at + tries)[:, None]) % np.uint64(n)).astype(np.int64)
            ok = free[to].all(axis=1)
            if len(keys) > 1 and ok.any():
                s = np.sort(to, axis=1)
                ok &= (s[:, 1:] != s[:, :-1]).all(axis=1)
            if ok.any():
                k = int(np.argmax(ok))
                move[b], slot[keys] = at + k, to[k]
                free[to[k]] = False
                break
            at += tries
            tries = min(4096, tries * 2)
    single = np.flatnonzero(count == 1)
    left = np.flatnonzero(free)
    keys = order[begin[single]]
    slot[keys] = left
    move[single] = -1 - left
    return move, slot


class Index:
    """One index file: slots of many keys at a time."""

    def __init__(self, raw: bytes):
        if raw[:8] != _MAGIC:
            raise ValueError("not an index file")
        n, buckets = np.frombuffer(raw, dtype="<u8", count=2, offset=8).tolist()
        self.n = n
        self.move = np.frombuffer(raw, dtype="<i8", count=buckets, offset=24)
        self.slots = np.frombuffer(raw, dtype=_SLOT, count=n, offset=24 + 8 * buckets)

    @staticmethod
    def packed(h0: np.ndarray, h1: np.ndarray, shard: np.ndarray, at: np.ndarray, length: np.ndarray) -> bytes:
        move, slot = build_index(h0, h1)
        slots = np.zeros(len(h0), dtype=_SLOT)
        slots["mark"][slot] = mark_of(h0, h1)
        slots["shard"][slot], slots["at"][slot], slots["length"][slot] = shard, at, length
        return _MAGIC + np.array([len(h0), len(move)], dtype="<u8").tobytes() + move.astype("<i8").tobytes() + slots.tobytes()

    def find(self, h0: np.ndarray, h1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot records) of the keys."""
        if not self.n:
            return np.zeros(len(h0), dtype=bool), np.zeros(len(h0), dtype=_SLOT)
        move = self.move[(_hash(h0, 1) % np.uint64(len(self.move))).astype(np.int64)]
        slot = np.where(move < 0, -1 - move, (_hash(h1, np.maximum(move, 0)) % np.uint64(self.n)).astype(np.int64))
        got = self.slots[slot]
        return got["mark"] == mark_of(h0, h1), got


def mark_of(h0: np.ndarray, h1: np.ndarray) -> np.ndarray:
    """The stored fingerprint of a key."""
    return (mix64(h0 ^ (h1 >> np.uint64(7))) >> np.uint64(32)).astype(np.uint32)


def _file_of(part: Column, parts: int, files: int) -> Column:
    """The index file of a part: neighbours lie together."""
    return F.floor(part.cast("long") * files / parts).cast("int")


def _hashed(df: DataFrame, parts: int) -> DataFrame:
    h0, h1 = F.xxhash64("key", "nth"), F.xxhash64(F.lit("second"), "nth", "key")
    return df.withColumn("h0", h0).withColumn("h1", h1).withColumn("part", F.pmod(h0, F.lit(parts)).cast("int"))


# --- writing ---


def _payload(batches: Iterator[pa.RecordBatch], path: str, width: int) -> Iterator[pa.RecordBatch]:
    """Writes the shards of a partition, rows sorted by (shard, key, ids); returns each row's place."""
    shard, out, own, at, last, nth = None, None, "", 0, object(), 0
    fs, root = _open(path)
    fs.create_dir(root, recursive=True)

    def close() -> None:
        if out is not None:
            out.close()
            fs.move(own, f"{root}/{shard:06d}.ids")

    for b in batches:
        rows: list[list] = [[], [], [], [], []]
        for s, key, ids in zip(b.column("shard").to_pylist(), b.column("key").to_pylist(), b.column("ids"), strict=True):
            if s != shard:
                close()
                shard, at, own, last = s, 0, f"{root}/{uuid.uuid4().hex}", object()
                out = fs.open_output_stream(own)
            nth = nth + 1 if key == last else 0
            last = key
            raw = ids.as_buffer()
            out.write(raw)
            n = raw.size // width
            for c, v in zip(rows, (key, nth, s, at, n), strict=True):
                c.append(v)
            at += n
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["key", "nth", "shard", "at", "length"])
    close()


def _indexed(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Writes index files, rows sorted by (file, part): a part at a time, the places of all parts at the end."""
    fs, root = _open(path)
    fs.create_dir(root, recursive=True)
    held: list[pa.RecordBatch] = []  # rows of one part
    out, own, file, keys, places = None, "", None, 0, []

    def flush() -> None:
        nonlocal out, own, file, keys, places
        t = pa.Table.from_batches(held)
        get = lambda c: t.column(c).to_numpy()
        if out is None:
            out, own, file = fs.open_output_stream(f"{root}/{(name := uuid.uuid4().hex)}"), f"{root}/{name}", int(get("file")[0])
        raw = Index.packed(get("h0").view(np.uint64), get("h1").view(np.uint64), get("shard"), get("at"), get("length"))
        places.append((int(get("part")[0]), out.tell(), len(raw)))
        out.write(raw)
        keys += t.num_rows
        held.clear()

    def close() -> pa.RecordBatch:
        nonlocal out, keys, places
        table = np.array(places, dtype=_PLACE)
        out.write(table.tobytes() + np.array([len(table)], dtype="<u8").tobytes() + _END)
        out.close()
        fs.move(own, f"{root}/{file:06d}.mph")
        done = pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([keys], pa.int64())], names=["file", "keys"])
        out, keys, places = None, 0, []
        return done

    for b in batches:
        part = b.column("part").to_numpy()
        edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(part)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if lo == hi:
                continue
            if held and held[-1].column("part")[0].as_py() != part[lo]:
                flush()
            if out is not None and file != b.column("file")[lo].as_py():
                yield close()
            held.append(b.slice(lo, hi - lo))
    if held:
        flush()
        yield close()


def write_store(documents: DataFrame, key: str, path: str, tokenizer: str, end_id: int) -> Store:
    """Tokenises `documents` and writes a store; keys are 64-bit integers."""
    spark = tuned(documents.sparkSession)
    scratch = Scratch(spark, "store-index")
    rows = documents.select(F.col(key).cast("long").alias("key"), "text")
    coded, width = tokenised(rows, tokenizer, end_id, ["key"])
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cuts = key_cuts(rows.select("key"), "key", max(tasks(spark), -(-size // SHARD_BYTES)))
    ranged = coded.withColumn("shard", range_of("key", cuts)).repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "key", "ids")
    places = scratch.keep(
        ranged.select("shard", "key", "ids").mapInArrow(lambda it: _payload(it, f"{path}/payload", width.itemsize), schema_of("key long, nth long, shard long, at long, length long")),
        "places",
    )
    count = places.count()
    parts = max(1, -(-count // PART_KEYS))

    files = max(min(parts, tasks(spark)), -(-parts // FILE_PARTS))
    dealt = _hashed(places, parts).withColumn("file", _file_of(F.col("part"), parts, files)).repartitionById(files, F.col("file")).sortWithinPartitions("file", "part")
    cols = ["file", "part", "h0", "h1", "shard", "at", "length"]
    built = scratch.keep(dealt.select(cols).mapInArrow(lambda it: _indexed(it, f"{path}/index"), schema_of("file int, keys long")), "files")
    if (built.agg(F.sum("keys")).first()[0] or 0) != count:
        raise RuntimeError("the index does not hold every key")
    totals = places.groupBy("shard").agg(F.sum("length").alias("tokens"))
    return Store(path, width.itemsize, parts, files, scratch.keep(group_starts(totals, "shard", ["tokens"], groups=len(cuts) + 1), "shards"))


# --- reading ---


class IndexFile:
    """An open index file: where its parts lie."""

    def __init__(self, f: pa.NativeFile):
        self.f, size = f, f.size()
        f.seek(size - 16)
        n, end = int(np.frombuffer(f.read(8), dtype="<u8")[0]), f.read(8)
        if end != _END:
            raise ValueError("not an index file")
        f.seek(size - 16 - n * _PLACE.itemsize)
        self.places = {int(p["part"]): (int(p["at"]), int(p["size"])) for p in np.frombuffer(f.read(n * _PLACE.itemsize), dtype=_PLACE)}

    def part(self, number: int) -> Index | None:
        """The part's hash and slots; None for a part without keys."""
        if number not in self.places:
            return None
        at, size = self.places[number]
        self.f.seek(at)
        return Index(self.f.read(size))


def _places(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Looks keys up, rows sorted by (file, part); keys that are not in the store give no row."""
    fs, root = _open(path)
    file, opened, part, index = None, None, None, None
    for b in batches:
        p = b.column("part").to_numpy()
        edges = [0, *(np.flatnonzero(p[1:] != p[:-1]) + 1).tolist(), len(p)]
        for lo, hi in zip(edges, edges[1:], strict=False):
            if lo == hi:
                continue
            if p[lo] != part:
                part, now = int(p[lo]), b.column("file")[lo].as_py()
                if now != file:
                    if opened is not None:
                        opened.f.close()
                    file, at = now, f"{root}/{now:06d}.mph"
                    opened = IndexFile(fs.open_input_file(at)) if fs.get_file_info(at).type == pafs.FileType.File else None
                index = opened.part(part) if opened is not None else None
            if index is None:
                continue
            s = b.slice(lo, hi - lo)
            ok, got = index.find(s.column("h0").to_numpy().view(np.uint64), s.column("h1").to_numpy().view(np.uint64))
            keep = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays(
                [s.column("key").take(keep), s.column("nth").take(keep), *[pa.array(got[c][ok].astype(np.int64)) for c in ("shard", "at", "length")]],
                names=["key", "nth", "shard", "at", "length"],
            )


def _payloads(batches: Iterator[pa.RecordBatch], path: str, width: int) -> Iterator[pa.RecordBatch]:
    """Reads the ids at each place, rows sorted by (shard, at)."""
    fs, root = _open(path)
    shard, f = None, None
    for b in batches:
        ids = []
        for s, at, n in zip(b.column("shard").to_pylist(), b.column("at").to_pylist(), b.column("length").to_pylist(), strict=True):
            if s != shard:
                if f is not None:
                    f.close()
                shard, f = s, fs.open_input_file(f"{root}/{s:06d}.ids")
            if f.tell() != at * width:
                f.seek(at * width)
            ids.append(f.read(n * width))
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], names=[*b.schema.names, "ids"])
    if f is not None:
        f.close()


def lookup(store: Store, keys: DataFrame) -> DataFrame:
    """(key, nth, shard, at, length) of those rows (key, nth) that the store has."""
    spark = keys.sparkSession
    rows = _hashed(keys.select(F.col("key").cast("long").alias("key"), F.col("nth").cast("long").alias("nth")), store.parts)
    path = f"{store.path}/index"
    rows = rows.withColumn("file", _file_of(F.col("part"), store.parts, store.files))
    rows = rows.repartition(max(1, min(tasks(spark), store.parts)), "part").sortWithinPartitions("file", "part")
    return rows.mapInArrow(lambda it: _places(it, path), schema_of("key long, nth long, shard long, at long, length long"))


def fetch(store: Store, places: DataFrame) -> DataFrame:
    """`places` with their ids (binary, little-endian) read from the payloads."""
    spark = places.sparkSession
    path, width = f"{store.path}/payload", store.width
    rows = places.select("key", "nth", "shard", "at", "length").repartition(tasks(spark), "shard").sortWithinPartitions("shard", "at")
    return rows.mapInArrow(lambda it: _payloads(it, path, width), schema_of("key long, nth long, shard long, at long, length long, ids binary"))


def ids_crc(ids: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """Columns `keep` and ids_crc32: the checksum of column ids, widened to 32 bits an id."""
    kind = np.dtype("<u2") if width == 2 else np.dtype("<u4")
    out = schema_of("ids_crc32 long")
    for f in reversed([ids.schema[c] for c in keep]):
        out.fields.insert(0, f)
        out.names.insert(0, f.name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [zlib.crc32(np.frombuffer(x.as_buffer(), dtype=kind).astype("<u4")) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(crc, pa.int64())], names=[*keep, "ids_crc32"])

    return ids.select(*keep, "ids").mapInArrow(run, out)


def numbered(documents: DataFrame, key: str) -> DataFrame:
    """The keys of a table with their number among equal ones: what `lookup` takes."""
    return documents.select(F.col(key).cast("long").alias("key")).withColumn("nth", (F.row_number().over(Window.partitionBy("key").orderBy("key")) - 1).cast("long"))


def new_store_path(spark: SparkSession) -> str:
    return Scratch(spark, "token-store").root
