"""Document fingerprints from content-defined chunks.

A text is normalised (A-Z lowered, white space runs to one space), a gear hash of the last 32 bytes
is taken at every byte, and a chunk of 16 bytes or more ends where its
top bits are zero: five of them up to 64 bytes, then three. Where none are up to 128 bytes, as in
texts that repeat themselves, it ends at the place with the smallest hash (the last one of equals),
so no chunk is longer. So boundaries depend on the
text around them alone: an insertion moves them along, and chunks outside the edit stay the same,
mostly also where a text repeats itself. There an insertion can shift the chunks for good if a period has
several places to cut.
The fingerprint is the set of chunk digests with their lengths. Containment of a text in another is
the length of its chunks that the other has, over the length of all its chunks.

The gear hash is computed for whole blocks of texts by doubling: the hash over 2 w bytes is the hash
over w bytes plus the one w bytes earlier, shifted; five steps give 32 bytes.

Fingerprint string: `digest:length` for each distinct chunk, ascending, comma-joined; digest is 10
hex digits, length its bytes times its number of occurrences. An empty text has the empty string.

Edge cases: null text is empty; likeness of equal fingerprints is 1, of an empty to another 0; null
doc_id sorts first; rows with one doc_id sort by four bits of their text's hash, then by text; a single document is its own next one; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_cuts, key_parts, schema_of, tasks, tuned

GEAR = np.random.Generator(np.random.PCG64(90125)).integers(0, 2**32, 256, dtype=np.uint32)
WINDOW = 32
#: A chunk ends where this many of the hash's top bits are zero, once it has LEAST bytes: 43 on average.
BITS, LEAST = 5, 16
#: Past NORMAL bytes so many bits fewer have to be zero; no chunk has more than MOST bytes.
FEWER, NORMAL, MOST = 2, 64, 128
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split())


def gear(data: np.ndarray) -> np.ndarray:
    """The hash of the last 32 bytes at every byte."""
    h = GEAR[data]
    w = 1
    while w < WINDOW:
        h[w:] += h[:-w].copy() << np.uint32(w) if len(h) > w else 0
        w *= 2
    return h


def boundaries(data: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions after which a chunk may end."""
    return _zeros(gear(data), bits)


def _zeros(h: np.ndarray, bits: int) -> np.ndarray:
    # the upper bits have seen all 32 bytes
    return np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1


def chunk_lengths(texts: list[bytes], bits: int = BITS) -> list[dict[int, int]]:
    """For each normalised text, length by chunk digest."""
    out: list[dict[int, int]] = []
    gap = b"\n" * WINDOW  # normalised texts have no newline: each text is hashed from the same start
    at, starts = 0, []
    for t in texts:
        starts.append(at + WINDOW)
        at += WINDOW + len(t)
    data = np.frombuffer(gap + gap.join(texts), dtype=np.uint8)
    h = gear(data)
    loose = _zeros(h, bits - FEWER)
    cuts = loose[h[loose - 1] >> np.uint32(32 - bits) == 0].tolist()
    loose = loose.tolist()
    digest = xxhash.xxh3_64_intdigest
    for t, s in zip(texts, starts, strict=True):
        found: dict[int, int] = {}
        p, end = s, s + len(t)
        i = bisect_left(cuts, p + LEAST)
        while p < end:
            while i < len(cuts) and cuts[i] < p + LEAST:
                i += 1
            e = cuts[i] if i < len(cuts) else end
            if e > p + NORMAL:
                k = bisect_left(loose, p + NORMAL + 1)
                e = loose[k] if k < len(loose) else end
                if e > p + MOST < end:
                    # the last of the smallest hashes
                    e = p + MOST - int(h[p + LEAST - 1 : p + MOST][::-1].argmin())
            e = min(e, end)
            d = digest(t[p - s : e - s]) >> 24
            found[d] = found.get(d, 0) + e - p
            p = e
        out.append(found)
    return out


def as_text(chunks: dict[int, int]) -> str:
    return ",".join([f"{d:010x}:{n}" for d, n in sorted(chunks.items())])


def from_text(fingerprint: str) -> dict[int, int]:
    return {int(d, 16): int(n) for d, _, n in (x.partition(":") for x in fingerprint.split(",") if x)}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """How much of `a` is in `b`, by length: 0 to 1."""
    if a == b:
        return 1.0
    total = sum(a.values())
    return sum(min(n, b[d]) for d, n in a.items() if d in b) / total if total else 0.0


def edited(text: str, following: str) -> str:
    """`text` with its last floor(n / 4) code points replaced by the first as many (or all) of `following`."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def fingerprinted(documents: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint) of every row: no shuffle."""
    tuned(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                p = b.slice(at, 200)
                texts = [t or "" for t in p.column("text").to_pylist()]
                prints = [as_text(c) for c in chunk_lengths([normalised(t) for t in texts])]
                yield pa.RecordBatch.from_arrays([p.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(prints)], names=["doc_id", "n_chars", "fingerprint"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema_of("doc_id long, n_chars long, fingerprint string"))


def compared_with_next(documents: DataFrame) -> DataFrame:
    """Each document beside the next one by doc_id and its edit with that one's beginning.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Texts
    are shuffled once, into key ranges. Each range also gets the first document of the next one
    (the last range: the first of all), so a task walks its rows in order and needs nothing else.
    """
    spark = tuned(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = key_cuts(docs.select("doc_id"), "doc_id", 2 * tasks(spark, 8))
    # a very frequent doc_id is dealt by its texts' hashes as well, so rows with one doc_id follow each other by hash
    docs = docs.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 60).cast("long"))
    docs = docs.withColumn("part", key_parts("doc_id", cuts, F.col("tie"))).withColumn("borrowed", F.lit(0))
    order = F.struct(F.col("doc_id").isNotNull().alias("x"), F.coalesce("doc_id", F.lit(0)).alias("y"), F.col("tie").alias("z"))
    firsts = sorted(docs.select("part", order.alias("o")).groupBy("part").agg(F.min("o").alias("o")).collect())  # a row a range
    if not firsts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    lend = [(int(firsts[i - 1]["part"]), bool(r["o"]["x"]), int(r["o"]["y"]), int(r["o"]["z"])) for i, r in enumerate(firsts)]
    lent = F.broadcast(spark.createDataFrame(lend, "to long, x boolean, y long, z long"))
    ids = [y for _, x, y, _ in lend if x]
    wanted = F.col("doc_id").isin(ids) | F.lit(not all(x for _, x, *_ in lend)) & F.col("doc_id").isNull()
    heads = docs.where(wanted).join(lent, (F.coalesce("doc_id", F.lit(0)) == F.col("y")) & (F.col("doc_id").isNotNull() == F.col("x")) & (F.col("tie") == F.col("z")))
    heads = heads.groupBy("to").agg(F.min_by(F.struct("doc_id", "text", "tie"), "text").alias("d")).select("d.doc_id", "d.text", "d.tie", F.col("to").alias("part"), F.lit(1).alias("borrowed"))
    place = F.broadcast(spark.createDataFrame([(int(r["part"]), i) for i, r in enumerate(firsts)], "part long, place int"))
    rows = docs.unionByName(heads).join(place, "part").repartitionById(len(firsts), F.col("place")).sortWithinPartitions("part", "borrowed", "doc_id", "tie", "text")
    rows = rows.select("doc_id", "text", "part", "borrowed")
    ddl = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(_walk, schema_of(ddl))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple | None = None  # the row before: (part, doc_id, text, chunks)
    for b in batches:
        for at in range(0, b.num_rows, 200):
            p = b.slice(at, 200)
            texts = p.column("text").to_pylist()
            rows = list(zip(p.column("part").to_pylist(), p.column("doc_id").to_pylist(), texts, chunk_lengths([normalised(t) for t in texts]), p.column("borrowed").to_pylist(), strict=True))
            pairs = []
            for part, doc, text, chunks, borrowed in rows:
                if held is not None and held[0] == part:
                    pairs.append((held, (text, chunks)))
                held = None if borrowed else (part, doc, text, chunks)
            if not pairs:
                continue
            changed = [edited(h[2], n[0]) for h, n in pairs]
            theirs = chunk_lengths([normalised(t) for t in changed])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([h[1] for h, _ in pairs], pa.int64()),
                    pa.array([len(h[2]) for h, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
                    pa.array([as_text(h[3]) for h, _ in pairs]),
                    pa.array([as_text(c) for c in theirs]),
                    pa.array([containment(h[3], c) for (h, _), c in zip(pairs, theirs, strict=True)], pa.float64()),
                    pa.array([containment(h[3], n[1]) for h, n in pairs], pa.float64()),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )
