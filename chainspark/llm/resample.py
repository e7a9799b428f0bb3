"""Importance resampling towards a target: documents whose words look like the target's are drawn more often.

Features are runs of 1 to `n` consecutive words, told apart by a bucket: the crc32 of their bytes modulo
`buckets`. Two passes read the texts. The first counts buckets over all documents and over the target (an
array a task, summed by bucket); the log ratio of both, smoothed, is a bucket's gain. The second scores each
document in arrays: its weight is the sum of its features' gains. A document's noise is a Gumbel value
made from a hash of its id, so that the k highest sums of weight and noise are a draw without replacement in
proportion to exp(weight).

The k-th highest is found exactly by radix selection: the key (score descending, doc_id, row) is read as
digits of 12 bits, most significant first. A round counts, among rows that agree with the digits found
so far, each value of the next one (at most 4096 counts), and takes the value in which the k-th row lies;
digits that all rows share are passed over. Only rows up to that key are range-sorted and numbered.

Edge cases: null text holds no word; a document without features weighs 0; fewer words than `least` are
never drawn; null doc_id is hashed as an empty string and comes last among equal scores; repeated
doc_ids are documents of their own, equal keys in the order in which rows are read; empty documents or an empty target
leave counts of 0, which smoothing allows; further columns are ignored. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, schema_of, text_blocks, tuned
from .ordered import positions

#: Bytes of words: digits, letters and all that is beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1).astype(np.uint32)
#: Bytes of the longest run that is hashed beside others.
LONG = 64
#: Bits of a digit of the radix selection.
DIGIT = 12


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes with A-Z lowered, start and end of each word, first word of each text and the number of words)."""
    n = len(data)
    word = np.zeros(n + 2, dtype=bool)
    word[1:-1] = _WORD[data]
    cut = np.zeros(n + 1, dtype=bool)  # texts end words too
    cut[offsets] = True
    start = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
    end = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
    return _LOWER[data], start, end, np.searchsorted(start, offsets)


def crc32_of(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of each piece, byte by byte for all pieces at once, the longer ones first."""
    size = end - start
    order = np.argsort(-np.minimum(size, LONG + 1), kind="stable")
    first, left = start[order], size[order]
    crc = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    longer = int(np.searchsorted(-left, -LONG, side="left")) if len(left) else 0
    for k in range(min(LONG, int(left.max(initial=0)))):
        m = int(np.searchsorted(-np.minimum(left, LONG + 1), -k, side="left"))  # pieces of more than k bytes
        crc[:m] = _CRC[(crc[:m] ^ low[first[:m] + k]) & 255] ^ (crc[:m] >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(longer):
        if left[i] > LONG:
            crc[i] = zlib.crc32(low[first[i] : first[i] + left[i]].tobytes())
    out = np.empty(len(order), dtype=np.uint32)
    out[order] = crc
    return out


def features(data: np.ndarray, offsets: np.ndarray, buckets: int, n: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each feature, its text, words of each text)."""
    low, start, end, first = words_of(data, offsets)
    count = np.diff(first)
    owner = np.repeat(np.arange(len(count)), count)
    found, owners = [], []
    for k in range(n):
        whole = np.flatnonzero(owner[: len(owner) - k] == owner[k:]) if len(owner) > k else np.zeros(0, dtype=np.int64)
        if k:  # words of a run, joined by one space
            size = sum((end - start)[whole + i] for i in range(k + 1)) + k
            ends = np.cumsum(size)
            joined = np.full(int(ends[-1]) if len(ends) else 0, 32, dtype=np.uint8)
            at = ends - size
            for i in range(k + 1):
                own = (end - start)[whole + i]
                spread = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
                joined[np.repeat(at, own) + spread] = low[np.repeat(start[whole + i], own) + spread]
                at = at + own + 1
            crc = crc32_of(joined, ends - size, ends)
        else:
            crc = crc32_of(low, start, end)
        found.append(crc % np.uint32(buckets))
        owners.append(owner[whole] if k else owner)
    return np.concatenate(found).astype(np.int64), np.concatenate(owners), count


def bucket_counts(texts: DataFrame, buckets: int, n: int = 1) -> np.ndarray:
    """How often each bucket is met in all texts; what reaches the driver is at most `buckets` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, _, data, offsets in text_blocks(b.column(0)):
                total += np.bincount(features(data, offsets, buckets, n)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "n"])

    tuned(texts.sparkSession)
    rows = texts.select(F.col("text").cast("string")).mapInArrow(run, schema_of("bucket long, n long"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio of target to own share) of each bucket."""
    s, t, k = own.astype(float), target.astype(float), float(len(own))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def weighed(documents: DataFrame, gain: np.ndarray, n: int = 1) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each document."""
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, counts, weights = ([np.zeros(0, dtype=np.int64)] for _ in range(3))
            for _, rows, data, offsets in text_blocks(b.column(1)):
                bucket, owner, count = features(data, offsets, buckets, n)
                words.append(count)
                counts.append(np.bincount(owner, minlength=rows))
                total = np.zeros(rows, dtype=np.int64)
                np.add.at(total, owner, gain[bucket])
                weights.append(total)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(np.concatenate(x).astype(np.int64)) for x in (words, counts, weights)]], names=["doc_id", "n_words", "n_features", "weight"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(run, schema_of("doc_id long, n_words long, n_features long, weight long"))


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel value), from the hash of `seed:doc_id`."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


# --- radix selection -------------------------------------------------------------------------------


def _digits(c: Column) -> list[Column]:
    """A long as digits, most significant first, that ascend as it does."""
    turned = c.bitwiseXOR(F.lit(-(2**63)))
    return [F.shiftrightunsigned(turned, s).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int") for s in range(60, -1, -DIGIT)]


def up_to_kth(rows: DataFrame, keys: list[Column], k: int) -> Column:
    """A condition that holds for exactly the first `k` of `rows` under ascending `keys` (longs, no nulls, together unique)."""
    total, *ends = rows.agg(F.count("*"), *[f(c) for c in keys for f in (F.min, F.max)]).first()
    if k <= 0 or not total:
        return F.lit(False)
    if k >= total:
        return F.lit(True)
    found: list[tuple[Column, int]] = []
    left = k
    for c, low, high in zip(keys, ends[::2], ends[1::2], strict=True):
        same = ((low ^ high) & (2**64 - 1)).bit_length()  # bits above these are shared
        for i, digit in enumerate(_digits(c)):
            if same <= 60 - DIGIT * i:
                continue
            inside = rows.where(_all([d == v for d, v in found])) if found else rows
            counts = sorted(inside.groupBy(digit.alias("v")).agg(F.count("*").alias("n")).collect())
            for v, n in counts:
                if left <= n:
                    break
                left -= n
            found.append((digit, v))
            if left == n:
                return _lexical(found)
    return _lexical(found)


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _lexical(found: list[tuple[Column, int]]) -> Column:
    """digits <= found values, compared from the first."""
    (d, v), *rest = found
    return (d < v) | ((d == v) & _lexical(rest)) if rest else d <= v


def resampled(documents: DataFrame, target: DataFrame, percent: int = 10, least: int = 20, buckets: int = 10_000, n: int = 1, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): floor(percent / 100) of the documents with `least` words are drawn.

    rank counts the drawn from 1, highest score first; it is null elsewhere.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "resample")
    gain = gains(bucket_counts(documents, buckets, n), bucket_counts(target, buckets, n))
    scored = weighed(documents, gain, n).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)).withColumn("row", F.monotonically_increasing_id())
    rows = scratch.keep(scored, "scored")
    able = rows.where(F.col("n_words") >= least)
    k = able.count() * percent // 100
    keys = [F.bitwise_not("score"), F.when(F.col("doc_id").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("row")]
    drawn = (F.col("n_words") >= least) & up_to_kth(able, keys, k)
    ranked = positions(rows.where(drawn), [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("row")], scratch, "drawn")
    shown = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*shown, (F.col("idx") + 1).cast("long").alias("rank")).union(rows.where(~drawn).select(*shown, F.lit(None).cast("long").alias("rank")))
