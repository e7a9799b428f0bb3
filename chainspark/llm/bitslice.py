"""Exact top-k by integer inner product over a bit-sliced index.

Components x become floor(256 * x). The index holds blocks of rows; of each component a block keeps its
smallest value and, of what lies above it, one bitmap over the rows for each binary digit (a slice). The
score of a query against all rows of a block is a weighted sum of components, so it is put together by
bitmap arithmetic alone: every set bit of a query's component adds that component's slices, shifted
(complemented where the component is negative). Slices of equal weight meet in full adders, three bitmaps
in, a sum and a carry out, until one slice a weight is left: the bit-sliced scores of all rows.

Top rows are then taken from the most significant slice downward: while those that have the bit are fewer
than k they are in and the rest goes on; otherwise only they go on. What is left at the end is the boundary:
rows of exactly the k-th score, of which the first by vec_id fill up.

Rows meet queries in blocks: each (block of rows, block of queries) is one row of a join on both block
numbers, and yields at most k rows a query. Those of all blocks meet in a ranking by query.

Edge cases: vectors that are null, or hold null or a non-finite component, take no part, as query or
candidate; vectors of different lengths are compared as if filled up with zeros; of an empty one all scores are 0.
Rows without vec_id are candidates (after all others at ties), never queries. A row is left out only of
its own list: another row with the same vec_id is a candidate, and each row with a query's vec_id gets a list
(told apart by `query_row`). Equal vectors tie and go by vec_id, then by row. Components beyond 2^53 count
as 2^53; scores are added with as many slices as they need, and shown as the nearest long. An empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, schema_of, tasks

SCALE = 256
LIMIT = float(2**53)
#: Rows and components of a block of the index, at most; queries of a block.
BLOCK_ROWS, BLOCK_CELLS, BLOCK_QUERIES = 8192, 1 << 22, 2048
#: What stands for a vec_id that is null, behind all others.
NO_ID = 2**63 - 1
BLOCK = "members binary, planes binary, low binary, bits binary, rows int, dims int"


def quantised(embedding: Column) -> Column:
    """floor(256 * x) of each component as array<long>; null where the vector takes no part."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    level = lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-LIMIT)), F.lit(LIMIT)))
    return F.when(embedding.isNotNull() & F.coalesce(whole, F.lit(False)), F.transform(embedding, level))


# --- a block ---------------------------------------------------------------------------------------


def slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, low, bits) of a (rows, components) matrix: bits[d] bitmaps of component d less low[d], in 64-bit words."""
    rows, dims = values.shape
    low = values.min(axis=0) if rows else np.zeros(dims, dtype=np.int64)
    above = (values - low).astype(np.uint64)
    bits = np.array([int(x).bit_length() for x in above.max(axis=0)] if rows else [0] * dims, dtype=np.uint8)
    words = -(-rows // 64)
    planes = np.zeros((int(bits.sum()), words * 8), dtype=np.uint8)
    at = 0
    for d in range(dims):
        for i in range(int(bits[d])):
            packed = np.packbits((above[:, d] >> np.uint64(i)).astype(np.uint8) & 1, bitorder="little")
            planes[at, : len(packed)] = packed
            at += 1
    return planes.view("<u8"), low, bits


class Block:
    """The slices of a block and their complements, ready for queries."""

    def __init__(self, planes: np.ndarray, low: np.ndarray, bits: np.ndarray, rows: int):
        self.rows, self.low, self.bits = rows, low, bits
        self.both = np.concatenate([planes, ~planes])
        self.dim = np.repeat(np.arange(len(bits)), bits)
        self.place = np.arange(len(self.dim)) - np.repeat(np.cumsum(bits, dtype=np.int64) - bits, bits)
        self.valid = np.zeros(planes.shape[1] * 64, dtype=np.uint8)
        self.valid[:rows] = 1
        self.valid = np.packbits(self.valid, bitorder="little").view("<u8")

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the scores, least significant first, and the number that has to be added to each score."""
        most = len(self.bits)
        q = np.zeros(most, dtype=np.int64)
        q[: min(most, len(query))] = query[:most]
        size = np.abs(q)
        digits = (size[:, None] >> np.arange(int(size.max(initial=0)).bit_length())) & 1
        plane, shift = np.nonzero(digits[self.dim])
        weight = self.place[plane] + shift
        which = plane + len(self.dim) * (q[self.dim[plane]] < 0)
        order = np.argsort(weight, kind="stable")
        top = int(weight.max(initial=-1)) + 1
        ends = np.searchsorted(weight[order], np.arange(top + 1))
        out: list[np.ndarray] = []
        carry: list[np.ndarray] = []
        w = 0
        while w < top or carry:
            own = self.both[which[order[ends[w] : ends[w + 1]]]] if w < top else self.both[:0]
            x, carry = added(np.concatenate([own, *carry]))
            out.append(x)
            w += 1
        fixed = sum(int(a) * int(b) for a, b in zip(q, self.low, strict=True))
        fixed -= sum(int(-a) * ((1 << int(b)) - 1) for a, b in zip(q, self.bits, strict=True) if a < 0)
        return out, fixed

    def top(self, query: np.ndarray, k: int, without: int = -1) -> list[tuple[int, int]]:
        """(row, score) of the k best rows, those of equal score in row order; `without`: a row that is left out."""
        parts, fixed = self.scores(query)
        live = self.valid.copy()
        if without >= 0:
            live[without >> 6] &= ~np.uint64(1 << (without & 63))
        sure = np.zeros_like(live)
        need = k
        for s in reversed(parts):
            high = live & s
            n = int(np.bitwise_count(high).sum())
            if n > need:
                live = high
            else:
                sure |= high
                live &= ~s
                need -= n
                if not need:
                    break
        rows = members(sure)
        if need:
            rows = np.concatenate([rows, members(live)[:need]])
        value = [fixed + sum(1 << w for w, s in enumerate(parts) if int(s[r >> 6]) >> (r & 63) & 1) for r in rows.tolist()]
        return sorted(zip(rows.tolist(), value, strict=True), key=lambda x: (-x[1], x[0]))


def added(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sum modulo 2 of bitmaps of one weight, and the carries, bitmaps of the next weight."""
    carry = []
    while len(x) > 2:
        k = len(x) // 3
        a, b, c = x[:k], x[k : 2 * k], x[2 * k : 3 * k]
        u = a ^ b
        carry.append((a & b) | (u & c))
        x = np.concatenate([u ^ c, x[3 * k :]])
    if len(x) == 2:
        carry.append((x[0] & x[1])[None])
        return x[0] ^ x[1], carry
    return (x[0] if len(x) else np.zeros(x.shape[1], dtype=x.dtype)), carry


def members(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


# --- blocks as rows --------------------------------------------------------------------------------


def _matrix(values: pa.Array, dims: int) -> np.ndarray:
    size = np.asarray(values.value_lengths())
    flat = np.asarray(values.flatten())
    if len(size) and (size == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(size), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _packed(rows: DataFrame, key: str, dims: int, sliced: bool, prefix: str = "") -> DataFrame:
    """(row, id, q) as one row of `BLOCK` for each `key`; members: row numbers and ids, sorted by id, then row."""

    def run(group: tuple, t: pa.Table) -> pa.Table:
        row, ids = (t[c].combine_chunks().to_numpy().astype("<i8") for c in ("row", "id"))
        order = np.lexsort((row, ids))
        values = _matrix(t["q"].combine_chunks(), dims)[order]
        planes, low, bits = slices(values) if sliced else (values.astype("<i8"), np.zeros(0, "<i8"), np.zeros(0, np.uint8))
        own = [np.stack([row[order], ids[order]]).tobytes(), planes.tobytes(), low.astype("<i8").tobytes(), bits.tobytes()]
        cells = [group[0], *[pa.array([x], pa.binary()) for x in own], pa.array([len(row)], pa.int32()), pa.array([dims], pa.int32())]
        return pa.Table.from_arrays([pa.array([c.as_py()], pa.int64()) if isinstance(c, pa.Scalar) else c for c in cells], names=names)

    names = [key, *[prefix + x.split()[0] for x in BLOCK.split(", ")]]
    kinds = [f"{key} long", *[prefix + x for x in BLOCK.split(", ")]]
    return rows.select(key, "row", "id", "q").groupBy(key).applyInArrow(run, schema_of(", ".join(kinds)))


def _met(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own, asked = (np.frombuffer(r[p + "members"], "<i8").reshape(2, -1) for p in ("", "q_"))
                block = Block(np.frombuffer(r["planes"], "<u8").reshape(-1, -(-r["rows"] // 64)), np.frombuffer(r["low"], "<i8"), np.frombuffer(r["bits"], np.uint8), r["rows"])
                vectors = np.frombuffer(r["q_planes"], "<i8").reshape(-1, r["q_dims"])
                place = {x: i for i, x in enumerate(own[0].tolist())}
                out: list[list[int]] = [[], [], [], [], []]
                for i, (row, vec) in enumerate(asked.T.tolist()):
                    for at, score in block.top(vectors[i], k, place.get(row, -1)):
                        for column, x in zip(out, (row, vec, int(own[0][at]), int(own[1][at]), min(max(score, -(2**63)), 2**63 - 1)), strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["query_row", "query_id", "row", "id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """(query_id, rank, vec_id, score, query_row): the k best rows for each row whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "bitslice")
    q = vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding")).alias("q")).where("q IS NOT NULL")
    rows = scratch.keep(q, "quantised")
    n, asked, dims = rows.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0), F.max(F.size("q"))).first()
    dims = max(1, dims or 1)
    most = max(64, min(BLOCK_ROWS, BLOCK_CELLS // dims // 64 * 64))
    blocks = max(1, -(-n // most))
    # as many pairs of blocks as keep all tasks busy, and queries in blocks as large as that leaves
    each = max(64, min(BLOCK_QUERIES, BLOCK_CELLS // dims, -(-asked * blocks // (8 * tasks(spark)))))
    named = rows.select("row", F.coalesce("vec_id", F.lit(NO_ID)).alias("id"), "q")
    dealt = lambda df, key, parts: df.withColumn(key, F.pmod(F.xxhash64("row"), F.lit(parts)).cast("long"))
    asks = max(1, -(-asked // each))
    index = _packed(dealt(named, "block", blocks), "block", dims, True)
    queries = _packed(dealt(named.where((F.col("id") % every == 0) & (F.col("id") != NO_ID)), "ask", asks), "ask", dims, False, "q_")
    # every block of rows meets every block of queries, as an equal join on both numbers; a merge, since
    # Spark counts a side by its rows before they are exploded and would broadcast all the copies
    left = index.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(asks - 1)).cast("array<long>")))
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    met = left.hint("merge").join(right.hint("merge"), ["block", "ask"]).mapInArrow(_met(k), schema_of("query_row long, query_id long, row long, id long, score long"))
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    best = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", F.when(F.col("id") != NO_ID, F.col("id")).alias("vec_id"), "score", "query_row")
