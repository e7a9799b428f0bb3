"""What several operators of this subpackage share.

* `Scratch` (of the library) keeps intermediate tables in the shared checkpoint folder;
* `ordered_prefix` computes exact running sums over a global order without a single-task window;
* `connected_components` labels the nodes of an edge table by their smallest member;
* `WordTable` splits a batch of texts into words and hashes them without a Python loop per word.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..scratch import Scratch

#: Rows of an Arrow batch. A batch of texts has to fit in a Python worker beside its results.
BATCH_ROWS = 1000


def tuned(spark: SparkSession) -> SparkSession:
    """The session with Arrow batches small enough for very long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def tasks(spark: SparkSession, at_least: int = 1) -> int:
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- running sums over a global order ------------------------------------------------------------


def key_cuts(df: DataFrame, key: str, parts: int) -> list[int]:
    """At most `parts` - 1 distinct ascending values that cut the non-null keys into even ranges."""
    at = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(key, F.array(*map(F.lit, at)), F.lit(10 * parts)).alias("q")).first()["q"] if at else None
    return sorted(set(got or []))


def range_of(key: str | Column, cuts: list[int]) -> Column:
    """The number of cuts below the key: ranges ascend with the key, nulls go to range 0."""
    c = F.col(key) if isinstance(key, str) else key
    if not cuts:
        return F.lit(0)
    a = F.array(*[F.lit(int(x)).cast("long") for x in cuts])
    # position of the first cut >= key by bisection on the sorted array: a few comparisons a row
    return F.coalesce(F.size(F.filter(a, lambda x: x < c)), F.lit(0)) if len(cuts) < 16 else _bisect(c, cuts)


def _bisect(c: Column, cuts: list[int]) -> Column:
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    heads = cuts[::step]
    coarse = F.size(F.filter(F.array(*[F.lit(int(x)).cast("long") for x in heads]), lambda x: x < c))
    blocks = F.array(*[F.array(*[F.lit(int(x)).cast("long") for x in cuts[i : i + step]]) for i in range(0, len(cuts), step)])
    block = F.element_at(blocks, F.greatest(coarse, F.lit(1)))
    inside = F.size(F.filter(block, lambda x: x < c))
    return F.when(c.isNull() | (coarse == 0), F.lit(0)).otherwise((coarse - 1) * step + inside)


def key_parts(key: str, cuts: list[int], tie: Column) -> Column:
    """Ascending part numbers by ranges of an integer key; a key that is a cut, as very frequent ones are, is dealt by `tie` (0 to 2^20 - 1) too, and so are nulls, which come first."""
    at_cut = F.coalesce(F.col(key).isin(cuts), F.lit(False)) if cuts else F.lit(False)
    inside = F.when(at_cut, F.lit(1 << 20) + tie).otherwise(F.lit(0))
    known = ((range_of(key, cuts) + 1).cast("long") * F.lit(1 << 21) + inside).cast("long")
    return F.when(F.col(key).isNull(), tie.cast("long")).otherwise(known)


def group_starts(totals: DataFrame, key: str, sums: list[str], fan: int = 4096, groups: int | None = None) -> DataFrame:
    """Exclusive running sums of `sums` over ascending integer `key`, one row a key.

    With more keys than `fan`, keys are first summed by key div fan, so that no window sees more
    than `fan` rows however many keys there are.
    """
    n = groups if groups is not None else (totals.agg(F.max(key)).first()[0] or 0) + 1
    if n <= fan:
        w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(key, *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"{s}_before") for s in sums])
    up = totals.withColumn("_up", F.floor(F.col(key) / fan).cast("long"))
    above = group_starts(up.groupBy("_up").agg(*[F.sum(s).alias(s) for s in sums]), "_up", sums, fan, n // fan + 1)
    w = Window.partitionBy("_up").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inner = up.select(key, "_up", *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_{s}") for s in sums])
    return inner.join(above, "_up").select(key, *[(F.col(f"_{s}") + F.col(f"{s}_before")).alias(f"{s}_before") for s in sums])


def ordered_prefix(df: DataFrame, group: str, order: list[str | Column], sums: list[str], groups: int | None = None) -> DataFrame:
    """`df` with `<s>_before` for each of `sums`: the exact sum of all earlier rows.

    Rows are ordered by the integer column `group`, inside it by `order`. Totals by group are
    aggregated on the map side, their running sums join back, and each group is summed on its own.
    """
    totals = df.groupBy(group).agg(*[F.sum(s).alias(s) for s in sums])
    starts = group_starts(totals, group, sums, groups=groups)
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.select("*", *[F.coalesce(F.sum(s).over(w), F.lit(0)).alias(f"_in_{s}") for s in sums])
    joined = inner.join(starts, group)
    return joined.select(*[c for c in df.columns], *[(F.col(f"_in_{s}") + F.col(f"{s}_before")).alias(f"{s}_before") for s in sums])


# --- components ----------------------------------------------------------------------------------


#: Edges that a task of the component rounds takes.
EDGES_A_TASK = 50_000


def connected_components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected `edges` (a, b): root is the smallest node reachable.

    Large-star and small-star rounds: every round each node hands its neighbours to its smallest
    neighbour; the number of edges never grows, and a round is kept as a table. Ends when each node
    points at a root. Minima are aggregated on the map side and join back from partitions of their
    own, so that a node with very many neighbours is a skewed join that Spark can split.
    """
    cur, n = scratch.counted(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        if not n:
            break
        k = max(4, n // EDGES_A_TASK)
        both = cur.union(cur.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(k)
        # large star: larger neighbours, and the node itself, point at the smallest neighbour
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(k).union(low.where("m < u").select("u", F.col("m").alias("v")))
        # small star: smaller neighbours, and the node itself, point at the smallest of them
        mins = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(k)
        small = large.join(mins, "u").select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.col("m").alias("y")), F.struct(F.col("v").alias("x"), F.col("m").alias("y")))).alias("e")).select(F.col("e.x").alias("u"), F.col("e.y").alias("v")).where("u <> v").distinct()
        new, n = scratch.counted(small.coalesce(k), "edges")
        # done when every node points once, and nothing that is pointed at points on
        ends = new.select(F.col("u").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(new.select("v", F.lit(0), F.lit(1)))
        tally = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        open_ = tally.agg(F.max(((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).cast("int"))).first()[0]
        scratch.drop(cur)
        cur = new
        if not open_:
            break
    else:
        raise RuntimeError("components did not settle")
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


# --- words of a batch ----------------------------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_APART = _SPACE.copy()
_APART[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a lane, and of the longest word that is hashed lane by lane.
LANE, LONG = 8, 64
_KEEP = np.array([(1 << 8 * r) - 1 for r in range(LANE)] + [2**64 - 1], dtype=np.uint64)
_BY_SIZE, _BY_LANE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class WordTable:
    """The words `[^\\x20\\x09-\\x0D]+` of some texts, A-Z lowered, each with a 64-bit hash.

    first[i]:first[i + 1] are the words of text i; start, end are byte positions in `data`. A word is
    hashed eight bytes at a time, each lane mixed into what came before; of words of eight bytes or
    less, two of one size never share a hash, since every step is one to one. Words over `LONG` bytes
    take xxh3. The sets and terms that are built on it hold hashes, two words at a time being mistaken
    for one with 2^-64; where results must be exact, `same` compares the bytes.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, marks: bool = True):
        """Without `marks`, ASCII punctuation separates words as white space does."""
        n = len(data)
        word = ~(_SPACE if marks else _APART)[data]
        cut = np.zeros(n + 1, dtype=bool)  # a word may also begin or end where a text does
        cut[offsets] = True
        prev = np.empty(n, dtype=bool)
        prev[:1] = False
        prev[1:] = word[:-1]
        begins = word & (~prev | cut[:n])
        nxt = np.empty(n, dtype=bool)
        nxt[-1:] = False
        nxt[:-1] = word[1:]
        ends = word & (~nxt | cut[1 : n + 1])
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.size = self.end - self.start
        self.low = np.zeros(n + LANE, dtype=np.uint8)
        self.low[:n] = _LOWER[data]
        self._lanes = np.ndarray(n + 1, dtype="<u8", buffer=self.low, strides=(1,))
        self.hash = self._hashes()
        self.first = np.searchsorted(self.start, offsets)

    def lane(self, which: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k to 8 k + 7 of the words `which`, all of which have some there; zero past their ends."""
        return self._lanes[self.start[which] + LANE * k] & _KEEP[np.minimum(self.size[which] - LANE * k, LANE)]

    def _hashes(self) -> np.ndarray:
        size = self.size
        h = mix64((self._lanes[self.start] & _KEEP[np.minimum(size, LANE)]) + size.astype(np.uint64) * _BY_SIZE)
        k, more = 1, np.flatnonzero((size > LANE) & (size <= LONG))
        while len(more):
            h[more] = mix64(h[more] ^ (self.lane(more, k) * _BY_LANE))
            k += 1
            more = more[size[more] > LANE * k]
        for i in np.flatnonzero(size > LONG).tolist():
            h[i] = xxhash.xxh3_64_intdigest(self.low[self.start[i] : self.end[i]])
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a[i] and b[i] are equal, byte by byte."""
        out = self.size[a] == self.size[b]
        k, on = 0, np.flatnonzero(out)
        while len(on):
            out[on] = self.lane(a[on], k) == self.lane(b[on], k)
            k += 1
            on = on[out[on] & (self.size[a[on]] > LANE * k)]
        return out

    def word(self, i: int) -> bytes:
        return self.low[self.start[i] : self.end[i]].tobytes()


def text_blocks(texts: pa.Array, most: int = 4 << 20) -> Iterable[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of runs of rows with about `most` bytes; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, off, data = texts.fill_null("").buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset : texts.offset + n + 1] if texts.null_count == 0 else None
    if offsets is None:
        full = texts.fill_null("")
        _, off, data = full.buffers()
        offsets = np.frombuffer(off, dtype=np.int64)[full.offset : full.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j - i, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
