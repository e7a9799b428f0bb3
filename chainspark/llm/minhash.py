"""Near-duplicate documents by min-max hashing.

Each permutation gives two signature values, the minimum and the maximum of the permuted shingle
hashes, so K evaluations fill 2 K values. Bands of `rows` values make candidate buckets. Links are
confirmed on the full shingle sets: 100 * intersection >= 75 * union. Documents with equal sets
form one class and travel as its number; a component is named by its smallest document.

1. Sets with equal digests collapse to a representative.
2. Every bucket with two representatives or more links its members to its smallest one (a star,
   never all pairs); the pairs are confirmed on the sets; components follow.
3. Members of buckets that still hold different components are compared by an exact prefix filter. Their
   shingles are ordered: first those that one component alone holds, then by the number of members that hold
   them. Two members of different components whose sets are similar enough share a shingle of the first
   size - ceil(percent * size / 100) + 1 of either, and it is one that several components hold. Members that
   share such a shingle form clusters (components of stars). In a cluster, members outside its largest
   component are compared with all its members, block against block; a block pair returns only a spanning
   forest of the links it confirms. So no link that shares a bucket is lost. A block holds about 512
   members and 2^20 shingles at most (or one text), whatever the cluster's size. Texts with much in common
   but no near copy have rare shingles among their first, and form no cluster.
4. Components of all confirmed links.

A pair of similarity 0.75 misses all bands with probability (1 - 0.75^4)^32 < 1e-5 if it is long.
With i of u shingles in common a minimum and maximum agree with i (i - 1) / (u (u - 1)), which is
less for short texts: 1e-4 at 3 of 4 shingles, 2e-5 at 6 of 8, under 1e-5 from 15 of 20.

Edge cases: null or blank text: empty set, its own component; fewer than `n` words: the whole
sequence is the one shingle; null doc_id rows are left out (they have no name to report); one
doc_id in several rows: each row is placed by its text, and the id appears once a row (components
that share their smallest doc_id share its name, but are not linked); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, WordTable, connected_components, mix64, schema_of, text_blocks, tuned

_RNG = np.random.Generator(np.random.PCG64(77001))
_STEP = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Members and shingles in a block of step 3: a wider block means fewer copies of a set, and more memory in a task.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20


def shingle_sets(words: WordTable, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingle hashes of text i are hashes[first[i]:first[i + 1]], ascending."""
    count = np.diff(words.first)
    h = words.hash
    long_ = np.maximum(count - n + 1, 0)
    grams = np.where(count == 0, 0, np.where(count < n, 1, long_))
    owner = np.repeat(np.arange(len(count)), grams)
    begin = np.concatenate([[0], np.cumsum(grams)])[:-1]
    at = words.first[:-1][owner] + (np.arange(len(owner)) - begin[owner])
    value = np.zeros(len(owner), dtype=np.uint64)
    full = count[owner] >= n
    if full.all():
        for k in range(n):
            value += h[at + k] * _STEP[k]
    else:
        for k in range(n):
            value[full] += h[at[full] + k] * _STEP[k]
        for i in np.flatnonzero((count > 0) & (count < n)):  # a short text: all its words, with their number
            few = h[words.first[i] : words.first[i + 1]]
            value[begin[i]] = (few * _STEP[: len(few)]).sum() ^ (_STEP[62] >> np.uint64(count[i]))
    value = mix64(value)
    order = np.lexsort((value, owner)) if len(count) > 1 else np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(count) + 1))


def min_max(hashes: np.ndarray, first: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """Signatures (texts x 2 K) of the non-empty sets: K minima, then K maxima."""
    out = np.empty((len(first) - 1, 2 * len(mult)), dtype=np.uint32)
    starts = first[:-1]
    for k in range(len(mult)):
        p = ((hashes * mult[k] + add[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, 2 * k] = np.minimum.reduceat(p, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(p, starts)
    return out


def signature_rows(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    """doc_id, n_shingles, digest of the set, and a hash of each band."""
    gen = np.random.Generator(np.random.PCG64(4242))
    k = bands * rows // 2
    mult = gen.integers(1, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = gen.integers(1, 2**63, k, dtype=np.uint64)
    mix = gen.integers(1, 2**63, (rows, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        for i, m, data, offsets in text_blocks(batch.column("text"), 2 << 20):
            sets, first = shingle_sets(WordTable(data, offsets), n)
            size = np.diff(first)
            some = np.flatnonzero(size)
            digest = _digests(sets, first, some)
            bandh = np.zeros((m, bands), dtype=np.uint64)
            if len(some):
                starts = first[:-1][some]
                edges = np.append(starts, first[-1])
                sig = min_max(sets, edges, mult, add).astype(np.uint64).reshape(len(some), bands, rows)
                # rows of a band: minima and maxima of rows / 2 permutations
                bandh[some] = mix64((sig * mix[:, 0]).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
            flat = pa.array(bandh.view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(m + 1, dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, m), pa.array(size.astype(np.int64)), pa.array(digest[:, 0].view(np.int64)), pa.array(digest[:, 1].view(np.int64)), lists],
                names=["doc_id", "n_shingles", "d0", "d1", "bands"],
            )


def _digests(sets: np.ndarray, first: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Two sums over each set; zero but for the texts `some`, whose sets are not empty."""
    out = np.zeros((len(first) - 1, 2), dtype=np.uint64)
    if len(some):
        starts = first[:-1][some]
        out[some, 0] = np.add.reduceat(sets, starts)
        out[some, 1] = np.add.reduceat(mix64(sets ^ _STEP[61]), starts)
    return out


def set_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, m, data, offsets in text_blocks(batch.column("text"), 2 << 20):
            sets, first = shingle_sets(WordTable(data, offsets), n)
            size = np.diff(first)
            digest = _digests(sets, first, np.flatnonzero(size)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int64)), pa.array(digest[:, 0]), pa.array(digest[:, 1]), lists], names=["n_shingles", "d0", "d1", "shingles"])


def _forest(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """Which of the pairs (a, b) of node numbers are needed to connect what all of them connect."""
    parent = list(range(nodes))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = np.zeros(len(a), dtype=bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        p, q = top(x), top(y)
        if p != q:
            parent[p] = q
            keep[i] = True
    return keep


def block_links(percent: int):
    """For one (cluster, block i, block j): a spanning forest of the confirmed links between the blocks."""

    def run(table: pa.Table) -> pa.Table:
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        side = table.column("side").to_numpy()
        if side.min() == side.max():
            return none
        ids = table.column("rep").to_numpy()
        comp = table.column("comp").to_numpy()
        lists = table.column("shingles").combine_chunks()
        size = np.diff(lists.offsets.to_numpy())
        value = lists.flatten().to_numpy()
        owner = np.repeat(np.arange(len(ids)), size)
        _, code, times = np.unique(value, return_inverse=True, return_counts=True)
        shared = times[code] > 1  # a shingle of one member is in no intersection
        code, owner = code[shared], owner[shared]
        names, code = np.unique(code, return_inverse=True)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        place = np.empty(len(ids), dtype=np.int64)
        place[left], place[right] = np.arange(len(left)), np.arange(len(right))
        inter = np.zeros((len(left), len(right)), dtype=np.float32)
        width = 4096
        for at in range(0, len(names), width):  # counts stay below 2^24, so float32 sums are exact
            pick = (code >= at) & (code < at + width)
            x = np.zeros((len(left), width), dtype=np.float32)
            y = np.zeros((len(right), width), dtype=np.float32)
            l_ = pick & (side[owner] == 0)
            r_ = pick & (side[owner] == 1)
            x[place[owner[l_]], code[l_] - at] = 1
            y[place[owner[r_]], code[r_] - at] = 1
            inter += x @ y.T
        union = size[left][:, None] + size[right][None, :] - inter
        good = (100 * inter >= percent * union) & (comp[left][:, None] != comp[right][None, :])
        a, b = np.nonzero(good)
        a, b = left[a], right[b]
        # members of one component count as connected already
        _, label = np.unique(comp, return_inverse=True)
        keep = _forest(label[a], label[b], int(label.max()) + 1)
        return pa.table({"a": pa.array(ids[a[keep]], pa.int64()), "b": pa.array(ids[b[keep]], pa.int64())})

    return run


def near_duplicates(documents: DataFrame, n: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row with a doc_id."""
    spark = tuned(documents.sparkSession)
    scratch = Scratch(spark, "minhash")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    signed = scratch.keep(
        docs.mapInArrow(lambda it: signature_rows(it, n, bands, rows), schema_of("doc_id long, n_shingles long, d0 long, d1 long, bands array<long>")),
        "signatures",
    )
    # 1. a class for each distinct set, numbered once as it is written: one doc_id may have several sets
    digest = ["n_shingles", "d0", "d1"]
    same = signed.where("n_shingles > 0").groupBy(*digest).agg(F.min("doc_id").alias("least"), F.min_by("bands", "doc_id").alias("bands"))
    reps = scratch.keep(same.withColumn("rep", F.monotonically_increasing_id()), "classes")
    # 2. stars of the buckets
    banded = reps.select("rep", "n_shingles", F.posexplode("bands").alias("band", "h"))
    tally = banded.groupBy("band", "h").agg(F.min("rep").alias("hub"), F.count("*").alias("m")).where("m > 1").drop("m")
    # only members of buckets with company go on
    member = scratch.keep(banded.join(tally, ["band", "h"]).select("rep", "n_shingles", "hub", F.hash("band", "h").alias("bucket_hash"), "band", "h"), "members")
    names = scratch.keep(reps.select("rep", "least", *digest).join(member.select("rep").distinct(), "rep", "left_semi"), "names")
    some = docs.join(names.select(F.col("least").alias("doc_id")), "doc_id", "left_semi").mapInArrow(lambda it: set_rows(it, n), schema_of("n_shingles long, d0 long, d1 long, shingles array<long>"))
    sets = scratch.keep(some.dropDuplicates(digest).join(names, digest).select("rep", "shingles"), "sets")
    stars = scratch.keep(member.where("rep <> hub").select("hub", "rep").distinct(), "stars")
    links = scratch.keep(_confirmed(stars, sets, percent), "links")
    roots = connected_components(links.select(F.col("hub").alias("a"), F.col("rep").alias("b")), scratch)
    part = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("root", "rep")).drop("root")
    # 3. buckets that still hold several components
    apart = part.groupBy("band", "h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("band", "h")
    open_ = scratch.keep(part.join(apart, ["band", "h"], "left_semi").select("rep", "comp").distinct(), "open")
    more = _between_components(open_, sets, scratch, percent)
    edges = links.select(F.col("hub").alias("a"), F.col("rep").alias("b")).union(more)
    # 4. components of all links; members of a class share its component
    final = connected_components(edges, scratch)
    scratch.drop(member, names, sets, stars, links, open_)  # what is left to do reads signatures, classes and components
    classes = reps.select(*digest, "rep", "least").join(final.withColumnRenamed("node", "rep"), "rep", "left")
    smallest = classes.where("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    classes = classes.join(smallest, "root", "left").select(*digest, F.coalesce("component", "least").alias("component"))
    out = signed.select("doc_id", *digest).join(classes, digest, "left")
    comp = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), (F.col("doc_id") == comp).alias("kept"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, rep) whose full sets are similar enough. A hub of many pairs is split by AQE."""
    mine = pairs.join(sets, "rep").withColumnRenamed("shingles", "mine")
    both = mine.join(sets.select(F.col("rep").alias("hub"), F.col("shingles").alias("theirs")), "hub")
    inter = F.size(F.array_intersect("mine", "theirs"))
    return (
        both.where(F.least(F.size("mine"), F.size("theirs")) * 100 >= F.greatest(F.size("mine"), F.size("theirs")) * percent)
        .withColumn("inter", inter)
        .where(F.col("inter") * 100 >= (F.size("mine") + F.size("theirs") - F.col("inter")) * percent)
        .select("hub", "rep")
    )


def _first_shared(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(rep, comp, size, shingle): of each member's first shingles those that members of other components hold too.

    A member of which fewer than `percent` of its shingles are held by other components has none.
    """
    held = open_.join(sets, "rep").select("rep", "comp", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
    met = held.groupBy("shingle").agg(F.count("*").alias("times"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("shingle", "times")
    # a frequent shingle is a skewed join, which Spark can split
    rest = held.join(met, "shingle").groupBy("rep", "comp", "size").agg(F.sort_array(F.collect_list(F.struct("times", "shingle"))).alias("rest"))
    # shingles of one component come first in the order, so this many are left of the prefix
    left = F.size("rest") - F.ceil(F.col("size") * percent / 100).cast("int") + 1
    return rest.withColumn("left", left).where("left > 0").select("rep", "comp", "size", F.explode(F.slice("rest", 1, F.col("left"))).alias("f")).select("rep", "comp", "size", "f.shingle")


def _between_components(open_: DataFrame, sets: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Confirmed links (a, b) between different components of the members `open_` (rep, comp)."""
    first = scratch.keep(_first_shared(open_, sets, percent), "prefixes")
    hubs = first.groupBy("shingle").agg(F.min("rep").alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("shingle", "hub")
    stars = first.join(hubs, "shingle").where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    cluster = connected_components(stars, scratch).select(F.col("node").alias("rep"), F.col("root").alias("cluster"))
    members = scratch.keep(first.select("rep", "comp", "size").distinct().join(cluster, "rep"), "clusters")
    sizes = members.groupBy("cluster", "comp").agg(F.count("*").alias("m"), F.sum("size").alias("mass"))
    largest = sizes.groupBy("cluster").agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.sum("m").alias("all"), F.sum("mass").alias("all_mass"))
    # blocks by a hash of the member: even, and no task numbers a whole cluster
    dealt = members.join(largest, "cluster").withColumn("minor", F.col("comp") != F.col("main"))
    minors = dealt.groupBy("cluster").agg(F.sum(F.col("minor").cast("long")).alias("minors"), F.sum(F.when(F.col("minor"), F.col("size")).otherwise(0)).alias("minors_mass"))
    dealt = dealt.join(minors, "cluster")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / BLOCK), F.ceil(F.col(f"{n}_mass") / BLOCK_SHINGLES)).cast("int")
    slot = lambda n: F.pmod(F.xxhash64("rep"), blocks(n)).cast("int")
    left = dealt.where("minor").select("cluster", "rep", "comp", slot("minors").alias("i"), F.explode(F.sequence(F.lit(0), blocks("all") - 1)).alias("j"), F.lit(0).alias("side"))
    right = dealt.select("cluster", "rep", "comp", F.explode(F.sequence(F.lit(0), blocks("minors") - 1)).alias("i"), slot("all").alias("j"), F.lit(1).alias("side"))
    placed = left.union(right).join(sets, "rep")
    return placed.groupBy("cluster", "i", "j").applyInArrow(block_links(percent), schema_of("a long, b long"))
