"""Seeds and ungapped extension between two sequence tables.

Words of both genomes meet in an equi-join on the word. A word that occurs very often on both sides
makes a product, which is what its hits are; `most` leaves words of many target places out, as aligners
do with repeats, and `None` keeps all. Extension walks each diagonal from a seed in both directions
while the running score stays within the drop of its maximum: stretch by stretch, for those runs only
that the drop has not ended yet.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequences import DEFAULT, Scoring, pair_score, pairs_total
from ..functions.text import flat, pieces
from ..scratch import Scratch, small_batches
from .tiles import fetched, lengths, tiles, with_bases

#: Bases of the longest word that fits in a long, and bases that a task turns to words at once.
LONGEST, BASES = 31, 1 << 20
_WORD_CODES = np.full(256, -1, dtype=np.int8)
_WORD_CODES[list(b"ACGT")] = range(4)


def kmers(genome: DataFrame, k: int, step: int = 1) -> DataFrame:
    """(chrom, pos, word): the words of k unmasked, known bases that begin at every `step`-th base.

    genome: (chrom, seq), or (chrom, chunk_start, seq) whose chunks overlap by k - 1 bases (`overlapping`).
    """
    # slices of bytes take constant time, of characters they walk the sequence from its start; the
    # outer lambda's variable holds the bytes, so the expression behind `seq` runs once a row
    raw = F.array(F.encode("seq", "US-ASCII"))
    base = F.col("chunk_start") if "chunk_start" in genome.columns else F.lit(0)
    words = F.flatten(F.transform(raw, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - k + 1, F.lit(step)), lambda i: F.substring(r, i, F.lit(k)))))
    at = genome.where(F.length("seq") >= k).select("chrom", base.cast("long").alias("base"), F.posexplode(words).alias("i", "w"))
    return at.select("chrom", (F.col("base") + F.col("i") * step).cast("long").alias("pos"), F.col("w").cast("string").alias("word")).where(~F.col("word").rlike("[^ACGT]"))


def _codes(raw: np.ndarray, ends: np.ndarray, k: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in the row, number) of the words of k known, unmasked bases; row i is raw[ends[i]:ends[i + 1]]."""
    code = _WORD_CODES[raw]
    n = len(code) - k + 1
    if n < 1:
        return (np.zeros(0, dtype=np.int64),) * 3
    unknown = np.append(0, np.cumsum(code < 0, dtype=np.int32))
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[:n]
    at = np.arange(n)
    ok = (unknown[k:] == unknown[:-k]) & (at + k <= ends[row + 1])
    if step > 1:
        ok &= (at - ends[row]) % step == 0
    # numbers of words of 1, 2, 4, ... bases; those that make up k, put together from the left
    word, part, length, done = np.zeros(n, dtype=np.int64), code.astype(np.int64), 1, 0
    while True:
        if k & length:
            word, done = (word << 2 * length) | part[done : done + n], done + length
        if 2 * length > k:
            break
        part, length = (part[:-length] << 2 * length) | part[length:], 2 * length
    at = np.flatnonzero(ok)
    return row[at], at - ends[row[at]], word[at]


def coded_kmers(genome: DataFrame, k: int, step: int = 1) -> DataFrame:
    """As `kmers`, with words of up to `LONGEST` bases as numbers of two bits a base (`spelled` turns them back)."""
    if k > LONGEST:
        return kmers(genome, k, step)
    base = F.col("chunk_start") if "chunk_start" in genome.columns else F.lit(0)
    rows = genome.where(F.length("seq") >= k).select("chrom", base.cast("long").alias("base"), F.encode("seq", "US-ASCII").alias("raw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = flat(batch.column("raw"))
            chrom, first = batch.column("chrom"), batch.column("base").to_numpy(zero_copy_only=False)
            for i, j in pieces(ends, BASES):
                row, at, word = _codes(raw[ends[i] : ends[j]], ends[i : j + 1] - ends[i], k, step)
                yield pa.RecordBatch.from_arrays([chrom.take(pa.array(i + row)), pa.array(first[i + row] + at), pa.array(word)], names=["chrom", "pos", "word"])

    return small_batches(rows).mapInArrow(run, f"chrom {rows.schema['chrom'].dataType.simpleString()}, pos long, word long")


def spelled(word: Column, k: int) -> Column:
    """The bases of a coded word, five at a time."""
    parts = lambda n: F.split(F.lit(",".join(map("".join, itertools.product("ACGT", repeat=n)))), ",")
    of = lambda low, n: F.get(parts(n), F.shiftright(word, 2 * low).bitwiseAND(F.lit(4**n - 1)).cast("int"))
    first = k % 5
    return F.concat(*([of(k - first, first)] if first else []), *[of(i, 5) for i in range(k - first - 5, -1, -5)])


def word_index(genome: DataFrame, k: int) -> DataFrame:
    """(word, n): how often each word occurs. Words are counted as numbers and spelled afterwards."""
    n = word_counts(coded_kmers(genome, k))
    return n.select(spelled(F.col("word"), k).alias("word"), "n") if k <= LONGEST else n


def overlapping(genome: DataFrame, k: int, width: int = 1 << 16) -> DataFrame:
    """(chrom, chunk_start, seq): stretches of `width` bases and the k - 1 that follow, so that each word lies in one."""
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(width).cast("long"))).alias("start")
    at = lengths(genome).select("chrom", "size", step).select("chrom", "start", F.least("size", F.col("start") + width + k - 1).alias("end"))
    return fetched(at, genome).select("chrom", F.col("start").alias("chunk_start"), "seq")


def word_counts(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count("*").alias("n"))


def seed_hits(target: DataFrame, query: DataFrame, most: int | None = None) -> DataFrame:
    """(t_chrom, t_pos, q_chrom, q_pos): equal words; words with over `most` target places are left out."""
    t = target
    if most is not None:
        t = t.join(word_counts(target).where(F.col("n") <= most).select("word"), "word", "left_semi")
    return t.select("word", F.col("chrom").alias("t_chrom"), F.col("pos").alias("t_pos")).join(query.select("word", F.col("chrom").alias("q_chrom"), F.col("pos").alias("q_pos")), "word").drop("word")


def diagonals(hits: DataFrame, width: int) -> DataFrame:
    """(t_chrom, q_chrom, band, hits, first_t, last_t): hits by band of diagonals."""
    band = F.floor((F.col("t_pos") - F.col("q_pos")) / F.lit(float(width))).cast("long")
    return hits.groupBy("t_chrom", "q_chrom", band.alias("band")).agg(F.count("*").alias("hits"), F.min("t_pos").alias("first_t"), F.max("t_pos").alias("last_t"))


def seed_runs(hits: DataFrame, k: int) -> DataFrame:
    """(t_chrom, q_chrom, t, q, length): overlapping hits of one diagonal as one exact match."""
    diag = F.col("t_pos") - F.col("q_pos")
    w = Window.partitionBy("t_chrom", "q_chrom", "diag").orderBy("t_pos")
    rows = hits.withColumn("diag", diag).withColumn("new", (F.coalesce(F.col("t_pos") - F.lag("t_pos").over(w) > k, F.lit(True))).cast("long"))
    rows = rows.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return rows.groupBy("t_chrom", "q_chrom", "diag", "run").agg(F.min("t_pos").alias("t"), (F.max("t_pos") + k - F.min("t_pos")).alias("length")).select("t_chrom", "q_chrom", "t", (F.col("t") - F.col("diag")).alias("q"), "length")


def _walked(rows: DataFrame, target: DataFrame, query: DataFrame, ahead: bool, drop: int, reach: int, scoring: Scoring) -> DataFrame:
    """`rows` (t_chrom, q_chrom, t, q, length, t_size, q_size, core, and _sum, _best, _at, _k of one side) walked on by `reach` bases; `_over` where that side is done."""
    t_end, q_end = F.col("t") + F.col("length"), F.col("q") + F.col("length")
    room = F.least(F.col("t_size") - t_end, F.col("q_size") - q_end) if ahead else F.least("t", "q")
    n = F.least(F.lit(reach), room - F.col("_k"))
    lo = (lambda c, end: end + F.col("_k")) if ahead else (lambda c, end: F.col(c) - F.col("_k") - n)
    at = rows.withColumn("_n", n).withColumn("_t0", lo("t", t_end)).withColumn("_q0", lo("q", q_end)).withColumn("_t1", F.col("_t0") + n).withColumn("_q1", F.col("_q0") + n)
    at = with_bases(with_bases(at, target, "t_chrom", "_t0", "_t1", "_a"), query, "q_chrom", "_q0", "_q1", "_b")
    turn = (lambda c: c) if ahead else F.reverse
    score = F.zip_with(F.split(turn(F.col("_a")), ""), F.split(turn(F.col("_b")), ""), lambda x, y: pair_score(x, y, scoring))
    start = F.struct(F.col("_sum").alias("sum"), F.col("_best").alias("best"), F.col("_at").alias("at"), F.col("_k").alias("k"), F.lit(False).alias("over"))

    def step(a, s):
        total = a["sum"] + s
        up = ~a["over"] & (total > a["best"])
        return F.struct(
            total.alias("sum"), F.when(up, total).otherwise(a["best"]).alias("best"), F.when(up, a["k"] + 1).otherwise(a["at"]).alias("at"), (a["k"] + 1).cast("long").alias("k"), (a["over"] | (a["best"] - total > drop)).alias("over")
        )

    got = at.withColumn("_w", F.when(F.col("_n") > 0, F.aggregate(score, start, step)).otherwise(start))
    over = F.col("_w.over") | (F.col("_w.k") >= room)
    return got.select(*[c for c in rows.columns if not c.startswith("_")], F.col("_w.sum").alias("_sum"), F.col("_w.best").alias("_best"), F.col("_w.at").alias("_at"), F.col("_w.k").alias("_k"), over.alias("_over"))


def _side(rows: DataFrame, target: DataFrame, query: DataFrame, ahead: bool, drop: int, reach: int, scratch: Scratch, scoring: Scoring) -> DataFrame:
    """`rows` with (best, at) of one side: the best score beyond the run, and the bases that lead to it."""
    zero = F.lit(0).cast("long")
    on, done = rows.withColumns({"_sum": zero, "_best": zero, "_at": zero, "_k": zero}), None
    while True:
        on, n = scratch.counted(_walked(on, target, query, ahead, drop, reach, scoring), "walked")
        ended = on.where("_over")
        done = ended if done is None else done.union(ended)
        left = on.where("not _over").drop("_over")
        if not n or left.isEmpty():
            break
        on, reach = left, reach * 8
    return done.select(*rows.columns, F.col("_best").alias("best"), F.col("_at").alias("at"))


def extended(runs: DataFrame, target: DataFrame, query: DataFrame, drop: int, reach: int = 128, scoring: Scoring = DEFAULT) -> DataFrame:
    """(t_chrom, q_chrom, t, q, length, score): exact runs with what lies around them.

    On each side the score is summed base by base; the walk ends where it has fallen more than `drop`
    below its best, or where a sequence ends, and the best place (nearest on ties, 0 if none is above
    it) is taken. `reach` is the length of the first stretch that is looked at; results don't depend on it.
    """
    scratch = Scratch(runs.sparkSession, "extension")
    size = lambda g, s: lengths(g).select(F.col("chrom").alias(f"{s}_chrom"), F.col("size").alias(f"{s}_size"))
    names = {c: runs.schema[c].dataType for c in ("t_chrom", "q_chrom")}
    rows = runs.select(F.col("t_chrom").cast("string").alias("t_chrom"), F.col("q_chrom").cast("string").alias("q_chrom"), "t", "q", "length")
    target, query = scratch.keep(tiles(target), "target"), scratch.keep(tiles(query), "query")  # each stretch reads them again
    rows = rows.join(size(target, "t"), "t_chrom").join(size(query, "q"), "q_chrom")
    rows = with_bases(rows.withColumn("_t1", F.col("t") + F.col("length")), target, "t_chrom", "t", "_t1", "_core").withColumn("core", pairs_total(F.col("_core"), F.col("_core"), scoring)).drop("_t1", "_core")
    rows = scratch.keep(rows, "runs")
    key = ["t_chrom", "q_chrom", "t", "q", "length"]
    right, left = _side(rows, target, query, True, drop, reach, scratch, scoring), _side(rows, target, query, False, drop, reach, scratch, scoring)
    both = right.select(*key, "core", F.col("best").alias("r"), F.col("at").alias("r_at")).join(left.select(*key, F.col("best").alias("l"), F.col("at").alias("l_at")), key)
    return both.select(
        F.col("t_chrom").cast(names["t_chrom"]).alias("t_chrom"), F.col("q_chrom").cast(names["q_chrom"]).alias("q_chrom"), (F.col("t") - F.col("l_at")).alias("t"), (F.col("q") - F.col("l_at")).alias("q"),
        (F.col("length") + F.col("l_at") + F.col("r_at")).cast("long").alias("length"), (F.col("core") + F.col("r") + F.col("l")).alias("score"),
    ).distinct()


def hsps(hits: DataFrame, k: int, target: DataFrame, query: DataFrame, threshold: int, drop: int = 910, reach: int = 128, scoring: Scoring = DEFAULT) -> DataFrame:
    """High-scoring pairs of at least `threshold`."""
    return extended(seed_runs(hits, k), target, query, drop, reach, scoring).where(F.col("score") >= threshold)
