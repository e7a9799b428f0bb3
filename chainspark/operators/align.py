"""Gapped alignment around high-scoring pairs, each homology once.

An alignment grows from a place inside a pair in both directions, row by row, over the columns whose
score stays within the drop of the best one so far; it ends when no column is left, however far away
that is. Affine gaps, numpy arrays of a row's live columns. Every `ROWS` rows the path up to the best
place is committed, and the alignment goes on from there.

Its two ends are rows of a table: a round fetches bases beyond each end that is alive, moves it on, and
writes the blocks it has passed, so nothing is aligned twice and no row carries more bases than a
round's stretch. Pairs start in three waves: the best of each cluster of near pairs on near diagonals, of
what is left the best of each cluster on one diagonal, then all. A pair that an alignment runs
through (one of its blocks lies on the pair's diagonal, over some of its bases) never starts. Where two
starts have led to one homology, the lesser alignment is absorbed (`absorb.py`). Blocks are on absolute coordinates.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.sequences import DEFAULT, Scoring, letter_codes, score_matrix
from ..scratch import Scratch, even_tasks, small_batches
from .absorb import absorbed
from .tiles import lengths, tiles, with_bases

_LETTERS = letter_codes()
_LOW = -(10**12)


#: Rows of target bases between two commits of a path.
ROWS = 4096
#: Stretches of ROWS that a round after the first may fetch at once.
STRETCHES = 16
#: Pairs within so many diagonals and so many bases are one cluster.
BAND, LINK = 1024, 4096


def _same(a: np.ndarray, b: np.ndarray, gap_open: int, gap_extend: int, matrix: np.ndarray) -> int:
    """Length of the shorter side if it is equal to the other's beginning and no other path scores as much, or 0.

    That is so where each base scores best with itself, and above 0: a path has a pair for each base of the shorter
    side at most, and any that leaves the diagonal pays for a gap.
    """
    k = min(len(a), len(b))
    if not k or a[0] != b[0] or gap_extend < 0 or gap_open + gap_extend <= 0 or not (a[:k] == b[:k]).all():
        return 0
    own = matrix.diagonal()
    good = (own > 0) & (own == matrix.max(axis=0)) & (own == matrix.max(axis=1))
    return k if good[a[:k]].all() else 0


def _stretch(a: np.ndarray, b: np.ndarray, drop: int, scoring: Scoring, matrix: np.ndarray) -> tuple[int, int, int, bool, list[list[int]]]:
    """(score, rows, columns, alive, blocks) of the best path from the corner over all of `a`, or until the drop ends it."""
    n, m, gap_open, gap_extend = len(a), len(b), scoring.gap_open, scoring.gap_extend
    if not n or not m:
        return 0, 0, 0, True, []
    k = _same(a, b, gap_open, gap_extend, matrix)
    if k:
        return int(matrix[a[:k], a[:k]].sum()), k, k, True, [[0, 0, k]]
    width = (max(0, drop - gap_open) // max(1, gap_extend)) + 1  # columns that a gap can add before the drop
    hi = min(m, width)
    best = np.append(0, -gap_open - gap_extend * np.arange(1, hi + 1, dtype=np.int64))
    up = np.full(hi + 1, _LOW, dtype=np.int64)
    lo, top, at = 0, 0, (0, 0)
    trace: list[tuple[int, np.ndarray]] = [(0, np.append(0, np.full(hi, 3)).astype(np.int8))]
    i, edge = 0, hi == m
    while i < n and len(best):
        i += 1
        end = min(m, lo + len(best) - 1 + 1 + width)  # last column of this row at most
        k = end - lo + 1
        old, old_up = np.full(k, _LOW, dtype=np.int64), np.full(k, _LOW, dtype=np.int64)
        old[: len(best)], old_up[: len(up)] = best[:k], up[:k]
        opened, longer = old - gap_open - gap_extend, old_up - gap_extend
        new_up = np.maximum(opened, longer)
        diag = np.full(k, _LOW, dtype=np.int64)
        diag[1:] = old[:-1] + matrix[a[i - 1], b[lo:end]]
        row = np.maximum(diag, new_up)
        # a gap along the row: the running maximum of what opened it, less what it has cost so far
        lead = np.maximum.accumulate(row + np.arange(k) * gap_extend)
        left = np.append(_LOW, lead[:-1] - gap_open - np.arange(1, k) * gap_extend)
        score = np.maximum(row, left)
        step = np.where(score == diag, 1, np.where(score == new_up, 2, 3)) + np.where(opened >= longer, 4, 0)
        step += np.where(left == np.append(_LOW, row[:-1] - gap_open - gap_extend), 8, 0)
        j = int(score.argmax())
        if score[j] > top:
            top, at = int(score[j]), (i, lo + j)
        live = np.flatnonzero(score >= top - drop)
        trace.append((lo, step.astype(np.int8)))
        if not len(live):
            best = best[:0]
            break
        first, last = int(live[0]), int(live[-1])
        edge |= lo + last == m  # more columns might have served
        best, up, lo = np.where(score >= top - drop, score, _LOW)[first : last + 1], new_up[first : last + 1], lo + first
    blocks: list[list[int]] = []
    i, j = at
    while i or j:
        begin, steps = trace[i]
        how = int(steps[j - begin])
        if how & 3 == 1:
            i, j = i - 1, j - 1
            if blocks and blocks[-1][0] == i + 1 and blocks[-1][1] == j + 1:
                blocks[-1] = [i, j, blocks[-1][2] + 1]
            else:
                blocks.append([i, j, 1])
        elif how & 3 == 2:
            while not trace[i][1][j - trace[i][0]] & 4:
                i -= 1
            i -= 1
        else:
            while i and not steps[j - begin] & 8:
                j -= 1
            j = j - 1 if i else 0
    return top, at[0], at[1], bool(len(best)) or edge, blocks[::-1]


def advanced(a: np.ndarray, b: np.ndarray, drop: int, a_end: bool = True, b_end: bool = True, step: int = ROWS, scoring: Scoring = DEFAULT) -> tuple[int, list[list[int]], int, int, bool]:
    """(score, blocks, rows, columns, alive) of the extension from the corner of two stretches of codes.

    a_end, b_end: whether the sequences end there; step: rows between commits. Alive: it may go on, from the
    place given, with more bases.
    """
    total, blocks, i, j, matrix = 0, [], 0, 0, score_matrix(scoring)
    while True:
        if len(a) - i < step and not a_end or len(b) - j < 2 * step and not b_end:
            return total, blocks, i, j, True
        score, di, dj, alive, more = _stretch(a[i : i + step], b[j : j + 2 * step], drop, scoring, matrix)
        for x, y, n in more:
            _append(blocks, i + x, j + y, n)
        total, i, j = total + score, i + di, j + dj
        if not alive or not score:
            return total, blocks, i, j, False


def _append(blocks: list[list[int]], t: int, q: int, n: int) -> None:
    """The block behind the others, as part of the last one if it goes on from there."""
    if blocks and blocks[-1][0] + blocks[-1][2] == t and blocks[-1][1] + blocks[-1][2] == q:
        blocks[-1][2] += n
    else:
        blocks.append([t, q, n])


def codes(seq: str) -> np.ndarray:
    return _LETTERS[np.frombuffer(seq.encode(), dtype=np.uint8)]


def around(t: str, q: str, t_at: int, q_at: int, drop: int, scoring: Scoring = DEFAULT) -> tuple[int, list[tuple[int, int, int]]]:
    """(score, blocks (t, q, size)) of the alignment through a pair of places of two whole stretches."""
    return arounds([(t, q, t_at, q_at)], drop, scoring)[0]


def arounds(places: list[tuple[str, str, int, int]], drop: int, scoring: Scoring = DEFAULT) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """As `around`, for many pairs of places; extensions of short sides are made side by side."""
    sides = []
    for t, q, t_at, q_at in places:
        a, b = codes(t), codes(q)
        sides += [(a[t_at:], b[q_at:]), (a[:t_at][::-1], b[:q_at][::-1])]
    out, ends = [], _ended(sides, drop, scoring)
    for (_, _, t_at, q_at), (right, ahead), (left, behind) in zip(places, ends[::2], ends[1::2], strict=True):
        blocks: list[list[int]] = []
        for x, y, n in reversed(behind):
            _append(blocks, t_at - x - n, q_at - y - n, n)
        for x, y, n in ahead:
            _append(blocks, t_at + x, q_at + y, n)
        out.append((left + right, [tuple(x) for x in blocks]))
    return out


#: Longest side, and number, of extensions that are made side by side.
TINY, AT_ONCE = 64, 4096


def _ended(sides: list[tuple[np.ndarray, np.ndarray]], drop: int, scoring: Scoring) -> list[tuple[int, list[list[int]]]]:
    """(score, blocks) of `advanced` from the corner of each pair of whole stretches.

    Where sides are so short that no place falls to the drop, the best path of one stretch is the best of all: what goes
    on from its end scores nothing. Such pairs of like length fill their tables of scores together.
    """
    matrix, gap_open, gap_extend = score_matrix(scoring), scoring.gap_open, scoring.gap_extend
    most, width = max(0, int(matrix.max())), (max(0, drop - gap_open) // max(1, gap_extend)) + 1
    out: list = [None] * len(sides)
    tiny = []
    for i, (a, b) in enumerate(sides):
        n, m = len(a), len(b)
        if not n or not m:
            out[i] = (0, [])
        elif max(n, m) > TINY or m > width or gap_open < 0 or gap_extend < 0 or min(n, m) * most - drop > -2 * gap_open - gap_extend * (n + m):
            out[i] = advanced(a, b, drop, scoring=scoring)[:2]
        elif k := _same(a, b, gap_open, gap_extend, matrix):
            out[i] = (int(matrix[a[:k], a[:k]].sum()), [[0, 0, k]])
        else:
            tiny.append(i)
    tiny.sort(key=lambda i: (len(sides[i][0]), len(sides[i][1])))
    for at in range(0, len(tiny), AT_ONCE):
        some = tiny[at : at + AT_ONCE]
        for i, got in zip(some, _together([sides[i] for i in some], gap_open, gap_extend, matrix), strict=True):
            out[i] = got
    return out


def _together(sides: list[tuple[np.ndarray, np.ndarray]], gap_open: int, gap_extend: int, matrix: np.ndarray) -> list[tuple[int, list[list[int]]]]:
    """(score, blocks) of `_stretch` for pairs of which no place is dropped, row by row of all tables at once.

    Shorter sides are filled up; no place of a table depends on one behind it, and only own places are looked at.
    """
    n, m = np.array([len(a) for a, _ in sides]), np.array([len(b) for _, b in sides])
    rows, columns, count = int(n.max()), int(m.max()), len(sides)
    a, b = np.zeros((count, rows), dtype=np.intp), np.zeros((count, columns), dtype=np.intp)
    for i, (x, y) in enumerate(sides):
        a[i, : len(x)], b[i, : len(y)] = x, y
    own = np.arange(columns + 1) <= m[:, None]
    cost = gap_extend * np.arange(columns + 1, dtype=np.int64)
    best = np.tile(np.append(0, -gap_open - cost[1:]), (count, 1))
    up = np.full((count, columns + 1), _LOW, dtype=np.int64)
    trace = np.empty((rows + 1, count, columns + 1), dtype=np.int8)
    trace[0] = np.append(0, np.full(columns, 3))
    top, top_i, top_j = (np.zeros(count, dtype=np.int64) for _ in range(3))
    diag, left, begun = (np.full((count, columns + 1), _LOW, dtype=np.int64) for _ in range(3))
    each = np.arange(count)
    for i in range(1, rows + 1):
        opened, longer = best - gap_open - gap_extend, up - gap_extend
        up = np.maximum(opened, longer)
        diag[:, 1:] = best[:, :-1] + matrix[a[:, i - 1, None], b]
        row = np.maximum(diag, up)
        lead = np.maximum.accumulate(row + cost, axis=1)
        left[:, 1:] = lead[:, :-1] - gap_open - cost[1:]
        begun[:, 1:] = row[:, :-1] - gap_open - gap_extend
        best = np.maximum(row, left)
        trace[i] = np.where(best == diag, 1, np.where(best == up, 2, 3)) + np.where(opened >= longer, 4, 0) + np.where(left == begun, 8, 0)
        j = np.where(own, best, _LOW).argmax(axis=1)
        here = best[each, j]
        better = (i <= n) & (here > top)
        top, top_i, top_j = np.where(better, here, top), np.where(better, i, top_i), np.where(better, j, top_j)
    return [(score, _path(trace[:, x], i, j)) for x, (score, i, j) in enumerate(zip(top.tolist(), top_i.tolist(), top_j.tolist(), strict=True))]


def _path(steps: np.ndarray, i: int, j: int) -> list[list[int]]:
    """Blocks of the path of a whole table of steps from its corner to a place."""
    steps, blocks = steps[: i + 1, : j + 1].tolist(), []
    while i or j:
        how = steps[i][j]
        if how & 3 == 1:
            i, j = i - 1, j - 1
            if blocks and blocks[-1][0] == i + 1 and blocks[-1][1] == j + 1:
                blocks[-1] = [i, j, blocks[-1][2] + 1]
            else:
                blocks.append([i, j, 1])
        elif how & 3 == 2:
            while not steps[i][j] & 4:
                i -= 1
            i -= 1
        else:
            while i and not steps[i][j] & 8:
                j -= 1
            j = j - 1 if i else 0
    return blocks[::-1]


_PAIR = ["t_chrom", "q_chrom"]
_END = ["aid", *_PAIR, "t_size", "q_size", "side", "t", "q"]
_BLOCKS = "array<struct<t:long,q:long,size:long,t_seq:string,q_seq:string>>"
_MOVED = f"aid long, t_chrom string, q_chrom string, t_size long, q_size long, side int, t long, q long, alive boolean, score long, blocks {_BLOCKS}"


def _starts(pairs: DataFrame, wave: int) -> DataFrame:
    """Of each cluster of pairs the best; in the last wave every pair."""
    if wave > 1:
        return pairs
    diagonal = F.floor((F.col("t") - F.col("q")) / (BAND if wave == 0 else 1)).cast("long")
    by = [*_PAIR, "band"]
    w = Window.partitionBy(*by).orderBy("t", "aid")
    rows = pairs.withColumn("band", diagonal).withColumn("reach", F.max(F.col("t") + F.col("length")).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("cluster", F.sum(F.coalesce((F.col("t") - F.col("reach") > LINK).cast("long"), F.lit(0))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    best = F.max_by(F.struct(*pairs.columns), F.struct(F.col("worth"), -F.col("aid")))
    return rows.groupBy(*by, "cluster").agg(best.alias("p")).select("p.*")


def _extended(starts: DataFrame, target: DataFrame, query: DataFrame, drop: int, scratch: Scratch, scoring: Scoring) -> DataFrame:
    """(aid, t_chrom, q_chrom, t_size, q_size, score, blocks): both ends of every start moved on until they end."""
    half, step = F.floor(F.col("length") / 2), ROWS
    ends = starts.select("aid", *_PAIR, "t_size", "q_size", F.explode(F.array(F.lit(1), F.lit(-1))).alias("side"), (F.col("t") + half).alias("t"), (F.col("q") + half).alias("q"))

    def move(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.itertuples():
                a, b, on = codes(r.t_seq), codes(r.q_seq), r.side > 0
                score, found, i, j, alive = advanced(a if on else a[::-1], b if on else b[::-1], drop, r.t1 == r.t_size if on else r.t0 == 0, r.q1 == r.q_size if on else r.q0 == 0, step, scoring)
                at = [(r.t + x, r.q + y, n) if on else (r.t - x - n, r.q - y - n, n) for x, y, n in found]
                cut = [{"t": t, "q": q, "size": n, "t_seq": r.t_seq[t - r.t0 : t - r.t0 + n], "q_seq": r.q_seq[q - r.q0 : q - r.q0 + n]} for t, q, n in at]
                out.append((r.aid, r.t_chrom, r.q_chrom, r.t_size, r.q_size, r.side, r.t + r.side * i, r.q + r.side * j, alive, score, cut))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in _MOVED.split(", ")])

    moved, stretch = None, step
    while True:
        on = F.col("side") > 0
        near = lambda c, n: (F.when(on, F.col(c)).otherwise(F.greatest(F.col(c) - n, F.lit(0))).alias(f"{c}0"), F.when(on, F.least(F.col(c) + n, F.col(f"{c}_size"))).otherwise(F.col(c)).alias(f"{c}1"))
        rows = ends.select(*_END, *near("t", stretch), *near("q", 2 * stretch))
        found = with_bases(with_bases(rows, target, "t_chrom", "t0", "t1", "t_seq"), query, "q_chrom", "q0", "q1", "q_seq")
        got = scratch.keep(even_tasks(small_batches(found)).mapInPandas(move, _MOVED), "moved")
        moved = got if moved is None else moved.union(got)
        ends = got.where("alive").select(_END)
        if ends.isEmpty():
            break
        stretch = STRETCHES * step

    def joined(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf.assign(blocks=[_joined(x) for x in pdf["blocks"]])

    whole = moved.groupBy("aid", *_PAIR, "t_size", "q_size").agg(F.sum("score").alias("score"), F.flatten(F.collect_list("blocks")).alias("blocks"))
    return whole.mapInPandas(joined, whole.schema)


def _joined(blocks: Iterable[dict]) -> list[dict]:
    """Blocks in order; those that go on from one another, as at the start of both sides and between stretches, are one."""
    out: list[dict] = []
    for b in sorted(blocks, key=lambda b: (b["t"], b["q"])):
        last = out[-1] if out else None
        if last and last["t"] + last["size"] == b["t"] and last["q"] + last["size"] == b["q"]:
            out[-1] = {"t": last["t"], "q": last["q"], **{c: last[c] + b[c] for c in ("size", "t_seq", "q_seq")}}
        else:
            out.append(b)
    return out


def _uncovered(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs that no alignment runs through."""
    b = found.select(*[F.col(c).alias(f"_{c}") for c in _PAIR], F.explode("blocks").alias("b"))
    b = b.select(*[f"_{c}" for c in _PAIR], (F.col("b.t") - F.col("b.q")).alias("_diagonal"), F.col("b.t").alias("_lo"), (F.col("b.t") + F.col("b.size")).alias("_hi"))
    same = (F.col("t_chrom") == F.col("_t_chrom")) & (F.col("q_chrom") == F.col("_q_chrom")) & (F.col("t") - F.col("q") == F.col("_diagonal"))
    return pairs.join(b, same & (F.col("_lo") < F.col("t") + F.col("length")) & (F.col("_hi") > F.col("t")), "left_anti")


def gapped(pairs: DataFrame, target: DataFrame, query: DataFrame, threshold: int, drop: int = 9400, share: float = 0.95, scoring: Scoring = DEFAULT) -> DataFrame:
    """(t_name, t_size, q_name, q_size, strand, score, blocks) of alignments of at least `threshold`, each homology once.

    blocks: array<struct<t, q, size, t_seq, q_seq>>. pairs: (t_chrom, q_chrom, t, q, length) and, where known,
    score, by which the best of a cluster is told; alignments grow from the middle of their pair.
    """
    scratch = Scratch(pairs.sparkSession, "gapped")
    size = lambda g, s: lengths(g).select(F.col("chrom").alias(f"{s}_chrom"), F.col("size").alias(f"{s}_size"))
    target, query = scratch.keep(tiles(target), "target"), scratch.keep(tiles(query), "query")  # each round reads them again
    worth = F.col("score" if "score" in pairs.columns else "length").cast("long").alias("worth")
    rows = pairs.select(*[F.col(c).cast("string").alias(c) for c in _PAIR], *[F.col(c).cast("long").alias(c) for c in ("t", "q", "length")], worth).distinct()
    rows = rows.join(size(target, "t"), "t_chrom").join(size(query, "q"), "q_chrom")
    left = scratch.keep(rows.withColumn("aid", F.monotonically_increasing_id()), "pairs")
    found = None
    for wave in range(3):
        starts = scratch.keep(_starts(left, wave), "starts")
        got = scratch.keep(_extended(starts, target, query, drop, scratch, scoring).where(F.col("score") >= threshold), "aligned")
        found = got if found is None else found.union(got)
        left = scratch.keep(_uncovered(left.join(starts.select("aid"), "aid", "left_anti"), got), "left")
        if left.isEmpty():
            break
    named = found.select("aid", F.col("t_chrom").alias("t_name"), "t_size", F.col("q_chrom").alias("q_name"), "q_size", F.lit("+").alias("strand"), "score", "blocks")
    return absorbed(named, share).drop("aid")
