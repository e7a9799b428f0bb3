"""Gaps of chains, and boxes between alignments, filled with local alignments between their two sides.

Inside a gap both sides are short (20,000 bases at most by default). Words that both have give
diagonals; the best ungapped stretch on each is an anchor, and from anchors, best first, alignments grow by
the same recursion as elsewhere, but from none that an alignment found before runs through. Of all local
alignments the best colinear set is kept: the most score less the cost of the gaps between. Memory is linear
in the gap's length, whatever its sides are.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.gaps import gap_cost_value
from ..functions.sequences import DEFAULT, Scoring, letter_codes, score_matrix
from ..scratch import small_batches
from .align import TINY, arounds, codes
from .tiles import on_strand, with_bases

_LETTERS, _KNOWN = letter_codes(), frozenset("ACGT")


def gap_sequences(gaps: DataFrame, target: DataFrame, query: DataFrame, unmask: bool = True) -> DataFrame:
    """`gaps` (cid, i, t_name, q_name, t_from, t_to, q_from, q_to) with the bases on both sides.

    With columns q_strand and q_size, query places are counted on the strand. Unless `unmask`, masked
    bases stay lower case and don't seed.
    """
    rows = gaps if "q_strand" in gaps.columns else gaps.withColumn("q_strand", F.lit("+")).withColumn("q_size", F.lit(0).cast("long"))
    got = on_strand(with_bases(rows, target, "t_name", "t_from", "t_to", "t_seq"), query, "q_from", "q_to", "q_seq")
    shown = (lambda c: F.upper(c).alias(c)) if unmask else F.col
    return got.select(*gaps.columns, shown("t_seq"), shown("q_seq"))


def _words(seq: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, places) of the words of k unmasked, known bases."""
    raw = np.frombuffer(seq.encode(), dtype=np.uint8)
    code = np.where((raw >= 97) | (_LETTERS[raw] > 3), -1, _LETTERS[raw])
    n = len(code) - k + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    view = np.lib.stride_tricks.sliding_window_view(code, k)
    ok = np.flatnonzero((view >= 0).all(axis=1))
    return view[ok] @ (4 ** np.arange(k, dtype=np.int64)), ok


def _diagonals(t: str, q: str, k: int) -> set[int]:
    """Diagonals with a common word of k unmasked, known bases."""
    out: set[int] = set()
    if max(len(t), len(q)) <= TINY:  # a few words are looked up sooner than counted
        at: dict[str, list[int]] = {}
        for j in range(len(q) - k + 1):
            at.setdefault(q[j : j + k], []).append(j)
        for i in range(len(t) - k + 1):
            if (w := t[i : i + k]) in at and _KNOWN.issuperset(w):
                out.update(j - i for j in at[w])
        return out
    (a, pa), (b, pb) = _words(t, k), _words(q, k)
    order = np.argsort(b, kind="stable")
    lo, hi = np.searchsorted(b[order], a, side="left"), np.searchsorted(b[order], a, side="right")
    for i in np.flatnonzero(hi > lo).tolist():
        out.update((pb[order[lo[i] : hi[i]]] - pa[i]).tolist())
    return out


def anchors(t: str, q: str, k: int = 11, scoring: Scoring = DEFAULT) -> list[tuple[int, int, int, int]]:
    """(score, t, q, size) of the best ungapped stretch on each diagonal with a common word, best first."""
    diagonals = _diagonals(t, q, k)
    if not diagonals:
        return []
    x, y, matrix = codes(t), codes(q), score_matrix(scoring)
    out = []
    for d in sorted(diagonals):
        first = max(0, -d)
        n = min(len(x) - first, len(y) - first - d)
        sums = np.append(0, np.cumsum(matrix[x[first : first + n], y[first + d : first + d + n]]))
        low = np.minimum.accumulate(sums)
        end = int((sums - low).argmax())
        begin = int(sums[: end + 1].argmin())
        out.append((int(sums[end] - low[end]), first + begin, first + begin + d, end - begin))
    return sorted(out, key=lambda x: (-x[0], x[1], x[2]))


Found = list[tuple[int, list[tuple[int, int, int]]]]


def _found(t: str, q: str, k: int, least: int, threshold: int, scoring: Scoring) -> Generator[tuple[str, str, int, int], tuple[int, list[tuple[int, int, int]]], Found]:
    """Asks for the alignment around one place after another; at the end, those of at least `threshold`."""
    found: Found = []
    for score, at, to, n in anchors(t, q, k, scoring):
        if score < least:
            break
        if any(b[1] - b[0] == to - at and b[0] < at + n and b[0] + b[2] > at for _, own in found for b in own):
            continue
        total, blocks = yield t, q, at + n // 2, to + n // 2
        if total >= threshold:
            found.append((total, blocks))
    return found


def local_alignments_of(sides: list[tuple[str, str]], k: int, least: int, threshold: int, drop: int, scoring: Scoring = DEFAULT) -> list[Found]:
    """As `local_alignments`, for many gaps: what each asks for next is aligned together."""
    runs = [_found(t, q, k, least, threshold, scoring) for t, q in sides]
    out: list[Found] = [[] for _ in runs]
    answers: dict[int, tuple | None] = dict.fromkeys(range(len(runs)))
    while answers:
        asked = {}
        for i, answer in answers.items():
            try:
                asked[i] = runs[i].send(answer)
            except StopIteration as e:
                out[i] = e.value
        answers = dict(zip(asked, arounds(list(asked.values()), drop, scoring), strict=True))
    return out


def local_alignments(t: str, q: str, k: int, least: int, threshold: int, drop: int, scoring: Scoring = DEFAULT) -> Found:
    """(score, blocks) of the alignments of at least `threshold` from anchors of at least `least`."""
    return local_alignments_of([(t, q)], k, least, threshold, drop, scoring)[0]


def colinear(found: list[tuple[int, list[tuple[int, int, int]]]], table: str = "loose") -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Of local alignments the best set that follow each other on both sides: most score, less the cost of the gaps between."""
    rows = sorted(found, key=lambda x: (x[1][0][0], x[1][0][1]))
    total, back = [s for s, _ in rows], [-1] * len(rows)
    for j, (score, blocks) in enumerate(rows):
        for i in range(j):
            t, q, n = rows[i][1][-1]
            dt, dq = blocks[0][0] - t - n, blocks[0][1] - q - n
            if dt >= 0 and dq >= 0 and (gain := total[i] - int(gap_cost_value(dt, dq, table))) > 0 and score + gain > total[j]:
                total[j], back[j] = score + gain, i
    j = max(range(len(rows)), key=lambda k: total[k], default=-1)
    out = []
    while j >= 0:
        out.append(rows[j])
        j = back[j]
    return out[::-1]


def fillings(gaps: DataFrame, threshold: int = 5000, least: int = 2000, drop: int = 9400, k: int = 11, table: str = "loose", scoring: Scoring = DEFAULT) -> DataFrame:
    """(cid, i, part, score, t, q, size): blocks of the colinear alignments in each gap, of at least `threshold` each."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            every = local_alignments_of(list(zip(pdf["t_seq"], pdf["q_seq"], strict=True)), k, min(least, threshold), threshold, drop, scoring)
            for r, local in zip(pdf.itertuples(), every, strict=True):
                for part, (score, found) in enumerate(colinear(local, table)):
                    out += [(r.cid, r.i, part, score, r.t_from + t, r.q_from + q, n) for t, q, n in found]
            yield pd.DataFrame(out, columns=["cid", "i", "part", "score", "t", "q", "size"])

    return small_batches(gaps).mapInPandas(run, "cid long, i long, part long, score long, t long, q long, size long")


#: Longest side of a box between alignments that is looked into, and the length of words there.
INNER, INNER_WORD = 20_000, 7


def interpolated(alignments: DataFrame, target: DataFrame, query: DataFrame, threshold: int = 2000, drop: int = 9400, k: int = INNER_WORD, most: int = INNER, scoring: Scoring = DEFAULT) -> DataFrame:
    """Alignments like the given ones, found by shorter words in the boxes between neighbours, at a threshold of their own.

    alignments: as `gapped` returns them. Neighbours follow each other on the target, and a box is the room
    between one's end and the next one's beginning on both sides, at most `most` bases each.
    """
    w = Window.partitionBy("t_name", "q_name").orderBy("t_lo", "q_lo", "t_hi")
    b = F.col("blocks")
    last = F.element_at(b, -1)
    ends = alignments.select("t_name", "t_size", "q_name", "q_size", b[0]["t"].alias("t_lo"), b[0]["q"].alias("q_lo"), (last["t"] + last["size"]).alias("t_hi"), (last["q"] + last["size"]).alias("q_hi"))
    box = ends.select("t_name", "t_size", "q_name", "q_size", F.col("t_hi").alias("t_from"), F.lead("t_lo").over(w).alias("t_to"), F.col("q_hi").alias("q_from"), F.lead("q_lo").over(w).alias("q_to"))
    box = box.where((F.col("t_to") - F.col("t_from")).between(k, most) & (F.col("q_to") - F.col("q_from")).between(k, most)).distinct()
    rows = with_bases(with_bases(box, target, "t_name", "t_from", "t_to", "t_seq"), query, "q_name", "q_from", "q_to", "q_seq")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.itertuples():
                for score, found in colinear(local_alignments(r.t_seq, r.q_seq, k, threshold, threshold, drop, scoring)):
                    cut = [{"t": r.t_from + t, "q": r.q_from + q, "size": n, "t_seq": r.t_seq[t : t + n], "q_seq": r.q_seq[q : q + n]} for t, q, n in found]
                    out.append((r.t_name, r.t_size, r.q_name, r.q_size, "+", score, cut))
            yield pd.DataFrame(out, columns=["t_name", "t_size", "q_name", "q_size", "strand", "score", "blocks"])

    return rows.mapInPandas(run, alignments.select("t_name", "t_size", "q_name", "q_size", "strand", "score", "blocks").schema)


def spliced(placed: DataFrame, filled: DataFrame) -> DataFrame:
    """Blocks (cid, t, q, size) of all chains with the fillings among them."""
    return placed.select("cid", "t", "q", "size").unionByName(filled.select("cid", "t", "q", "size"))
