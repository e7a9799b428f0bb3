"""Scalar functions on sequences: upper case is unmasked, lower case soft-masked, N unknown."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- fixed values: substitution scores of the alignment, rows and columns in the order A C G T
SUBSTITUTION = {
    "A": {"A": 91, "C": -114, "G": -31, "T": -123},
    "C": {"A": -114, "C": 100, "G": -125, "T": -31},
    "G": {"A": -31, "C": -125, "G": 100, "T": -114},
    "T": {"A": -123, "C": -31, "G": -114, "T": 91},
}
# --- end of fixed values
#: A pair with an unknown base.
UNKNOWN = -100


@dataclass(frozen=True)
class Scoring:
    """What pairs of bases score, rows and columns in the order A C G T, and what gaps in alignments cost."""

    pairs: tuple[tuple[int, ...], ...] = tuple(tuple(row.values()) for row in SUBSTITUTION.values())
    unknown: int = UNKNOWN
    gap_open: int = 400
    gap_extend: int = 30

    def of(self, x: str, y: str) -> int:
        return self.pairs["ACGT".index(x)]["ACGT".index(y)]


DEFAULT = Scoring()


def scoring_of(text: str) -> Scoring:
    """From a score file: a heading of the four bases, four rows (a base before each, or none), and gap costs.

    Gap costs are `O = 400, E = 30` or `gap_open_penalty = 400` and `gap_extend_penalty = 30`; what is missing
    keeps its default. `#` begins a comment, other settings are passed over.
    """
    order: list[str] = []
    rows: dict[str, tuple[int, ...]] = {}
    costs: dict[str, int] = {}
    for line in (x.partition("#")[0].strip() for x in text.splitlines()):
        for name, value in re.findall(r"(\w+)\s*=\s*(-?\d+)", line):
            costs[{"O": "gap_open", "E": "gap_extend", "gap_open_penalty": "gap_open", "gap_extend_penalty": "gap_extend"}.get(name, name)] = int(value)
        f = line.upper().split()
        if sorted(f) == list("ACGT"):
            order = f
        elif order and "=" not in line and len(f) in (4, 5) and len(rows) < 4:
            rows[f[0] if len(f) == 5 else order[len(rows)]] = tuple(map(int, f[-4:]))
    if sorted(rows) != list("ACGT"):
        raise ValueError("a score file has a heading of A, C, G and T and a row of four scores for each")
    known = {k: v for k, v in costs.items() if k in ("gap_open", "gap_extend")}
    return Scoring(pairs=tuple(tuple(rows[x][order.index(y)] for y in "ACGT") for x in "ACGT"), **known)


def read_scoring(spark: SparkSession, path: str) -> Scoring:
    """A score file, a parameter of a few lines, from wherever Spark reads."""
    return scoring_of("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), "ACGTacgt", "TGCAtgca")


def subsequence(seq: Column, start: Column, end: Column) -> Column:
    """Bases of the 0-based, half-open range."""
    return F.substring(seq, start + 1, F.greatest(end - start, F.lit(0)))


def masked_bases(seq: Column) -> Column:
    return F.length(F.regexp_replace(seq, "[^acgtn]", "")).cast("long")


def unmasked(seq: Column) -> Column:
    return F.upper(seq)


def base_count(seq: Column, base: str) -> Column:
    """How often a base occurs, in either case."""
    return (F.length(seq) - F.length(F.replace(F.upper(seq), F.lit(base), F.lit("")))).cast("long")


def pair_score(a: Column, b: Column, scoring: Scoring = DEFAULT) -> Column:
    """The substitution score of two bases, case aside."""
    up_a, up_b = F.upper(a), F.upper(b)
    key = F.concat(up_a, up_b)
    out = F.when(key == "AA", F.lit(scoring.of("A", "A")))
    for x in "ACGT":
        for y in "ACGT":
            if x + y != "AA":
                out = out.when(key == x + y, F.lit(scoring.of(x, y)))
    return out.otherwise(F.lit(scoring.unknown)).cast("long")


def score_matrix(scoring: Scoring = DEFAULT) -> np.ndarray:
    """Scores by `letter_codes` of two bases; the last row and column are the unknown base."""
    out = np.full((5, 5), scoring.unknown, dtype=np.int64)
    out[:4, :4] = scoring.pairs
    return out


def letter_codes() -> np.ndarray:
    """0 to 3 for A C G T in either case, 4 for any other byte."""
    out = np.full(256, 4, dtype=np.int64)
    for i, c in enumerate("ACGT"):
        out[ord(c)] = out[ord(c.lower())] = i
    return out


def pairs_total(a: Column, b: Column, scoring: Scoring = DEFAULT) -> Column:
    """The summed scores of two strings' bases side by side, up to the end of the shorter one; a blank is no base and scores 0."""
    matrix, codes = np.zeros((6, 6), dtype=np.int64), letter_codes()
    matrix[:5, :5], codes[ord(" ")] = score_matrix(scoring), 5

    def total(x: pd.Series, y: pd.Series) -> pd.Series:
        n = np.minimum(x.str.len(), y.str.len()).to_numpy()
        left, right = ("".join(s[:k] for s, k in zip(c, n.tolist(), strict=True)).encode() for c in (x, y))
        sums = np.concatenate([[0], np.cumsum(matrix[codes[np.frombuffer(left, dtype=np.uint8)], codes[np.frombuffer(right, dtype=np.uint8)]])])
        ends = np.cumsum(n)
        return pd.Series(sums[ends] - sums[ends - n])

    return F.pandas_udf(total, "long")(a, b)


def pair_score_sql(a: str, b: str, scoring: Scoring = DEFAULT) -> str:
    """`pair_score` as SQL text."""
    cases = " ".join(f"WHEN '{x}{y}' THEN {scoring.of(x, y)}" for x in "ACGT" for y in "ACGT")
    return f"CASE upper({a}) || upper({b}) {cases} ELSE {scoring.unknown} END"
