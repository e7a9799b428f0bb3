"""Costs of gaps in chains: piecewise linear in the gap's length."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GapTable:
    """Costs at some lengths for gaps on one side, and on both."""

    at: tuple[int, ...]
    one_side: tuple[int, ...]
    both_sides: tuple[int, ...]


# --- fixed values: the two published gap cost tables
LOOSE = GapTable(
    at=(1, 2, 3, 11, 111, 2111, 12111, 32111, 72111, 152111, 252111),
    one_side=(325, 360, 400, 450, 600, 1100, 3600, 7600, 15600, 31600, 56600),
    both_sides=(625, 660, 700, 750, 900, 1400, 4000, 8000, 16000, 32000, 57000),
)
MEDIUM = GapTable(
    at=(1, 2, 3, 11, 111, 2111, 12111, 32111, 72111, 152111, 252111),
    one_side=(350, 425, 450, 600, 900, 2900, 22900, 57900, 117900, 217900, 317900),
    both_sides=(750, 825, 850, 1000, 1300, 3300, 23300, 58300, 118300, 218300, 318300),
)
# --- end of fixed values
TABLES = {"loose": LOOSE, "medium": MEDIUM}


def _slopes(at: tuple[int, ...], cost: tuple[int, ...]) -> list[tuple[int, int, int, int]]:
    """(from, its cost, rise, run) of each piece; the last piece goes on for ever."""
    return [(a, c, d - c, b - a) for a, b, c, d in zip(at, at[1:], cost, cost[1:], strict=False)]


def _piecewise(length: Column, at: tuple[int, ...], cost: tuple[int, ...]) -> Column:
    pieces = _slopes(at, cost)
    line = lambda p: F.lit(float(p[1])) + (length - p[0]) * F.lit(float(p[2])) / F.lit(float(p[3]))
    out = F.when(length <= at[0], F.lit(float(cost[0])))
    for p, end in zip(pieces[:-1], at[1:-1], strict=True):
        out = out.when(length <= end, line(p))
    return out.otherwise(line(pieces[-1]))


def gap_cost(dt: Column, dq: Column, table: str = "loose") -> Column:
    """Cost of a gap of dt target and dq query bases; 0 where both are 0 or less."""
    t = TABLES[table]
    both = (dt > 0) & (dq > 0)
    one = F.greatest(dt, dq)
    return F.floor(F.when(both, _piecewise(dt + dq, t.at, t.both_sides)).when(one > 0, _piecewise(one, t.at, t.one_side)).otherwise(F.lit(0.0))).cast("long")


def _piecewise_sql(length: str, at: tuple[int, ...], cost: tuple[int, ...]) -> str:
    pieces = _slopes(at, cost)
    line = lambda p: f"{p[1]}::DOUBLE + ({length} - {p[0]}) * {p[2]}::DOUBLE / {p[3]}::DOUBLE"
    out = f"CASE WHEN {length} <= {at[0]} THEN {cost[0]}::DOUBLE "
    for p, end in zip(pieces[:-1], at[1:-1], strict=True):
        out += f"WHEN {length} <= {end} THEN {line(p)} "
    return out + f"ELSE {line(pieces[-1])} END"


def gap_cost_sql(dt: str, dq: str, table: str = "loose") -> str:
    t = TABLES[table]
    both = _piecewise_sql(f"({dt} + {dq})", t.at, t.both_sides)
    one = _piecewise_sql(f"greatest({dt}, {dq})", t.at, t.one_side)
    return f"floor(CASE WHEN {dt} > 0 AND {dq} > 0 THEN {both} WHEN greatest({dt}, {dq}) > 0 THEN {one} ELSE 0::DOUBLE END)::BIGINT"


def gap_cost_value(dt, dq, table: str = "loose"):
    """`gap_cost` for numpy arrays."""
    import numpy as np

    t = TABLES[table]

    def line(x, cost):
        y = np.interp(x, t.at, cost)
        a, b, c, d = t.at[-2], t.at[-1], cost[-2], cost[-1]
        return np.where(x > b, c + (x - a) * (d - c) / (b - a), y)

    dt, dq = np.asarray(dt, dtype=np.float64), np.asarray(dq, dtype=np.float64)
    both, one = (dt > 0) & (dq > 0), np.maximum(dt, dq)
    return np.floor(np.where(both, line(dt + dq, t.both_sides), np.where(one > 0, line(one, t.one_side), 0.0))).astype(np.int64)


def least_cost(table: str = "loose"):
    """A function of (dt, dq), two numbers, that no gap of at least so many bases on either side costs less than."""
    from bisect import bisect_right

    t = TABLES[table]

    def line(x: int, cost: tuple[int, ...]) -> float:
        k = min(max(bisect_right(t.at, x) - 1, 0), len(t.at) - 2)
        return cost[0] if x <= t.at[0] else cost[k] + (x - t.at[k]) * (cost[k + 1] - cost[k]) / (t.at[k + 1] - t.at[k])

    def bound(dt: int, dq: int) -> float:
        if dt > 0 and dq > 0:
            return line(dt + dq, t.both_sides) - 1  # costs are rounded down
        return line(max(dt, dq), t.one_side) - 1 if max(dt, dq) > 0 else 0

    return bound
