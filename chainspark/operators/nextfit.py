"""Next-fit bins over an ordered table, in parallel.

Next fit is a fold, but where a bin that begins at row i ends depends on i alone: the first row at
which the sum since i passes the limit, or the members run out. So a block of rows maps each
possible first bin start inside it to the first one in the next block, whatever came before. Blocks
are mapped side by side (each with a margin of the rows that follow); maps of neighbouring blocks are
put together, `FAN` at a time and level by level, into maps of ever longer stretches; entries then go
down the same levels, and every block assigns its bins. All of it runs in tasks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import indexed
from ..scratch import Scratch

#: Rows of a block, and maps that are put together at a time.
BLOCK, FAN = 1 << 14, 64
_MAP = "block long, enter long, leave long, bins long"


def _by_block(pdf: pd.DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(block, leave, bins) in order; both arrays by entry."""
    return [(int(b), g.sort_values("enter")["leave"].to_numpy(), g.sort_values("enter")["bins"].to_numpy()) for b, g in pdf.groupby("block", sort=True)]


def _together(pdf: pd.DataFrame) -> pd.DataFrame:
    """One map of a stretch of neighbouring blocks from theirs. A block shorter than an entry is passed over by it."""
    blocks = _by_block(pdf)
    up = int(pdf["up"].iloc[0])
    at, count = np.arange(len(blocks[0][1])), np.zeros(len(blocks[0][1]), dtype=np.int64)
    for _, leave, bins in blocks:
        inside = at < len(leave)
        count[inside] += bins[at[inside]]
        at = np.where(inside, leave[np.minimum(at, len(leave) - 1)], at - len(leave))
    return pd.DataFrame({"block": up, "enter": np.arange(len(at)), "leave": at, "bins": count})


def _followed(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where the first bin of each block of a stretch begins, and how many bins began before it, from those of the stretch."""
    at, count, out = int(pdf["at"].iloc[0]), int(pdf["before"].iloc[0]), []
    for b, leave, bins in _by_block(pdf):
        out.append((b, at, count))
        if at < len(leave):
            at, count = int(leave[at]), count + int(bins[at])
        else:
            at -= len(leave)
    return pd.DataFrame(out, columns=["block", "at", "before"])


def _entries(maps: DataFrame, blocks: int, scratch: Scratch) -> DataFrame:
    """(block, at, before) of all blocks."""
    levels = [scratch.keep(maps, "maps")]
    while blocks > 1:
        blocks = -(-blocks // FAN)
        levels.append(scratch.keep(levels[-1].withColumn("up", F.floor(F.col("block") / FAN).cast("long")).groupBy("up").applyInPandas(_together, _MAP), "maps"))
    at = levels.pop().select("block", F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("before")).distinct()
    while levels:
        up = at.select(F.col("block").alias("up"), "at", "before")
        at = levels.pop().withColumn("up", F.floor(F.col("block") / FAN).cast("long")).join(up, "up").groupBy("up").applyInPandas(_followed, "block long, at long, before long")
    return at


def _ends(before: np.ndarray, size: np.ndarray, limit: float, members: int, close_after: bool) -> np.ndarray:
    """For each row, the first row after a bin that begins there; len(size) or more: beyond what is known."""
    n = len(size)
    after = before + size
    i = np.arange(n)
    if close_after:  # the row that reaches the limit is the last one
        full = np.searchsorted(after, before + limit, side="left") + 1
    else:  # the row that would pass the limit opens the next bin
        full = np.maximum(np.searchsorted(after, before + limit, side="right"), i + 1)
    return np.minimum(full, i + members)


def next_fit(rows: DataFrame, lead: str, descending: bool, tie: str, limit: float, members: int, close_after: bool, block: int = BLOCK) -> DataFrame:
    """`rows` (with a column `size`) with `bin` and `pos` (in order), both from 0.

    The order is by `lead`, then `tie`. Without `close_after`, a bin holds rows while their sum stays
    within `limit` and their number within `members`; with it, a bin closes once it has reached
    `limit`, or `members` rows.
    """
    if members >= block:
        raise ValueError("a bin may not have as many members as a block has rows")
    order: list[Column] = [F.col(lead).desc() if descending else F.col(lead).asc(), F.col(tie).asc()]
    placed = Scratch(rows.sparkSession, "ordered").keep(indexed(rows, lead, order, ["size"], descending), "placed")
    own = F.floor(F.col("idx") / block).cast("long")
    copies = F.when((F.col("idx") % block < members + 1) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    wide = placed.select(F.explode(copies).alias("block"), "idx", F.col("size").cast("long").alias("size"), F.col("size_before").alias("before"))

    def maps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx", ignore_index=True)
        b = int(pdf["block"].iloc[0])
        n = int((pdf["idx"] < (b + 1) * block).sum())
        end = _ends(pdf["before"].to_numpy(), pdf["size"].to_numpy(), limit, members, close_after)
        leave, bins = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for i in range(n - 1, -1, -1):
            e = int(end[i])
            leave[i], bins[i] = (leave[e], bins[e] + 1) if e < n else (e - n, 1)
        some = min(n, members + 1)
        # entries past the end of a short last block lead nowhere; every map has an entry for its first row
        return pd.DataFrame({"block": b, "enter": np.arange(some), "leave": leave[:some], "bins": bins[:some]})

    scratch = Scratch(rows.sparkSession, "nextfit")
    made = wide.groupBy("block").applyInPandas(maps, _MAP)
    top = placed.agg(F.max("idx")).first()[0]
    begins = _entries(made, 0 if top is None else top // block + 1, scratch).select("block", F.col("at").alias("enter"), F.col("before").alias("bins"))

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx", ignore_index=True)
        b, enter, bin_ = int(pdf["block"].iloc[0]), int(pdf["enter"].iloc[0]), int(pdf["bins"].iloc[0])
        n = int((pdf["idx"] < (b + 1) * block).sum())
        end = _ends(pdf["before"].to_numpy(), pdf["size"].to_numpy(), limit, members, close_after)
        out = np.full(n, bin_ - 1, dtype=np.int64)  # rows before the first start belong to the bin before
        i = enter
        while i < n:
            e = min(int(end[i]), n)
            out[i:e] = bin_
            bin_ += 1
            i = int(end[i])
        return pd.DataFrame({"idx": pdf["idx"].to_numpy()[:n], "bin": out})

    got = wide.join(begins, "block").groupBy("block").applyInPandas(assign, "idx long, bin long")
    return placed.join(got, "idx").select(*rows.columns, "bin", F.col("idx").alias("pos"))


def sequential(sizes: Iterator[int], limit: float, members: int, close_after: bool) -> list[int]:
    """The plain fold, for tests."""
    out, bin_, total, n = [], 0, 0, 0
    for s in sizes:
        if close_after:
            out.append(bin_)
            total, n = total + s, n + 1
            if total >= limit or n >= members:
                bin_, total, n = bin_ + 1, 0, 0
        else:
            if n and (total + s > limit or n >= members):
                bin_, total, n = bin_ + 1, 0, 0
            total, n = total + s, n + 1
            out.append(bin_)
    return out
