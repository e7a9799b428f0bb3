"""The hierarchical net: which chain fills which part of the reference, inside whose gap.

Chains claim the reference in order of score (ties by id). A chain takes, in every space that is still
free, the bases under its blocks; from its first to its last block there is one *fill*, and the gaps
between those blocks stay free for chains further down, whose fills there are one level lower.

Two facts make that a local computation. A base belongs to the best chain with a block on it, whatever
lies elsewhere, so bins of the reference are swept side by side and leave a sequence of owned pieces. And
two pieces of a chain are one fill unless a better chain owns something between them. So the fills are
read off the pieces from left to right with a stack of open fills, best at the bottom: a piece closes
all worse fills on top, then goes on with its own chain's fill or opens one. A bin's effect on the
stack is its own stack, started empty, so the stacks at bin edges are put together from one small list a
bin, and then all bins are read at once.

A fill that a piece closes lies in the gap of the fill beneath it if that is the fill which the piece belongs
to, and beside the worse of its two neighbours otherwise; such pointers are followed by doubling.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.groups import firsts, whole_groups
from ..scratch import Scratch
from .nets import envelopes

#: An open fill: rank, id, score, start and the end so far.
_OPEN = "id string, score long, start long, end long"
_KEY = ["t_name", "id", "start"]
_BIN = ["t_name", "bin"]
#: Batches of blocks that are swept together before they are shuffled.
BATCHES = 64


def better(a: tuple, b: tuple) -> bool:
    """Whether open fill `a` = (id, score, start, end) is of a better chain than `b`."""
    return (-a[1], a[0]) < (-b[1], b[0])


def stacked(stack: list[list], pieces: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """(closed fills, gaps) of pieces (id, score, start, end) in order; `stack` is what is open, and changes.

    A closed fill is (fill, beneath, closer's id, start, score and end before its piece); a gap is (id, fill's
    start, start, end).
    """
    closed, gaps = [], []
    for p in pieces:
        popped = []
        while stack and better(p, stack[-1]):
            popped.append((stack[-1], stack[-2] if len(stack) > 1 else None))
            stack.pop()
        if stack and stack[-1][0] == p[0]:
            own = stack[-1]
            upto = own[3]
            if upto < p[2]:
                gaps.append((own[0], own[2], upto, p[2]))
            own[3] = p[3]
        else:
            own, upto = list(p), None
            stack.append(own)
        closed += [(f, beneath, own[0], own[2], own[1], upto) for f, beneath in popped]
    return closed, gaps


def fill_row(t_name: str, fill: list, beneath: list | None, closer: str, closer_start: int, closer_score: int, upto: int | None) -> tuple:
    """A row of `_FILL`: a child of ref, in its gap that begins at ref_gap, or beside ref."""
    own = (t_name, fill[0], int(fill[1]), int(fill[2]), int(fill[3]))
    if beneath is not None and (beneath[0], beneath[2]) == (closer, closer_start):
        return (*own, "child", closer, closer_start, upto)
    if beneath is not None and better((closer, closer_score), beneath):
        return (*own, "beside", beneath[0], int(beneath[2]), None)
    return (*own, "beside", closer, closer_start, None)


_FILL = "t_name string, id string, score long, start long, end long, state string, ref string, ref_start long, ref_gap long"


def _rows(rows: list[tuple], ddl: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[x.split()[0] for x in ddl.split(", ")])
    return out.astype({c: "Int64" for c, k in (x.split() for x in ddl.split(", ")) if k == "long"})


def owned(blocks: DataFrame, width: int) -> DataFrame:
    """Pieces (t_name, bin, kind 'piece', id, score, start, end), and the stack that each bin leaves (kind 'open', in order)."""
    bin_of = lambda c: F.floor(c / F.lit(float(width))).cast("long")
    rows = blocks.where("end > start").select("t_name", "id", "score", "start", "end", F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end") - 1))).alias("bin"))
    rows = rows.select("t_name", "bin", "id", "score", F.greatest("start", F.col("bin") * width).alias("lo"), F.least("end", (F.col("bin") + 1) * width).alias("hi"))
    best = swept_pieces(rows, width, BATCHES)
    # bins are swept at once; what lies in a bin was swept before it was shuffled
    swept = swept_pieces(best.repartition("t_name", "bin").sortWithinPartitions("t_name", "bin"), width, 1)
    ddl = f"t_name string, bin long, kind string, nth long, {_OPEN}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, _BIN):
            rows = []
            at = [*firsts(t, _BIN).tolist(), t.num_rows]
            names, columns = t["t_name"].to_pylist(), [t[c].to_pylist() for c in ("bin", "id", "score", "lo", "hi")]
            for a, b in zip(at, at[1:], strict=False):
                key, stack = (names[a], columns[0][a]), []
                pieces = list(zip(*(c[a:b] for c in columns[1:]), strict=True))
                stacked(stack, pieces)
                rows += [(*key, "piece", n, *p) for n, p in enumerate(pieces)]
                rows += [(*key, "open", n, *p) for n, p in enumerate(stack)]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in ddl.split(", ")])

    return swept.mapInArrow(read, ddl)


def swept_pieces(rows: DataFrame, width: int, batches: int) -> DataFrame:
    """Of rows (t_name, bin, id, score, lo, hi) what is best at its place, among the rows of so many batches of a partition at least.

    Where rows come sorted by bin and `batches` is 1, among all of their bin, in order.
    """
    names = ["t_name", "bin", "id", "score", "lo", "hi"]

    def best(t: pa.Table) -> Iterator[pa.RecordBatch]:
        row, lo, hi = envelopes(t, _BIN, width)
        yield from pa.table([*(t[c].take(row) for c in names[:4]), pa.array(lo), pa.array(hi)], names).to_batches()

    def sweep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if batches == 1:
            for t in whole_groups(parts, _BIN):
                yield from best(t)
            return
        while held := list(islice(parts, batches)):
            t = pa.Table.from_batches(held)
            if t.num_rows:
                yield from best(t.sort_by([("t_name", "ascending"), ("bin", "ascending")]))

    return rows.select(names).mapInArrow(sweep, "t_name string, bin long, id string, score long, lo long, hi long")


def carried(swept: DataFrame) -> DataFrame:
    """What is open where a bin begins, as far as the bin touches it: (t_name, bin, kind 'carried', nth, fill); fills that no bin closes have bin null.

    A chromosome is one task here, over the few fills that each bin leaves open.
    """
    ddl = f"t_name string, bin long, kind string, nth long, {_OPEN}"

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        name, stack, out = pdf["t_name"].iloc[0], [], []
        for at, g in pdf.sort_values(["bin", "nth"]).groupby("bin", sort=True):
            own = [[r.id, int(r.score), int(r.start), int(r.end)] for r in g.itertuples()]
            touched = []
            while stack and better(own[0], stack[-1]):
                touched.append(stack.pop())
            if stack and stack[-1][0] == own[0][0]:
                touched.append(list(stack[-1]))
                beneath = stack[-2:-1]
                stack[-1][3] = own[0][3]
            else:
                beneath = stack[-1:]
                stack.append(own[0])
            stack += own[1:]
            out += [(name, int(at), "carried", n, *f) for n, f in enumerate([*beneath, *reversed(touched)])]
        return _rows([*out, *((name, None, "left", n, *f) for n, f in enumerate(stack))], ddl)

    return swept.where("kind = 'open'").groupBy("t_name").applyInPandas(compose, ddl)


def closed(swept: DataFrame, before: DataFrame) -> DataFrame:
    """Fills with their pointer, and gaps (state 'gap', ref_start: the fill's start)."""

    def read(pdf: pd.DataFrame) -> pd.DataFrame:
        name = pdf["t_name"].iloc[0]
        of = lambda kind: [[r.id, int(r.score), int(r.start), int(r.end)] for r in pdf[pdf["kind"] == kind].sort_values("nth").itertuples()]
        done, gaps = stacked(of("carried"), [tuple(p) for p in of("piece")])
        return _rows([*(fill_row(name, *x) for x in done), *((name, i, 0, lo, hi, "gap", i, at, None) for i, at, lo, hi in gaps)], _FILL)

    at_edges = before.where("bin IS NOT NULL")
    inner = swept.where("kind = 'piece'").unionByName(at_edges).groupBy("t_name", "bin").applyInPandas(read, _FILL)
    rest = before.where("bin IS NULL").select("t_name", "id", "score", "start", "end", F.lit("top").alias("state"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("ref_start"), F.lit(None).cast("long").alias("ref_gap"))
    return inner.unionByName(rest)


def placed(fills: DataFrame, scratch: Scratch) -> DataFrame:
    """Fills (t_name, id, score, start, end, parent, parent_start, parent_gap, depth); a pointer is followed to twice its length a round."""
    as_ref = [F.col("id").alias("ref"), F.col("start").alias("ref_start")]
    while not fills.where("state = 'beside'").isEmpty():
        to = fills.select("t_name", *as_ref, F.col("state").alias("s"), F.col("ref").alias("r"), F.col("ref_start").alias("rs"), F.col("ref_gap").alias("rg"))
        j = fills.where("state = 'beside'").join(to, ["t_name", "ref", "ref_start"]).select(*_KEY, "score", "end", F.col("s").alias("state"), F.col("r").alias("ref"), F.col("rs").alias("ref_start"), F.col("rg").alias("ref_gap"))
        fills = scratch.keep(fills.where("state <> 'beside'").unionByName(j.select(fills.columns)), "beside")
    rows = fills.select(*_KEY, "score", "end", F.col("ref").alias("parent"), F.col("ref_start").alias("parent_start"), F.col("ref_gap").alias("parent_gap"), F.lit(1).cast("long").alias("depth"), "ref", "ref_start")
    while not rows.where("ref IS NOT NULL").isEmpty():
        to = rows.select("t_name", *as_ref, F.col("depth").alias("d"), F.col("ref").alias("r"), F.col("ref_start").alias("rs"))
        j = rows.where("ref IS NOT NULL").join(to, ["t_name", "ref", "ref_start"]).select(*_KEY, "score", "end", "parent", "parent_start", "parent_gap", (F.col("depth") + F.col("d")).alias("depth"), F.col("r").alias("ref"), F.col("rs").alias("ref_start"))
        rows = scratch.keep(rows.where("ref IS NULL").unionByName(j), "depth")
    return rows.drop("ref", "ref_start")


def net_levels(blocks: DataFrame, width: int = 1 << 20) -> DataFrame:
    """(t_name, level, parent, parent_start, parent_gap, id, kind, start, end) from blocks (t_name, id, score, start, end).

    Fills have odd levels from 1, gaps the even level below their fill's. parent is the chain in whose gap
    a fill lies (null at the top) or whose gap it is; parent_start tells which of that chain's fills,
    parent_gap where the gap begins. Blocks of no length count for nothing; a chain has one score.
    """
    scratch = Scratch(blocks.sparkSession, "net")
    swept = scratch.keep(owned(blocks, width), "pieces")
    rows = scratch.keep(closed(swept, scratch.keep(carried(swept), "edges")), "closed")
    fills = placed(rows.where("state <> 'gap'"), scratch)
    gaps = rows.where("state = 'gap'").select("t_name", "id", F.col("ref_start").alias("parent_start"), "start", "end")
    depths = fills.select("t_name", "id", F.col("start").alias("parent_start"), "depth")
    upper = fills.select("t_name", (2 * F.col("depth") - 1).alias("level"), "parent", "parent_start", "parent_gap", "id", F.lit("fill").alias("kind"), "start", "end")
    lower = gaps.join(depths, ["t_name", "id", "parent_start"]).select("t_name", (2 * F.col("depth")).alias("level"), F.col("id").alias("parent"), "parent_start", F.col("start").alias("parent_gap"), "id", F.lit("gap").alias("kind"), "start", "end")
    return upper.unionByName(lower)
