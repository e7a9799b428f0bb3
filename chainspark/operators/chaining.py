"""Chains of colinear blocks.

The score of a block as a chain's last one is its own plus the best of its predecessors' scores less
the cost of the gap between; a predecessor ends before it on both axes. Blocks of one (target, query,
strand) whose target distance exceeds `max_gap` never chain, so groups fall apart into islands there.
They are told apart by bins of the target axis: the end that earlier bins reach is a running maximum over
bins, and a window sees the blocks of one bin only.

Predecessors are searched in a k-d tree over block ends, each node with the best score below it: a
branch is left alone where that score less the least cost of the distance can't win, so a block looks at
few others however crowded its island is. In islands of up to `DENSE` blocks each block is compared with all
before it instead, the n-th blocks of many islands at once. A task takes small islands from a sorted stream. Islands of more than `TILE_BLOCKS` blocks are cut into tiles of the target axis instead: tile by
tile, scores go forward with the blocks that a later tile can still reach, as tables, and then each block's
best end comes back the same way. So no task holds more than a tile and its reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.gaps import gap_cost_value, least_cost
from ..functions.groups import firsts, whole_groups
from ..scratch import Scratch

GROUP = ["t_name", "q_name", "q_strand"]


def islands(blocks: DataFrame, max_gap: int) -> DataFrame:
    """`blocks` with `island`: numbered within the group wherever the target gap exceeds `max_gap`."""
    end, keys = F.col("t") + F.col("size"), [*GROUP, "_bin"]
    rows = blocks.withColumn("_bin", F.floor(F.col("t") / F.lit(float(max(max_gap, 1)))).cast("long"))
    earlier = Window.partitionBy(*GROUP).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # a row a bin
    reached = rows.groupBy(*keys).agg(F.max(end).alias("_end")).select(*keys, F.max("_end").over(earlier).alias("_reached"))
    inside = Window.partitionBy(*keys).orderBy("t", "q", "aid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(reached, keys).withColumn("_far", F.greatest("_reached", F.max(end).over(inside)))
    rows = rows.withColumn("_new", F.coalesce((F.col("t") - F.col("_far") > max_gap).cast("long"), F.lit(0)))
    before = rows.groupBy(*keys).agg(F.sum("_new").alias("_n")).select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    upto = Window.partitionBy(*keys).orderBy("t", "q", "aid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(before, keys).withColumn("island", F.col("_before") + F.sum("_new").over(upto)).select(*blocks.columns, "island")


#: Blocks of an island that one task takes, and of a tile of a larger one.
TILE_BLOCKS = 200_000
#: Blocks of a leaf of the tree.
LEAF = 64
#: Blocks of an island that are all compared with one another, and cells of the arrays in which islands lie side by side.
DENSE, CELLS = 1024, 1 << 18
_NONE = -(2**62)


class Tree:
    """Block ends as a k-d tree; of each node the box of its ends, its first block and the best score known below."""

    def __init__(self, end_t: np.ndarray, end_q: np.ndarray):
        self.end = (end_t, end_q)
        self.members: list[np.ndarray | None] = []
        self.box: list[tuple[int, int, int, int, int]] = []
        self.kids: list[tuple[int, int] | None] = []
        self.up: list[int] = []
        self.best: list[int] = []
        self.leaf = np.zeros(len(end_t), dtype=np.int64)
        todo = [(np.arange(len(end_t)), -1, 0)]
        while todo:
            own, parent, axis = todo.pop()
            n = len(self.box)
            t, q = end_t[own], end_q[own]
            self.box.append((int(t.min()), int(t.max()), int(q.min()), int(q.max()), int(own.min())) if len(own) else (0, 0, 0, 0, 0))
            self.up.append(parent)
            self.best.append(_NONE)
            self.kids.append(None)
            self.members.append(None)
            if parent >= 0:
                self.kids[parent] = (n,) if self.kids[parent] is None else (*self.kids[parent], n)
            if len(own) > LEAF:
                half = np.argpartition(self.end[axis][own], len(own) // 2)
                todo += [(own[half[: len(own) // 2]], n, 1 - axis), (own[half[len(own) // 2 :]], n, 1 - axis)]
            else:
                self.members[n] = np.sort(own)
                self.leaf[own] = n

    def know(self, i: int, score: int) -> None:
        n = int(self.leaf[i])
        while n >= 0 and self.best[n] < score:
            self.best[n] = score
            n = self.up[n]


def best_links(t: np.ndarray, q: np.ndarray, size: np.ndarray, weight: np.ndarray, table: str, max_gap: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score of each block as a chain's end, its best predecessor or -1, what that brings), blocks sorted by t.

    known: scores of the first blocks, which are only predecessors. Of equal predecessors the first counts.
    """
    n, done = len(t), 0 if known is None else len(known)
    total, back, carried = np.full(n, _NONE), np.full(n, -1), np.zeros(n, dtype=np.int64)
    end_t, end_q = t + size, q + size
    tree, least = Tree(end_t, end_q), least_cost(table)
    for i in range(done):
        total[i] = known[i]
        tree.know(i, int(known[i]))
    for j in range(done, n):
        tj, qj, gain, at = int(t[j]), int(q[j]), 0, -1
        stack = [0]
        while stack:
            k = stack.pop()
            t_lo, t_hi, q_lo, q_hi, first = tree.box[k]
            if t_lo > tj or q_lo > qj or tj - t_hi > max_gap or tree.best[k] == _NONE:
                continue
            bound = tree.best[k] - least(tj - t_hi, qj - q_hi)
            if bound < gain or bound <= 0 or bound == gain and first > at >= 0:
                continue
            i = tree.members[k]
            if i is None:
                stack += sorted(tree.kids[k], key=lambda x: tree.best[x] - least(tj - tree.box[x][1], qj - tree.box[x][3]))
                continue
            i = i[(end_t[i] <= tj) & (end_q[i] <= qj) & (tj - end_t[i] <= max_gap) & (total[i] > _NONE)]
            if len(i):
                own = total[i] - gap_cost_value(tj - end_t[i], qj - end_q[i], table)
                m = int(own.argmax())
                if own[m] > gain or own[m] == gain and at > int(i[m]):
                    gain, at = int(own[m]), int(i[m])
        back[j], carried[j], total[j] = at, gain, int(weight[j]) + gain
        tree.know(j, int(total[j]))
    return total, back, carried


def dense_links(t: np.ndarray, q: np.ndarray, size: np.ndarray, weight: np.ndarray, first: np.ndarray, count: np.ndarray, table: str, max_gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `best_links`, for the islands of `count` blocks from `first` on at once; the other blocks' results mean nothing."""
    total, back, carried = np.full(len(t), _NONE), np.full(len(t), -1), np.zeros(len(t), dtype=np.int64)
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    at = 0
    while at < len(first):
        most = int(count[at])
        some = slice(at, at + max(1, CELLS // most))
        n = count[some]
        at += len(n)
        place = np.minimum(first[some][:, None] + np.arange(most), len(t) - 1)
        own_t, own_q = t[place], q[place]
        end_t, end_q = own_t + size[place], own_q + size[place]
        score = np.full(place.shape, _NONE)
        for j in range(most):
            k = int(np.searchsorted(-n, -j, side="left"))  # islands with a block j
            here, gain = place[:k, j], np.zeros(k, dtype=np.int64)
            if j:
                dt, dq = own_t[:k, j, None] - end_t[:k, :j], own_q[:k, j, None] - end_q[:k, :j]
                row, col = np.nonzero((dt >= 0) & (dq >= 0) & (dt <= max_gap))
                links = np.full(dt.shape, _NONE)
                links[row, col] = score[row, col] - gap_cost_value(dt[row, col], dq[row, col], table)
                best = links.argmax(axis=1)
                gain = np.maximum(links[np.arange(k), best], 0)
                back[here] = np.where(gain > 0, place[np.arange(k), best], -1)
            score[:k, j] = weight[here] + gain
            total[here], carried[here] = score[:k, j], gain
    return total, back, carried


def best_chains(t: np.ndarray, q: np.ndarray, size: np.ndarray, weight: np.ndarray, table: str, max_gap: int, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(chain number of each block, score of each chain): blocks of islands that begin at `first`, each sorted by t; chains of an island are taken best first.

    Every block has one best predecessor; a chain follows them back from the best free end until it
    meets a block that is taken. Numbers run on from island to island.
    """
    first = np.zeros(min(len(t), 1), dtype=np.int64) if first is None else first
    count = np.diff(np.append(first, len(t)))
    small = count <= DENSE
    total, back, carried = dense_links(t, q, size, weight, first[small], count[small], table, max_gap)
    for i, n in zip(first[~small].tolist(), count[~small].tolist(), strict=True):
        one = slice(i, i + n)
        total[one], before, carried[one] = best_links(t[one], q[one], size[one], weight[one], table, max_gap)
        back[one] = np.where(before >= 0, before + i, -1)
    chain, ends, bottoms, link = [-1] * len(t), [], [], back.tolist()
    for j in np.lexsort((-total, np.repeat(np.arange(len(first)), count))).tolist():
        if chain[j] >= 0:
            continue
        k = bottom = j
        while k >= 0 and chain[k] < 0:
            chain[k] = len(ends)
            bottom, k = k, link[k]
        ends.append(j)
        bottoms.append(bottom)
    score = total[np.array(ends, dtype=np.int64)] - carried[np.array(bottoms, dtype=np.int64)]  # what lies before a taken block counts there
    return np.array(chain, dtype=np.int64), score


def chained(blocks: DataFrame, min_score: int = 1000, table: str = "loose", max_gap: int = 100_000, per_base: int = 91) -> DataFrame:
    """(t_name, q_name, q_strand, chain, score, n_blocks, t_start, t_end, q_start, q_end, members).

    blocks: (t_name, q_name, q_strand, aid, t, q, size) and, where known, `weight`, a block's own score.
    """
    scratch = Scratch(blocks.sparkSession, "chaining")
    rows = islands(blocks, max_gap)
    if "weight" not in rows.columns:
        rows = rows.withColumn("weight", F.col("size") * per_base)
    rows = scratch.keep(rows, "islands")
    large = scratch.keep(rows.groupBy(*GROUP, "island").agg(F.count("*").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1")).where(F.col("n") > TILE_BLOCKS), "large")
    key = [*GROUP, "island"]
    crowded = None if large.isEmpty() else tiled(rows.join(large, key), table, max_gap, scratch).where(F.col("score") >= min_score)
    rows = rows.join(large, key, "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, key):
            first = firsts(rows, key)
            t, q, size, weight, aid = (rows[c].to_numpy() for c in ("t", "q", "size", "weight", "aid"))
            island = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(t))))
            order = np.lexsort((aid, q, t, island))
            t, q, size, weight, aid = (x[order] for x in (t, q, size, weight, aid))
            chain, score = best_chains(t, q, size, weight, table, max_gap, first)
            order = np.argsort(chain, kind="stable")
            begin = np.flatnonzero(np.append(True, np.diff(chain[order]) > 0))
            head = island[order][begin]
            pick = lambda f, x: f.reduceat(x[order], begin)
            out = {c: rows[c].take(first[head]) for c in key}
            out["chain"] = np.arange(len(score)) - np.searchsorted(head, head)
            out |= {"score": score, "n_blocks": np.diff(np.append(begin, len(t)))}
            out |= {"t_start": pick(np.minimum, t), "t_end": pick(np.maximum, t + size), "q_start": pick(np.minimum, q), "q_end": pick(np.maximum, q + size)}
            out["members"] = pa.LargeListArray.from_arrays(np.append(begin, len(t)), aid[order]).cast(pa.list_(pa.int64()))
            yield from pa.table(out).filter(pa.array(score >= min_score)).to_batches()

    ddl = "t_name string, q_name string, q_strand string, island long, chain long, score long, n_blocks long, t_start long, t_end long, q_start long, q_end long, members array<long>"
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    small = rows.select(*key, "aid", "t", "q", "size", F.col("weight").cast("long").alias("weight")).repartition(tasks, *key).sortWithinPartitions(*key).mapInArrow(run, ddl)
    return small if crowded is None else small.unionByName(crowded)


# --- islands in tiles --------------------------------------------------------------------------------

_NODE = "t_name string, q_name string, q_strand string, island long, aid long, t long, q long, size long, tile long, total long, carried long, back long, back_tile long"
_BEST = "t_name string, q_name string, q_strand string, island long, kind string, tile long, aid long, t long, q long, size long, carried long, end_total long, end_t long, end_q long, end_aid long"


def tiled(rows: DataFrame, table: str, max_gap: int, scratch: Scratch) -> DataFrame:
    """The chains of crowded islands, as `chained` returns them; rows: blocks with their island's n, t0 and t1."""
    key = [*GROUP, "island"]
    # tiles of about TILE_BLOCKS blocks, and never under max_gap, so that a tile reaches few others
    width = F.greatest(F.lit(max_gap), F.ceil((F.col("t1") - F.col("t0") + 1) * TILE_BLOCKS / F.col("n"))).cast("long")
    rows = scratch.keep(rows.withColumn("width", width).withColumn("tile", F.floor((F.col("t") - F.col("t0")) / F.col("width")).cast("long")), "tiles")
    last = int(rows.agg(F.max("tile")).first()[0])

    def forward(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "q", "aid"], ignore_index=True)
        pdf = pd.concat([pdf[pdf["known"].notna()], pdf[pdf["known"].isna()]], ignore_index=True)
        known = pdf["known"].dropna().to_numpy().astype(np.int64)
        t, q, size, aid = (pdf[c].to_numpy() for c in ("t", "q", "size", "aid"))
        total, back, carried = best_links(t, q, size, pdf["weight"].to_numpy(), table, max_gap, known)
        out = pdf[[*key, "aid", "t", "q", "size", "tile"]].assign(total=total, carried=carried)
        out["back"] = pd.array(np.where(back >= 0, aid[back], 0), dtype="Int64")
        out["back_tile"] = pd.array(np.where(back >= 0, pdf["tile"].to_numpy()[back], -1), dtype="Int64")
        out.loc[out["back_tile"] < 0, ["back", "back_tile"]] = pd.NA
        return out.iloc[len(known) :]

    done: list[DataFrame] = []
    for k in range(last + 1):
        now = rows.where(F.col("tile") == k).select(*key, "aid", "t", "q", "size", "weight", "tile", F.lit(None).cast("long").alias("known"))
        for before in reversed(done):  # a tile is max_gap wide at least: only long blocks reach beyond the next one
            starts = rows.where(F.col("tile") == k).select(*key, (F.col("t0") + k * F.col("width")).alias("begin")).distinct()
            reach = before.join(starts, key).where(F.col("t") + F.col("size") >= F.col("begin") - max_gap)
            now = now.unionByName(reach.select(*key, "aid", "t", "q", "size", F.lit(0).cast("long").alias("weight"), "tile", F.col("total").alias("known")))
            if before is not done[-1] and reach.isEmpty():
                break
        done.append(scratch.keep(now.groupBy(*key).applyInPandas(forward, _NODE), f"forward{k}"))

    def backward(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of each block the best end of a chain through it, and what blocks of earlier tiles are told of it."""
        told = pdf[pdf["kind"] == "told"]
        own = pdf[pdf["kind"] == "node"].sort_values(["t", "q", "aid"], ignore_index=True)
        place = {a: i for i, a in enumerate(own["aid"].tolist())}
        rank = lambda total, t, q, aid: (-total, t, q, aid)
        best = [rank(*x) for x in own[["total", "t", "q", "aid"]].itertuples(index=False, name=None)]
        for target, *end in told[["aid", "end_total", "end_t", "end_q", "end_aid"]].astype("int64").itertuples(index=False, name=None):
            best[place[target]] = min(best[place[target]], rank(*end))
        out, head = [], tuple(pdf[key].iloc[0])
        nodes = list(own[["tile", "aid", "t", "q", "size", "carried"]].astype("int64").itertuples(index=False, name=None))
        links = list(zip(own["back"].fillna(-1).astype("int64").tolist(), own["back_tile"].fillna(-1).astype("int64").tolist(), strict=True))
        for i in range(len(own) - 1, -1, -1):  # whatever a block precedes comes behind it
            total, *end = best[i]
            out.append((*head, "node", *nodes[i], -total, *end))
            to, tile = links[i]
            if tile < 0:
                continue
            if to in place:
                best[place[to]] = min(best[place[to]], best[i])
            else:
                out.append((*head, "told", tile, to, 0, 0, 0, 0, -total, *end))
        return pd.DataFrame(out, columns=[x.split()[0] for x in _BEST.split(", ")])

    told, nodes = None, None
    for k in range(last, -1, -1):
        now = done[k].select(*key, F.lit("node").alias("kind"), "tile", "aid", "t", "q", "size", "carried", "total", "back", "back_tile", *[F.lit(None).cast("long").alias(c) for c in ("end_total", "end_t", "end_q", "end_aid")])
        if told is not None:
            mine = told.where(F.col("tile") == k)
            now = now.unionByName(mine.select(*key, "kind", "tile", "aid", "t", "q", "size", "carried", *[F.lit(None).cast("long").alias(c) for c in ("total", "back", "back_tile")], "end_total", "end_t", "end_q", "end_aid"))
        got = scratch.keep(now.groupBy(*key).applyInPandas(backward, _BEST), f"backward{k}")
        nodes = got.where("kind = 'node'") if nodes is None else nodes.union(got.where("kind = 'node'"))
        sent = got.where("kind = 'told'")
        told = sent if told is None else told.where(F.col("tile") < k).union(sent)
    by = [*key, "end_total", "end_t", "end_q", "end_aid"]
    place = F.struct("t", "q", "aid")
    members = F.transform(F.sort_array(F.collect_list(place)), lambda x: x["aid"])
    ends = (F.col("t") + F.col("size")), (F.col("q") + F.col("size"))
    out = nodes.groupBy(*by).agg(F.min_by("carried", place).alias("lost"), F.count("*").alias("n_blocks"), F.min("t").alias("t_start"), F.max(ends[0]).alias("t_end"), F.min("q").alias("q_start"), F.max(ends[1]).alias("q_end"), members.alias("members"))
    w = Window.partitionBy(*key).orderBy(F.desc("end_total"), "end_t", "end_q", "end_aid")
    return out.select(*key, (F.row_number().over(w) - 1).cast("long").alias("chain"), (F.col("end_total") - F.col("lost")).alias("score"), "n_blocks", "t_start", "t_end", "q_start", "q_end", "members")
