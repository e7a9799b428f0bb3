"""The hierarchical net and cleaning on it, against plain versions."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chainspark.functions import groups, ordering
from chainspark.functions.gaps import gap_cost_value
from chainspark.operators import align, chaining, cleaning, netlevels, nets

BLOCKS = "t_name string, id string, score long, start long, end long"


def plain_net(blocks):
    """Chains one after another, best first, each over the list of free spaces."""
    out = []
    for t in {b[0] for b in blocks}:
        chains = {}
        for _, i, score, lo, hi in (b for b in blocks if b[0] == t and b[4] > b[3]):
            chains.setdefault((-score, i), []).append((lo, hi))
        spaces = [(-(10**9), 10**9, None, None, 0)]  # free from, to, in a gap of which fill, its depth
        for (_, i), own in sorted(chains.items()):
            nxt = []
            for lo, hi, parent, at, depth in spaces:
                inside = sorted((max(lo, a), min(hi, b)) for a, b in own if max(lo, a) < min(hi, b))
                if not inside:
                    nxt.append((lo, hi, parent, at, depth))
                    continue
                first, last = inside[0][0], max(b for _, b in inside)
                out.append((t, 2 * depth + 1, parent, at, i, "fill", first, last))
                nxt += [(x, y, parent, at, depth) for x, y in ((lo, first), (last, hi)) if x < y]
                reach = inside[0][1]
                for a, b in inside[1:]:
                    if a > reach:
                        out.append((t, 2 * depth + 2, i, first, i, "gap", reach, a))
                        nxt.append((reach, a, i, first, depth + 1))
                    reach = max(reach, b)
            spaces = nxt
    return out


def random_blocks(rng, chains, span, most=15):
    out = []
    for c in range(chains):
        p, score = rng.randrange(0, span), rng.randrange(1, most)
        for _ in range(rng.randrange(1, 8)):
            n = rng.randrange(0, 12)
            out.append((f"t{c % 2}", f"c{c}", score, p, p + n))
            p += n + rng.choice([0, rng.randrange(0, 60)])
    return out


@pytest.mark.parametrize(("seed", "width"), [(0, 16), (1, 64), (2, 100_000)])
def test_net_against_claims_one_by_one(spark, seed, width):
    """Equal scores, blocks of no length, blocks over bin edges, gaps that several better chains bound."""
    blocks = random_blocks(random.Random(seed), 60, 500)
    got = netlevels.net_levels(spark.createDataFrame(blocks, BLOCKS), width)
    assert sorted(map(tuple, got.drop("parent_gap").collect()), key=str) == sorted(plain_net(blocks), key=str)
    for r in got.where("parent IS NOT NULL").collect():  # where the gap begins that holds a fill
        gap = [x for x in plain_net(blocks) if x[5] == "gap" and (x[0], x[4], x[3], x[6]) == (r.t_name, r.parent, r.parent_start, r.parent_gap)]
        assert len(gap) == 1 and gap[0][6] <= r.start and r.end <= gap[0][7]


def test_net_of_stairs_and_of_nothing(spark):
    """A stair of ever better chains, each of which closes the one before: pointers as long as the stair."""
    blocks = [("t", f"c{k:03}", k + 1, 10 * k, 10 * k + 12) for k in range(90)] + [("t", "under", 0, 5, 6), ("t", "under", 0, 3000, 3001)]
    got = netlevels.net_levels(spark.createDataFrame(blocks, BLOCKS), 64)
    assert sorted(map(tuple, got.drop("parent_gap").collect()), key=str) == sorted(plain_net(blocks), key=str)
    assert netlevels.net_levels(spark.createDataFrame([], BLOCKS)).count() == 0


def disjoint(rng, n):
    p, out = 0, []
    for _ in range(n):
        p += rng.choice([0, 1, 5, 30])
        size = rng.randrange(1, 40)
        out.append((p, p + size))
        p += size
    return out


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_of_disjoint_ranges(spark, seed):
    rng = random.Random(seed)
    a, b = ([(k, i, *x) for k in "xy" for i, x in enumerate(disjoint(rng, 40))] for _ in range(2))
    frames = [spark.createDataFrame(x, "k string, n long, start long, end long") for x in (a, b)]
    got = sorted((r.k, r.a.n, r.b.n) for r in cleaning.overlaps(*frames, ["k"]).collect())
    assert got == sorted((x[0], x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] and y[2] < x[3])


@pytest.mark.parametrize("seed", range(3))
def test_cut_out_base_by_base(spark, seed):
    rng = random.Random(seed)
    blocks, cuts = [], []
    for c in range(6):
        blocks += [("t", f"c{c}", lo, hi, 7 * c + lo + 3 * k) for k, (lo, hi) in enumerate(disjoint(rng, 20))]
        cuts += [("t", f"c{c}", lo, hi) for lo, hi in disjoint(rng, 12) if rng.random() < 0.5 and c % 3]
    got = cleaning.cut_out(spark.createDataFrame(blocks, "t_name string, id string, start long, end long, q long"), spark.createDataFrame(cuts, "t_name string, id string, start long, end long")).collect()
    bases = sorted((r.id, r.part, r.start + k, r.q + k) for r in got for k in range(r.end - r.start))
    want = []
    for _, i, lo, hi, q in blocks:
        own = [(s, e) for _, c, s, e in cuts if c == i]
        want += [(i, sum(s <= x for s, _ in own), x, q + x - lo) for x in range(lo, hi) if not any(s <= x < e for s, e in own)]
    assert bases == sorted(want)


def test_only_the_piece_that_breaks_a_chain_is_cut(spark):
    """A suspect whose first block lies in a better chain's gap, and whose others stand alone behind it."""
    rows = [  # t_name, id, score, i, start, end, q, dt, dq
        ("t", "broken", 200_000, 0, 0, 5_000, 0, 2_000, 100), ("t", "broken", 200_000, 1, 7_000, 12_000, 5_100, 0, 0),
        ("t", "partly", 30_000, 0, 6_000, 6_050, 90_000, 9_000, 9_000), ("t", "partly", 30_000, 1, 15_050, 15_300, 99_050, 50, 60), ("t", "partly", 30_000, 2, 15_350, 15_600, 99_360, 0, 0),
        ("t", "strong", 150_000, 0, 5_100, 5_900, 40_000, 0, 0),
    ]
    blocks = spark.createDataFrame(rows, "t_name string, id string, score long, i long, start long, end long, q long, dt long, dq long")
    heads = blocks.select("id", "score").distinct()
    flanks = spark.createDataFrame([("broken", 5_000, 455_000, 455_000), ("partly", 6_050, 4_550, 45_000)], "id string, t_from long, left long, right long")
    net = netlevels.net_levels(blocks)
    every = cleaning.breaking_pieces(net, blocks, flanks, heads)
    found = cleaning.falling_pieces(every, 10.0)
    assert sorted((r.id, r.start, r.end, r.breaks, r.score) for r in every.collect()) == [("partly", 6_000, 6_050, "broken", 50 * 91), ("strong", 5_100, 5_900, "broken", 800 * 91)]
    assert [r.id for r in found.collect()] == ["partly"]
    left = sorted((r.id, r.part, r.start, r.end) for r in cleaning.cut_out(blocks, found).collect())
    assert left == [("broken", 0, 0, 5_000), ("broken", 0, 7_000, 12_000), ("partly", 1, 15_050, 15_300), ("partly", 1, 15_350, 15_600), ("strong", 0, 5_100, 5_900)]
    # a pair falls by its outer flanks: the first by its left one, the second by its right one
    pair = spark.createDataFrame([("t", "a", 10, 20, "x", 5, 20.0, 1.0), ("t", "b", 30, 40, "x", 5, 1.0, 20.0), ("t", "c", 90_000, 90_010, "x", 5, 1.0, 20.0)], every.schema)
    assert sorted(r.id for r in cleaning.falling_pairs(pair).collect()) == ["a", "b"]


def test_scores_of_pieces_with_gaps(spark):
    blocks = spark.createDataFrame([("t", "c", i, lo, hi, dt, dq) for i, (lo, hi, dt, dq) in enumerate([(0, 10, 5, 7), (15, 30, 0, 9), (30, 40, 100, 3), (140, 150, 0, 0)])], "t_name string, id string, i long, start long, end long, dt long, dq long")
    fills = spark.createDataFrame([("t", "c", 4, 35, "x"), ("t", "c", 38, 39, "y"), ("t", "c", 140, 150, "z")], "t_name string, id string, start long, end long, tag string")
    got = {r.tag: r.score for r in cleaning.piece_scores(fills, blocks).collect()}
    cost = lambda dt, dq: int(gap_cost_value(dt, dq, "loose"))
    assert got == {"x": 26 * 91 - cost(5, 7) - cost(0, 9), "y": 91, "z": 910}


# --- chaining in crowded islands ---


def plain_links(rows, max_gap, table="loose"):
    """(total, back, carried) of blocks (t, q, size, weight) in order, every pair looked at."""
    total, back, carried = [], [], []
    for j, (t, q, _, weight) in enumerate(rows):
        best, at = 0, -1
        for i in range(j):
            dt, dq = t - rows[i][0] - rows[i][2], q - rows[i][1] - rows[i][2]
            if 0 <= dt <= max_gap and dq >= 0 and (gain := total[i] - int(gap_cost_value(dt, dq, table))) > best:
                best, at = gain, i
        total.append(weight + best)
        back.append(at)
        carried.append(best)
    return total, back, carried


@pytest.mark.parametrize("seed", range(4))
def test_links_of_the_tree_are_those_of_all_pairs(seed, monkeypatch):
    monkeypatch.setattr(chaining, "LEAF", 4)
    rng = random.Random(seed)
    rows = sorted((rng.randrange(0, 900), rng.randrange(0, 900), rng.randrange(1, 30), rng.choice([500, 900, 2000])) for _ in range(250))
    rows += [rows[-1]] * 3  # equal blocks
    want = plain_links(rows, 200)
    t, q, size, weight = np.array(rows).T
    got = chaining.best_links(t, q, size, weight, "loose", 200)
    assert [x.tolist() for x in got] == list(want)
    half = chaining.best_links(t, q, size, weight, "loose", 200, np.array(want[0][:100]))
    assert half[0].tolist() == want[0] and half[1].tolist()[100:] == want[1][100:]


def test_an_island_in_tiles_is_an_island(spark, monkeypatch):
    """The same chains, members and numbers, whether an island is one task's or goes through many tiles."""
    rng = random.Random(9)
    rows = [(k, "t", "q", rng.choice("+-"), t := rng.randrange(0, 9000), max(0, t + rng.randrange(-300, 300)), rng.choice([10, 20, 40, 900 if k % 40 == 0 else 30])) for k in range(700)]
    rows += [(2000 + k, "u", "q", "+", 10 * k, 11 * k, 5) for k in range(20)]
    df = spark.createDataFrame(rows, "aid long, t_name string, q_name string, q_strand string, t long, q long, size long")
    key = lambda r: tuple(map(str, r))
    whole = sorted(map(tuple, chaining.chained(df, 1000, "loose", 400).collect()), key=key)
    monkeypatch.setattr(chaining, "TILE_BLOCKS", 60)
    parts = sorted(map(tuple, chaining.chained(df, 1000, "loose", 400).collect()), key=key)
    assert parts == whole and max(r[6] for r in whole) > 60


def test_a_crowded_island_is_not_quadratic():
    """Twice the blocks in one island take about twice the time."""
    rng = np.random.default_rng(3)
    took = []
    for n in (4000, 16000):
        t = np.sort(rng.integers(0, 50_000, n))
        q = np.maximum(0, t + rng.integers(-20_000, 20_000, n))
        size = rng.integers(5, 40, n)
        began = time.process_time()
        chaining.best_links(t, q, size, size * 91, "loose", 100_000)
        took.append(time.process_time() - began)
    assert took[1] < 9 * took[0]


def test_bins_swept_at_once_are_as_each_alone():
    rng = np.random.default_rng(4)
    n = 3000
    lo, bins = rng.integers(0, 90, n), np.sort(rng.integers(0, 200, n))
    rows = pa.table({"t_name": ["x"] * n, "bin": bins, "id": [str(i) for i in rng.integers(0, 400, n)], "score": rng.integers(0, 9, n), "lo": bins * 100 + lo, "hi": bins * 100 + np.minimum(lo + rng.integers(1, 40, n), 100)})
    row, start, end = nets.envelopes(rows, ["t_name", "bin"], 100)
    got = {(int(p), rows["id"][int(r)].as_py()) for r, a, b in zip(row, start, end, strict=True) for p in range(a, b)}
    best: dict[int, tuple] = {}
    for r in rows.to_pylist():
        for p in range(r["lo"], r["hi"]):
            best[p] = min(best.get(p, (1, "")), (-r["score"], r["id"]))
    assert got == {(p, b[1]) for p, b in best.items()}


def test_groups_of_any_size_come_whole():
    rows = pa.table({"k": [1] * 5 + [2] + [None] * 7 + [3, 4, 4], "x": range(16)})
    for size in (1, 2, 3, 5, 16):
        parts = list(groups.whole_groups(rows.to_batches(max_chunksize=size), ["k"]))
        assert pa.concat_tables(parts).equals(rows)
        keys = [set(p["k"].to_pylist()) for p in parts]
        assert all(not a & b for i, a in enumerate(keys) for b in keys[:i])


@pytest.mark.parametrize("seed", range(6))
def test_small_islands_side_by_side_chain_as_by_the_tree(monkeypatch, seed):
    rng = np.random.default_rng(seed)
    count = rng.integers(1, 60, 20)
    first = np.cumsum(count) - count
    island, span = np.repeat(np.arange(20), count), int(rng.choice([20, 300, 3000]))
    t, q, size = rng.integers(0, span, len(island)), rng.integers(0, span, len(island)), rng.integers(1, 30, len(island))
    order = np.lexsort((q, t, island))
    args = (t[order], q[order], size[order], size[order] * 91, "loose", 500, first)
    dense = chaining.best_chains(*args)
    monkeypatch.setattr(chaining, "CELLS", 100)
    monkeypatch.setattr(chaining, "DENSE", 10)
    tree = chaining.best_chains(*args)
    assert (dense[0] == tree[0]).all() and (dense[1] == tree[1]).all()


def test_places_in_an_order_shuffle_rows_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = ordering.ranked(spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")), [F.col("x")])
        assert [tuple(r) for r in got.orderBy("x").collect()] == [(i, i) for i in range(1000)]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BroadcastHashJoin") >= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("seed", range(4))
def test_equal_stretches_align_without_a_table(monkeypatch, seed):
    rng = random.Random(seed)
    matrix = align.score_matrix(align.DEFAULT)
    cases = []
    for _ in range(60):
        a = align.codes("".join(rng.choice(rng.choice(["ACGT", "AC", "ACGTN"])) for _ in range(rng.randint(0, 40))))
        b = np.concatenate([a[: rng.randint(0, len(a))], align.codes("".join(rng.choice("ACGT") for _ in range(rng.choice([0, 0, 5, 60]))))])
        cases += [(a, b, rng.choice([0, 300, 9400])), (b, a, 9400)]
    got = [align._stretch(*c, align.DEFAULT, matrix) for c in cases]
    assert sum(align._same(a, b, 400, 30, matrix) > 0 for a, b, _ in cases) > 20
    monkeypatch.setattr(align, "_same", lambda *_: 0)
    assert got == [align._stretch(*c, align.DEFAULT, matrix) for c in cases]


@pytest.mark.parametrize("seed", [1, 2])
def test_suspects_in_blocks_are_those_of_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(nets, "BLOCK", 3)
    rng = random.Random(seed)
    lines = [(str(k % 90), rng.choice("xy"), at := rng.randrange(-40, 400), at + rng.randrange(0, 9), rng.randrange(1, 60)) for k in range(120)]
    lines += lines[:20]  # equal rows count once
    gaps = [(f"g{k}", rng.choice("xy"), rng.randrange(20, 90), at := rng.randrange(-60, 400), at + rng.choice([0, 5, 40, 300]), rng.randrange(200), rng.randrange(200)) for k in range(60)]
    want = sorted((c[0], g[0], g[5] / c[4], g[6] / c[4]) for c in set(lines) for g in gaps if c[1] == g[1] and c[4] < g[2] and g[2] >= 30 and c[4] <= 50 and c[2] >= g[3] and c[3] <= g[4])
    chains = spark.createDataFrame(lines, "id string, t_name string, t_start long, t_end long, score long")
    found = nets.breaking(chains, spark.createDataFrame(gaps, "id string, t_name string, score long, start long, end long, left long, right long"), 50, 30, 64)
    assert sorted(map(tuple, found.collect())) == want and len(want) > 100


def test_chains_of_orders_are_shuffled_once(spark, tmp_path):
    """Gaps of the orders' chains with their scores: lines go to their order, and to no second place."""
    from chainspark.operators import chains
    from chainspark.plans import adapters

    spark.createDataFrame([(1, 2, 3, 1, 4.0, 5.0)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    b = adapters.blocks(spark, str(tmp_path))
    for df in (chains.offsets(b), chains.scores(b), nets.scored_flanks(b)):
        assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_blocks_are_swept_before_they_are_shuffled(spark):
    """A thousand chains on one place: what reaches the shuffle is what is best in its part, not every block."""
    blocks = spark.range(0, 4000, 1, 4).selectExpr("'t' AS t_name", "string(id) AS id", "id AS score", "0L AS bin", "id % 5 AS lo", "id % 5 + 20 AS hi")
    assert netlevels.swept_pieces(blocks, 64, 64).count() <= 4 * 9
    best = netlevels.owned(blocks.select("t_name", "id", "score", blocks.lo.alias("start"), blocks.hi.alias("end")), 64).where("kind = 'piece'").orderBy("start").collect()
    assert [(r.id, r.start, r.end) for r in best] == [("3995", 0, 1), ("3996", 1, 2), ("3997", 2, 3), ("3998", 3, 4), ("3999", 4, 24)]


def test_chains_without_cuts_take_no_part_in_the_merge(spark, monkeypatch):
    merged, overlaps = [], cleaning.overlaps
    monkeypatch.setattr(cleaning, "overlaps", lambda a, b, by: merged.append(a.count()) or overlaps(a, b, by))
    blocks = spark.createDataFrame([("t", str(k), 10 * i, 10 * i + 9, 0) for k in range(50) for i in range(4)], "t_name string, id string, start long, end long, q long")
    left = cleaning.cut_out(blocks, spark.createDataFrame([("t", "7", 12, 15)], "t_name string, id string, start long, end long"))
    assert merged == [4] and left.count() == 201
    kept = left.where("id = '7'").orderBy("start").collect()
    assert [(r.part, r.start, r.end) for r in kept] == [(0, 0, 9), (0, 10, 12), (1, 15, 19), (1, 20, 29), (1, 30, 39)]


def test_a_chain_meets_a_tile_once(spark):
    """Counts over tiles and chunks are those base by base, and no block is a row where tiles are met."""
    from chainspark.operators import antirepeat

    rng = random.Random(5)
    seq = "".join(rng.choice("ACGTacgtnN") for _ in range(9000))
    genome = spark.createDataFrame([("g", at, seq[at : at + 3000]) for at in (0, 3000, 6000)], "chrom string, chunk_start long, seq string")
    blocks = [(c, 37 * k + c, rng.randrange(0, 30)) for c in range(4) for k in range(300)]
    heads = spark.createDataFrame([(c, "g", 50 * c, 9) for c in range(5)], "cid long, t_name string, t_start long, score long")
    got = antirepeat.composition(heads, spark.createDataFrame(blocks, "cid long, t_off long, size long"), genome)
    for r in got.collect():
        s = "".join(seq[50 * c + t : 50 * c + t + n] for c, t, n in blocks if c == r.cid)
        assert [r.a, r.c, r.g, r.t, r.masked] == [*(s.upper().count(b) for b in "ACGT"), sum(x in "acgt" for x in s)]
    assert "collect_list" in got._jdf.queryExecution().optimizedPlan().toString()
