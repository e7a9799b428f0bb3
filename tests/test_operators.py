"""Operators against plain versions and hand-made cases."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainspark.functions import gaps, sequences, text
from chainspark.functions.sequences import DEFAULT
from chainspark.functions.ordering import indexed, ranked
from chainspark.operators import absorb, align, bundle, chaining, chains, compare, fill, nets, nextfit, partition, seeds, tiles
from chainspark.params import Params, from_mapping


def sizes_of(spark, values):
    return spark.createDataFrame([(f"c{i}", v, i) for i, v in enumerate(values)], "chrom string, size long, ord long")


def test_chunks_keep_a_tail_inside_the_last_chunk(spark):
    got = sorted((r.start, r.end) for r in partition.chunks(sizes_of(spark, [5000]), 5000, 10).collect())
    assert got == [(0, 5000), (4990, 5000)]


def test_overlap_has_to_be_less_than_the_chunk(spark):
    with pytest.raises(ValueError):
        partition.chunks(sizes_of(spark, [10]), 10, 10)


def test_small_is_strictly_under_the_share(spark):
    assert partition.small_scaffolds(sizes_of(spark, [450, 449]), 1000).count() == 1


def test_bulks_hold_the_limit_exactly_and_a_hundred_members(spark):
    got = partition.bulks(sizes_of(spark, [400, 350, 1]), 1000)
    assert [r.bulk_no for r in got.orderBy("pos").collect()] == [1, 1, 2]
    many = partition.bulks(sizes_of(spark, [1] * 101), 1000).groupBy("bulk_no").count().collect()
    assert sorted(r["count"] for r in many) == [1, 100]


@pytest.mark.parametrize("close_after", [False, True])
def test_next_fit_is_the_fold_whatever_the_blocks(spark, close_after):
    rng = random.Random(5)
    values = [rng.choice([0, 1, 3, 8, 20, 44]) for _ in range(700)]
    got = nextfit.next_fit(sizes_of(spark, values), "ord", False, "chrom", 60, 7, close_after, block=32)
    assert [r.bin for r in got.orderBy("pos").collect()] == nextfit.sequential(iter(values), 60, 7, close_after)


def test_bundles(spark):
    s = sizes_of(spark, [5, 10, 10, 3, 0])
    have = s.select("chrom")
    got = {r.chrom: r.bundle for r in bundle.bundles(s, have, 10).collect()}
    assert got == {"c1": 0, "c2": 1, "c0": 2, "c3": 2, "c4": 2}
    assert bundle.bundles(sizes_of(spark, [0, 0]), sizes_of(spark, [0, 0]), 10).count() == 0
    assert {r.n for r in bundle.bundles(sizes_of(spark, [1] * 1001), sizes_of(spark, [1] * 1001), 10**9).groupBy("bundle").agg(F.count("*").alias("n")).collect()} == {1001}


def test_bulk_member_without_size_is_an_error(spark):
    parts = spark.createDataFrame([("BULK_1:x.2bit:c0:nowhere",)], "part string")
    with pytest.raises(Exception, match="nowhere"):
        partition.intervals(parts, sizes_of(spark, [3])).collect()


def test_bases_in_no_partition(spark):
    rows = [("a", 1000), ("b", 30), ("c", 20), ("d:1", 900), ("e", 0)]
    sizes = spark.createDataFrame(rows, "chrom string, size long")
    of = lambda *p: {r.chrom: r.uncovered for r in partition.uncovered(spark.createDataFrame([(x,) for x in p], "part string"), sizes).collect()}
    whole = ["/x:y/g.2bit:a:0-400", "g.2bit:a:390-800", "g.2bit:a:790-1200", "BULK_1:g.2bit:b:c", "g.2bit:d:1:0-900"]
    assert of(*whole) == {}
    assert of() == {"a": 1000, "b": 30, "c": 20, "d:1": 900}
    assert of(*whole[1:3], "BULK_1:g.2bit:b:z", *whole[4:]) == {"a": 390, "c": 20}
    assert of(whole[0], "g.2bit:a:500-600", "g.2bit:a:0-450", *whole[3:]) == {"a": 50 + 400}


def test_file_specs(spark):
    ok = spark.createDataFrame([("/a:b/x.2bit",), ("/a/x.2bit:chr1:5-9",)], "s string").select(text.parsed_spec(F.col("s")).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in ok] == [("/a:b/x.2bit", None, None, None), ("/a/x.2bit", "chr1", 5, 9)]
    for bad in ("x:chr1", "x:chr1:5-9:z", "x:chr1:5"):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "s string").select(text.parsed_spec(F.col("s")).alias("p")).collect()


def test_boundaries_floor_below_zero(spark):
    row = spark.createDataFrame([(100, 200)], "s long, e long").select(text.near_boundary(F.col("s"), F.col("e"), 500, 1000, 0).alias("n")).first()
    assert row.n


def test_parameters():
    assert from_mapping({"lastz_h": 0}).inner_threshold() == 2000
    assert len(Params(reference_overlap=-1, linear_gap="x", fill_files=0).errors()) == 3
    with pytest.raises(ValueError):
        from_mapping({"nope": 1})


def test_gap_costs_agree(spark):
    rng = random.Random(1)
    pairs = [(0, 0), (1, 0), (0, 3), (300_000, 0), (5, 7)] + [(rng.randrange(10**5), rng.randrange(10**5)) for _ in range(50)]
    for table in gaps.TABLES:
        got = spark.createDataFrame(pairs, "a long, b long").select(gaps.gap_cost(F.col("a"), F.col("b"), table).alias("c")).collect()
        assert [r.c for r in got] == gaps.gap_cost_value([a for a, _ in pairs], [b for _, b in pairs], table).tolist()


def test_indexed(spark):
    rng = random.Random(2)
    values = [rng.randrange(50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "i long, v long").repartition(7)
    for down in (False, True):
        order = [F.col("v").desc() if down else F.col("v").asc(), F.col("i").asc()]
        got = indexed(df, "v", order, ["v"], down).orderBy("idx").collect()
        want = sorted(enumerate(values), key=lambda x: (-x[1] if down else x[1], x[0]))
        assert [(r.i, r.v) for r in got] == want
        assert [r.v_before for r in got] == np.concatenate([[0], np.cumsum([v for _, v in want])])[:-1].tolist()
        assert [r.idx for r in got] == list(range(500))


def header(i, t0, t1, q0, q1, score=10, name="a", strand="+"):
    return (str(i), score, name, "+", t0, t1, "q", strand, q0, q1)


HEADER = "id string, score long, t_name string, t_strand string, t_start long, t_end long, q_name string, q_strand string, q_start long, q_end long"


def test_comparison_against_all_pairs(spark):
    rng = random.Random(3)

    def some(n):
        out = []
        for i in range(n):
            t, q = rng.randrange(-50, 400), rng.randrange(400)
            out.append(header(i, t, t + rng.randrange(40), q, q + rng.randrange(40), rng.randrange(100), rng.choice("ab"), rng.choice("+-")))
        return out

    a, b = some(120), some(120)
    for tol in (0, 5):
        want = {x[0] for x in a if not any(x[2] == y[2] and x[7] == y[7] and max(x[4] - tol, y[4]) < min(x[5] + tol, y[5]) and max(x[8] - tol, y[8]) < min(x[9] + tol, y[9]) for y in b)}
        got = compare.missing(spark.createDataFrame(a, HEADER), spark.createDataFrame(b, HEADER), tol, width=16)
        assert {r.id for r in got.collect()} == want
    want = sorted((x[0], y[0]) for x in a for y in b if x[2] == y[2] and x[7] == y[7] and max(x[4], y[4]) < min(x[5], y[5]) and max(x[8], y[8]) < min(x[9], y[9]))
    assert sorted((r.a_id, r.b_id) for r in compare.overlap_pairs(spark.createDataFrame(a, HEADER), spark.createDataFrame(b, HEADER), 16).collect()) == want


def test_touching_needs_a_tolerance_and_self_comparison_misses_nothing(spark):
    a, b = spark.createDataFrame([header(1, 0, 10, 0, 10)], HEADER), spark.createDataFrame([header(2, 10, 20, 10, 20)], HEADER)
    assert compare.missing(a, b, 0).count() == 1
    assert compare.missing(a, b, 1).count() == 0
    assert compare.missing(a, a, 0).count() == 0
    none = spark.createDataFrame([], HEADER)
    assert compare.summary(none, b, 0).first().missing_percent == 0
    assert compare.score_percentiles(none, "x").count() == 0


def test_chain_invariants(spark):
    b = spark.createDataFrame([(1, i, s, dt, dq) for i, (s, dt, dq) in enumerate([(49, 126, 135), (480, 43, 34), (11, 7821, 12148), (564, 0, 0)])], "cid long, i long, size long, dt long, dq long")
    h = chains.headers(b).first()
    assert (h.t_span, h.q_span) == (9094, 13421)
    assert chains.broken(b, chains.headers(b)).count() == 0
    assert chains.gaps(b).count() == 3
    one = b.where("i = 3")
    assert chains.gaps(one).count() == 0 and chains.headers(one).first().t_span == 564


def plain_extension(t, q):
    """The best score of an affine alignment that begins at the corner, cell by cell."""
    low = -(10**9)
    n, m = len(t), len(q)
    h = [[low] * (m + 1) for _ in range(n + 1)]
    e = [[low] * (m + 1) for _ in range(n + 1)]
    f = [[low] * (m + 1) for _ in range(n + 1)]
    top = h[0][0] = 0
    for i in range(n + 1):
        for j in range(m + 1):
            if i:
                e[i][j] = max(h[i - 1][j] - 430, e[i - 1][j] - 30)
            if j:
                f[i][j] = max(h[i][j - 1] - 430, f[i][j - 1] - 30)
            if i and j:
                s = sequences.SUBSTITUTION.get(t[i - 1].upper(), {}).get(q[j - 1].upper(), sequences.UNKNOWN)
                h[i][j] = max(h[i - 1][j - 1] + s, e[i][j], f[i][j])
            elif i or j:
                h[i][j] = max(e[i][j], f[i][j])
            top = max(top, h[i][j])
    return top


def rescored(t, q, blocks):
    total = sum(sequences.SUBSTITUTION[t[a + k]][q[b + k]] for a, b, n in blocks for k in range(n))
    for (a, b, n), (c, d, _) in zip(blocks, blocks[1:], strict=False):
        for g in (c - a - n, d - b - n):
            total -= 400 + 30 * g if g else 0
    return total


def mutated(rng, t, rate, gaps=2, longest=4):
    q = "".join(rng.choice("ACGT") if rng.random() < rate else c for c in t)
    for _ in range(gaps):
        cut = rng.randrange(len(q) + 1)
        q = q[:cut] + "".join(rng.choice("ACGT") for _ in range(rng.randrange(longest))) + q[cut + rng.randrange(longest) :]
    return q


def dna(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_extension_against_the_plain_recursion():
    rng = random.Random(4)
    codes = sequences.letter_codes()
    as_codes = lambda s: codes[np.frombuffer(s.encode(), dtype=np.uint8)]
    for _ in range(60):
        t = dna(rng, rng.randrange(0, 70))
        q = mutated(rng, t, 0.1, 3, 6) if rng.random() < 0.8 else dna(rng, rng.randrange(0, 40))
        score, blocks, *_ = align.advanced(as_codes(t), as_codes(q), 10**6)
        assert score == plain_extension(t, q)
        assert score == rescored(t, q, [(0, 0, 0), *blocks]) if blocks else score == 0
    t = dna(rng, 30) + dna(rng, 300) + dna(rng, 30)
    score, *_, alive = align.advanced(as_codes(t), as_codes(t[:30] + dna(rng, 300) + t[330:]), 910)
    assert score == plain_extension(t[:30], t[:30]) and not alive  # the drop ends it, whatever follows


def test_alignments_are_as_long_as_the_drop_allows(spark, monkeypatch):
    """Indels far longer than a band, alignments far longer than a window, and commits on the way."""
    rng = random.Random(14)
    monkeypatch.setattr(align, "ROWS", 512)
    t = dna(rng, 9000)
    q = t[:2000] + t[2150:5000] + dna(rng, 180) + mutated(rng, t[5000:], 0.03, 10)
    target, query = spark.createDataFrame([("a", t), ("b", dna(rng, 500))], "chrom string, seq string"), spark.createDataFrame([("x", q)], "chrom string, seq string")
    pairs = spark.createDataFrame([("a", "x", 1000, 1000, 40), ("a", "x", 3000, 2850, 40)], "t_chrom string, q_chrom string, t long, q long, length long")
    got = align.gapped(pairs, target, query, 3000).collect()
    assert len(got) == 1
    for r in got:
        blocks = [(b.t, b.q, b.size) for b in r.blocks]
        assert blocks[0][:2] == (0, 0) and blocks[-1][0] + blocks[-1][2] > 8900
        assert r.score == rescored(t, q, blocks)
        assert all(b.t_seq == t[b.t : b.t + b.size] and b.q_seq == q[b.q : b.q + b.size] for b in r.blocks)


def test_a_homology_is_aligned_once(spark, monkeypatch):
    """Many pairs on one homology, over band edges and gaps: few ends move, and one alignment is left of it."""
    rng = random.Random(19)
    monkeypatch.setattr(align, "ROWS", 512)
    monkeypatch.setattr(align, "STRETCHES", 2)
    t = dna(rng, 9000)
    q = dna(rng, 600) + mutated(rng, t[500:8500], 0.04, 14, 30) + dna(rng, 300)
    other = mutated(rng, t[2000:3000], 0.03, 2)  # a second place of some of it
    target, query = spark.createDataFrame([("a", t)], "chrom string, seq string"), spark.createDataFrame([("x", q), ("y", dna(rng, 400) + other)], "chrom string, seq string")
    pairs = seeds.hsps(seeds.seed_hits(seeds.kmers(target, 14), seeds.kmers(query, 14), None), 14, target, query, 2400)
    assert pairs.count() > 10
    moves = []
    plain = align._extended
    monkeypatch.setattr(align, "_extended", lambda starts, *a: moves.append(starts.count()) or plain(starts, *a))
    got = {r.q_name: r for r in align.gapped(pairs, target, query, 3000).collect()}
    assert align.gapped(pairs, target, query, 3000).count() == len(got) == 2
    assert sum(moves) < pairs.count()
    for name, seq in (("x", q), ("y", dna(random.Random(0), 0) or query.where("chrom = 'y'").first().seq)):
        r = got[name]
        blocks = [(b.t, b.q, b.size) for b in r.blocks]
        assert r.score == rescored(t, seq, blocks)
        assert all(b.t_seq == t[b.t : b.t + b.size] and b.q_seq == seq[b.q : b.q + b.size] for b in r.blocks)
    assert got["x"].blocks[0].t < 600 and got["x"].blocks[-1].t + got["x"].blocks[-1].size > 8400
    assert got["y"].blocks[0].t < 2050 and got["y"].blocks[-1].t + got["y"].blocks[-1].size > 2950


def test_alignments_that_are_part_of_a_better_one_go(spark):
    kind = "aid long, t_name string, q_name string, strand string, score long, blocks array<struct<t:long,q:long,size:long>>"
    whole = [(0, 10, 40), (45, 50, 55), (120_000, 120_000, 30)]
    rows = [
        (1, "t", "q", "+", 90, whole),
        (2, "t", "q", "+", 90, whole),  # equal: the first stays
        (3, "t", "q", "+", 50, [(50, 55, 20)]),  # inside
        (4, "t", "q", "+", 50, [(50, 56, 20)]),  # beside it, on another diagonal
        (5, "t", "q", "-", 50, [(50, 55, 20)]),
        (6, "t", "q", "+", 40, [(90, 95, 40)]),  # a quarter of it inside
        (7, "t", "q", "+", 200, [(45, 50, 30)]),  # inside, but better
        (8, "u", "q", "+", 200, []),
    ]
    df = spark.createDataFrame(rows, kind)
    assert sorted(r.aid for r in absorb.absorbed(df).collect()) == [1, 4, 5, 6, 7]
    assert sorted(r.aid for r in absorb.absorbed(df, 0.25).collect()) == [1, 4, 5, 7]
    assert absorb.absorbed(df.limit(0)).count() == 0


def test_weak_stretches_between_strong_ones(spark):
    """Words too short for seeds elsewhere find what lies between two alignments, at a threshold of its own."""
    rng = random.Random(23)
    strong, weak, after = dna(rng, 400), dna(rng, 160), dna(rng, 400)
    t = strong + dna(rng, 300) + weak + dna(rng, 300) + after
    odd = "".join(c if i % 9 else "ACGT"[("ACGT".index(c) + 1) % 4] for i, c in enumerate(weak))
    q = strong + dna(rng, 320) + odd + dna(rng, 310) + after
    target, query = spark.createDataFrame([("a", t)], "chrom string, seq string"), spark.createDataFrame([("x", q)], "chrom string, seq string")
    pairs = spark.createDataFrame([("a", "x", 100, 100, 40), ("a", "x", t.index(after) + 100, q.index(after) + 100, 40)], "t_chrom string, q_chrom string, t long, q long, length long")
    found = align.gapped(pairs, target, query, 3000, drop=910)
    assert found.count() == 2
    (r,) = fill.interpolated(found, target, query, 2000, drop=910).collect()
    assert abs(r.blocks[0].t - 700) < 15 and abs(r.blocks[-1].t + r.blocks[-1].size - 860) < 15 and r.score >= 2000
    assert r.score == rescored(t, q, [(b.t, b.q, b.size) for b in r.blocks])
    assert fill.interpolated(found, target, query, r.score + 1, drop=910).count() == 0


def test_a_matrix_goes_through_extension_alignment_and_fill(spark):
    """Under twice all scores, costs and thresholds everything is found as before and scores twice as much."""
    from chainspark.functions.sequences import DEFAULT, Scoring

    rng = random.Random(31)
    twice = Scoring(tuple(tuple(2 * x for x in r) for r in DEFAULT.pairs), 2 * DEFAULT.unknown, 2 * DEFAULT.gap_open, 2 * DEFAULT.gap_extend)
    t = dna(rng, 2500)
    q = dna(rng, 100) + mutated(rng, t[300:2200], 0.04, 4, 12)
    target, query = spark.createDataFrame([("a", t)], "chrom string, seq string"), spark.createDataFrame([("x", q)], "chrom string, seq string")
    hits = seeds.seed_hits(seeds.kmers(target, 14), seeds.kmers(query, 14), None)
    found = {}
    for k, s in ((1, DEFAULT), (2, twice)):
        pairs = seeds.hsps(hits, 14, target, query, 2400 * k, 910 * k, scoring=s)
        found[k] = align.gapped(pairs, target, query, 3000 * k, 9400 * k, scoring=s).collect()
        assert sorted(r.score for r in pairs.collect()) == sorted(k * r.score for r in seeds.hsps(hits, 14, target, query, 2400).collect())
    assert [(2 * r.score, r.blocks) for r in found[1]] == [(r.score, r.blocks) for r in found[2]] and found[1]
    one, other = (fill.local_alignments(t, q, 11, 2000 * k, 5000 * k, 9400 * k, s) for k, s in ((1, DEFAULT), (2, twice)))
    assert [(2 * s, b) for s, b in one] == other and one


def test_two_homologies_in_one_gap(spark):
    """Split by an insertion on one side only, and a third one out of order: the colinear pair is kept."""
    rng = random.Random(29)
    one, two, odd = dna(rng, 300), dna(rng, 300), dna(rng, 150)
    t_seq, q_seq = dna(rng, 100) + one + dna(rng, 200) + two + odd, odd + dna(rng, 90) + one + dna(rng, 2500) + two + dna(rng, 50)
    gaps = spark.createDataFrame([(1, 0, 1000, 5000, t_seq, q_seq)], "cid long, i long, t_from long, q_from long, t_seq string, q_seq string")
    got = fill.fillings(gaps, 5000, 2000, 910).orderBy("t").collect()
    assert {r.part for r in got} == {0, 1}
    spans = {p: (min(r.t for r in got if r.part == p) - 1000, max(r.t + r.size for r in got if r.part == p) - 1000) for p in (0, 1)}
    assert spans[0][0] <= 101 and 399 <= spans[0][1] < 480 and 520 < spans[1][0] <= 601 and spans[1][1] >= 899
    assert all(a.t + a.size <= b.t and a.q + a.size <= b.q for a, b in zip(got, got[1:], strict=False))


def test_ungapped_extension_ends_by_the_drop_only(spark):
    rng = random.Random(15)
    t = dna(rng, 3000)
    q = t[:1500] + dna(rng, 300) + t[1800:]
    target, query = spark.createDataFrame([("a", t)], "chrom string, seq string"), spark.createDataFrame([("x", q)], "chrom string, seq string")
    runs = spark.createDataFrame([("a", "x", 700, 700, 20)], "t_chrom string, q_chrom string, t long, q long, length long")
    for reach in (16, 5000):
        r = seeds.extended(runs, target, query, 910, reach).first()
        assert r.t == 0 and 1500 <= r.length < 1530


def test_fillings_on_both_strands(spark):
    rng = random.Random(16)
    t, turn = dna(rng, 4000), str.maketrans("ACGT", "TGCA")
    inner = mutated(rng, t[1000:3000], 0.04, 2)
    q = dna(rng, 500) + inner + dna(rng, 400)
    minus = q[::-1].translate(turn)
    genomes = spark.createDataFrame([("a", t)], "chrom string, seq string"), spark.createDataFrame([("x", q.lower()), ("y", minus)], "chrom string, seq string")
    gaps = spark.createDataFrame([(1, 1, "a", "x", "+", len(q), 900, 3100, 300, len(q) - 100), (2, 1, "a", "y", "-", len(q), 900, 3100, 300, len(q) - 100), (3, 1, "a", "x", "+", len(q), 0, 50, 0, 50)], "cid long, i long, t_name string, q_name string, q_strand string, q_size long, t_from long, t_to long, q_from long, q_to long")
    got = fill.fillings(fill.gap_sequences(gaps, *genomes)).collect()
    assert {r.cid for r in got} == {1, 2}
    by = {c: sorted((r.t, r.q, r.size) for r in got if r.cid == c) for c in (1, 2)}
    assert by[1] == by[2]
    assert by[1][0][0] <= 1005 and abs(by[1][-1][0] + by[1][-1][2] - 3000) <= 10
    assert got[0].score == rescored(t, q, by[1])
    assert fill.fillings(fill.gap_sequences(gaps, *genomes, unmask=False)).where("cid = 1").count() == 0


def test_scores_of_bases(spark):
    rng = random.Random(18)
    t, q = dna(rng, 20_000), dna(rng, 15_000)
    rows, heads, want = [], [], {}
    for c in range(12):
        t0, q0, at_t, at_q, total = rng.randrange(3000), rng.randrange(2000), 0, 0, 0
        s = q if c % 2 else q[::-1].translate(str.maketrans("ACGT", "TGCA"))
        for i in range(6):
            n, dt, dq = rng.randrange(1, 2400), rng.choice([0, 7, 90]) if i < 5 else 0, rng.choice([0, 3]) if i < 5 else 0
            n = min(n, 15_000 - q0 - at_q)
            rows.append((c, i, n, dt, dq))
            total += sum(sequences.SUBSTITUTION[t[t0 + at_t + k]][s[q0 + at_q + k]] for k in range(n)) - int(gaps.gap_cost_value([dt], [dq])[0])
            at_t, at_q = at_t + n + dt, at_q + n + dq
        heads.append((c, "a", t0, "x", q0, len(q), "+" if c % 2 else "-"))
        want[c] = total
    cut = lambda s, n: [(s[0], i, s[1][i : i + n]) for i in range(0, len(s[1]), n)]
    genome = lambda name, s: spark.createDataFrame(cut((name, s), 1000), "chrom string, chunk_start long, seq string")
    got = chains.sequence_scores(spark.createDataFrame(rows, "cid long, i long, size long, dt long, dq long"), genome("a", t), genome("x", q), spark.createDataFrame(heads, "cid long, t_name string, t_start long, q_name string, q_start long, q_size long, q_strand string"))
    assert {r.cid: r.score for r in got.collect()} == want


def test_ranges_of_chunked_sequences(spark):
    rng = random.Random(19)
    s = dna(rng, 10_000)
    g = spark.createDataFrame([("a", i, s[i : i + 700]) for i in range(0, 10_000, 700)], "chrom string, chunk_start long, seq string")
    want = [(rng.randrange(10_000), rng.randrange(10_100)) for _ in range(40)] + [(0, 10_000), (5, 5)]
    got = tiles.fetched(spark.createDataFrame([("a", x, y) for x, y in want] + [("none", 0, 3)], "chrom string, start long, end long"), g, 512).collect()
    assert {(r.chrom, r.start, r.end): r.seq for r in got} == {("a", x, y): s[x : max(x, y)] for x, y in want} | {("none", 0, 3): ""}
    words = seeds.kmers(seeds.overlapping(g, 12, 256), 12).collect()
    assert sorted((r.pos, r.word) for r in words) == [(i, s[i : i + 12]) for i in range(10_000 - 11)]


def plain_chains(rows, max_gap):
    """The recursion over all blocks of one group, each against each."""
    rows = sorted(rows, key=lambda r: (r[4], r[5], r[3]))
    total, back = [], []
    for j, (*_, t, q, n) in enumerate(rows):
        best, k = 0, None
        for i in range(j):
            et, eq = rows[i][4] + rows[i][6], rows[i][5] + rows[i][6]
            if et <= t and eq <= q and t - et <= max_gap:
                gain = total[i] - int(gaps.gap_cost_value([t - et], [q - eq])[0])
                if gain > best:
                    best, k = gain, i
        total.append(91 * n + best)
        back.append(k)
    return max(total)


@pytest.mark.parametrize("max_gap", [60, 500])
def test_chaining_finds_the_best_chain_of_each_group(spark, max_gap):
    rng = random.Random(20)
    rows = [(rng.choice("tu"), "q", rng.choice("+-"), i, rng.randrange(4000), rng.randrange(4000), rng.randrange(5, 40)) for i in range(160)]
    df = spark.createDataFrame(rows, "t_name string, q_name string, q_strand string, aid long, t long, q long, size long")
    best = {}
    for c in chaining.chained(df, 0, "loose", max_gap=max_gap).collect():
        best[c.t_name, c.q_strand] = max(best.get((c.t_name, c.q_strand), 0), c.score)
    groups = {(r[0], r[2]) for r in rows}
    assert best == {g: plain_chains([r for r in rows if (r[0], r[2]) == g], max_gap) for g in groups}
    numbers = chaining.islands(df, max_gap).collect()
    for g in groups:
        reach, island = None, -1
        for r in sorted((r for r in numbers if (r.t_name, r.q_strand) == g), key=lambda r: (r.t, r.q, r.aid)):
            island += reach is None or r.t - reach > max_gap
            reach = max(r.t + r["size"], reach or 0)
            assert r.island == island


def test_ranks_of_any_order(spark):
    rng = random.Random(21)
    rows = [(rng.choice(["chr1", "chr10", "chr2", "x"]), rng.randrange(5), i) for i in range(300)]
    df = spark.createDataFrame(rows, "name string, v long, i long").repartition(5)
    got = ranked(df, [F.col("name").asc(), F.col("v").desc(), F.col("i").asc()], 7).orderBy("idx").collect()
    assert [(r.name, r.v, r.i) for r in got] == sorted(rows, key=lambda r: (r[0], -r[1], r[2])) and [r.idx for r in got] == list(range(300))


@pytest.mark.parametrize("fan", [2, 3, 64])
def test_next_fit_over_many_levels(spark, monkeypatch, fan):
    monkeypatch.setattr(nextfit, "FAN", fan)
    rng = random.Random(22)
    values = [rng.choice([0, 1, 3, 8, 20, 44]) for _ in range(500)]
    got = nextfit.next_fit(sizes_of(spark, values), "ord", False, "chrom", 60, 7, False, block=16)
    assert [r.bin for r in got.orderBy("pos").collect()] == nextfit.sequential(iter(values), 60, 7, False)


def test_long_and_short_ranges_meet(spark):
    """Ranges of all sizes, across the edges of bins of every level."""
    rng = random.Random(23)

    def some(n):
        out = []
        for i in range(n):
            size = int(10 ** rng.uniform(0, 7))
            t = rng.choice([rng.randrange(10**7), 8**rng.randrange(3, 8) * rng.randrange(1, 4) - rng.randrange(5)])
            out.append(header(i, t, t + size, 0, 100, 1, "a", "+"))
        return out

    a, b = some(150), some(150)
    want = sorted((x[0], y[0]) for x in a for y in b if max(x[4], y[4]) < min(x[5], y[5]))
    got = compare.overlap_pairs(spark.createDataFrame(a, HEADER), spark.createDataFrame(b, HEADER), 16).collect()
    assert sorted((r.a_id, r.b_id) for r in got) == want


def test_chaining_keeps_blocks_colinear(spark):
    rng = random.Random(6)
    rows = [("t", "q", "+", i, rng.randrange(3000), rng.randrange(3000), rng.randrange(5, 40)) for i in range(120)]
    df = spark.createDataFrame(rows, "t_name string, q_name string, q_strand string, aid long, t long, q long, size long")
    got = chaining.chained(df, 0, "loose", max_gap=500).collect()
    at = {r[3]: r for r in rows}
    assert sorted(m for c in got for m in c.members) == sorted(at)
    for c in got:
        b = sorted((at[m] for m in c.members), key=lambda r: r[4])
        for x, y in zip(b, b[1:], strict=False):
            assert x[4] + x[6] <= y[4] and x[5] + x[6] <= y[5]
        cost = gaps.gap_cost_value([y[4] - x[4] - x[6] for x, y in zip(b, b[1:], strict=False)], [y[5] - x[5] - x[6] for x, y in zip(b, b[1:], strict=False)])
        assert c.score >= sum(91 * r[6] for r in b) - cost.sum() - 1


def test_net_gives_every_base_to_its_best_chain(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        s = rng.randrange(300)
        rows.append(("c", f"{i:03d}", rng.randrange(20), s, s + rng.randrange(60)))
    got = nets.net(spark.createDataFrame(rows, "t_name string, id string, score long, t_start long, t_end long"), width=50).collect()
    held = {}
    for r in got:
        for p in range(r.start, r.end):
            assert p not in held
            held[p] = r.id
    for p in range(400):
        over = [r for r in rows if r[3] <= p < r[4]]
        assert held.get(p) == (min(over, key=lambda r: (-r[2], r[1]))[1] if over else None)


def test_sequence_functions(spark):
    row = spark.createDataFrame([("AcgTNn",)], "s string").select(sequences.reverse_complement(F.col("s")).alias("r"), sequences.masked_bases(F.col("s")).alias("m"), sequences.base_count(F.col("s"), "N").alias("n")).first()
    assert tuple(row) == ("nNAcgT", 3, 2)


def test_pairs_of_suspects_fall_by_their_outer_flanks(spark):
    from chainspark.operators import nets

    chains = spark.createDataFrame([("big", "c", 0, 90_000, 100_000), ("a", "c", 1_000, 1_500, 900), ("b", "c", 3_000, 3_500, 100), ("far", "c", 60_000, 61_000, 900)], "id string, t_name string, t_start long, t_end long, score long")
    gaps = spark.createDataFrame([("big", "c", 100_000, 900, 2_000, 98_000, 2_000), ("big", "c", 100_000, 2_900, 4_000, 99_000, 1_500), ("big", "c", 100_000, 59_000, 62_000, 99_500, 500)], "id string, t_name string, score long, start long, end long, left long, right long")
    every = nets.breaking(chains, gaps)
    assert {r.id for r in every.collect()} == {"a", "b", "far"}
    assert {r.id for r in nets.suspects(chains, gaps).collect()} == {"b"}
    assert [(r.id, r.next) for r in nets.suspect_pairs(every, chains).collect()] == [("a", "b")]
    assert nets.suspect_pairs(every, chains, distance=1_000).count() == 0


def test_pair_totals_are_products(spark):
    """A pair's combinations of intervals are added up without a row for each of them."""
    kind = "part string, chrom string, start long, end long"
    r = spark.createDataFrame([("r1", f"c{i}", 0, 10 + i) for i in range(100)] + [("r2", "x", 5, 9)], kind)
    q = spark.createDataFrame([("q1", f"d{i}", 0, 3) for i in range(70)] + [("q2", "y", 0, 2)], kind)
    both = partition.interval_pairs(partition.pairs(r.select("part").distinct(), q.select("part").distinct()), r, q)
    length = lambda s: F.sum(F.col(f"{s}_end") - F.col(f"{s}_start")).cast("long").alias(f"{s}_bases")
    want = both.groupBy("reference_part", "query_part").agg(F.count("*").alias("alignments"), length("reference"), length("query"))
    got = partition.pair_totals(r, q)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert partition.pair_totals(r.limit(0), q).count() == 0


def test_products_meet_in_blocks(spark):
    """Every row meets every row, copies and nulls too, whatever the blocks; no cross join is planned."""
    left, right = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "x string"), spark.createDataFrame([(i % 40,) for i in range(57)], "y long")
    want = sorted(map(str, left.crossJoin(right).collect()))
    for block in (1, 10, 4096):
        assert sorted(map(str, partition.crossed(left, right, block).collect())) == want
    assert partition.crossed(left.limit(0), right).count() == partition.crossed(left, right.limit(0)).count() == 0
    plan = partition.pairs(left.toDF("part"), right.toDF("part"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_coded_words_are_the_words(spark):
    """Words as numbers: the same places and bases as words as strings, in chunks, with steps, and beyond a long."""
    pick = random.Random(3)
    rows = [(i, i % 7, "".join(pick.choices("ACGTN-ac", [30, 30, 30, 30, 1, 1, 1, 1], k=pick.choice([0, 3, 12, 80, 400])))) for i in range(60)] + [(99, 0, None)]
    g = spark.createDataFrame(rows, "chrom long, chunk_start long, seq string")
    for k, step in ((1, 1), (5, 1), (12, 3), (20, 1), (31, 2), (33, 1)):
        coded = seeds.coded_kmers(g, k, step)
        got = coded if k > seeds.LONGEST else coded.withColumn("word", seeds.spelled(F.col("word"), k))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, seeds.kmers(g, k, step).collect()))
    assert sorted(map(tuple, seeds.word_index(g, 5).collect())) == sorted(map(tuple, seeds.word_counts(seeds.kmers(g, 5)).collect()))


def test_sequence_scores_carry_a_row_a_chain_and_tile(spark):
    """Blocks over the edges of tiles, on both strands, past a genome's end and in chunks, against a plain walk; few bytes are shuffled."""
    pick = random.Random(8)
    t, q = ("".join(pick.choices("ACGTacgtN", k=n)) for n in (13_000, 12_500))
    pairs, blocks, heads = sequences.score_matrix(), [], []
    code, back, want = sequences.letter_codes(), str.maketrans("ACGTacgt", "TGCAtgca"), {}
    for cid in range(24):
        minus, t0, q0, total = cid % 2 == 1, pick.randrange(9000), pick.randrange(9000), 0
        heads.append((cid, "t", t0, "q", q0, len(q), "-" if minus else "+"))
        line = q[::-1].translate(back) if minus else q
        for i in range(5):
            size, dt, dq = pick.choice([1, 40, 700, 4097]), pick.randrange(50) * (i < 4), pick.randrange(50) * (i < 4)
            blocks.append((cid, i, size, dt, dq))
            total += sum(int(pairs[code[ord(t[t0 + k])], code[ord(line[q0 + k])]]) for k in range(size) if t0 + k < len(t) and q0 + k < len(q))
            t0, q0 = t0 + size + dt, q0 + size + dq
        want[cid] = total
    b = spark.createDataFrame(blocks, "cid long, i long, size long, dt long, dq long")
    h = spark.createDataFrame(heads, "cid long, t_name string, t_start long, q_name string, q_start long, q_size long, q_strand string")
    cost = {r.cid: r.c for r in b.groupBy("cid").agg(F.sum(gaps.gap_cost(F.col("dt"), F.col("dq"))).alias("c")).collect()}
    genome = lambda name, s: spark.createDataFrame([(name, s)], "chrom string, seq string")
    chunked = lambda name, s: spark.createDataFrame([(name, i, s[i : i + 1100]) for i in range(0, len(s), 1000)], "chrom string, chunk_start long, seq string")
    for make in (genome, chunked):
        scored = chains.sequence_scores(b, make("t", t), make("q", q), h)
        assert {r.cid: r.score for r in scored.collect()} == {c: n - cost[c] for c, n in want.items()}
    # no join carries a row a block: neither side is fetched by range and put together again
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 4


def test_absorption_looks_from_witnesses(spark):
    """Random alignments, with many small blocks, long ones and copies, against all pairs; only the largest blocks look for better ones."""
    pick, rows = random.Random(4), []
    for aid in range(160):
        at, blocks = pick.randrange(300), []
        for _ in range(pick.randint(1, 6)):
            size = pick.choice([3, 10, 60, 400, 5000])
            blocks.append((at, at + pick.randrange(2), size))
            at += size + 2 + pick.randrange(20)
        rows.append((aid, "t", "q", "+", pick.randrange(5), blocks))
    rows += [(1000 + r[0], *r[1:4], r[4], [b for b in r[5] if pick.random() < 0.8]) for r in rows[:80]] + [(2000 + r[0], *r[1:]) for r in rows[:20]]
    rows = [r for r in rows if r[5]]
    df = spark.createDataFrame(rows, "aid long, t_name string, q_name string, strand string, score long, blocks array<struct<t:long,q:long,size:long>>")
    rank = {r[0]: (-r[4], *r[5][0][:2], r[0]) for r in rows}
    met = lambda x, y: sum(max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])) for a in x for b in y if a[0] - a[1] == b[0] - b[1])
    for share in (0.95, 0.6, 0.3):
        firsts = {tuple(r[5]): min((rank[x[0]], x[0]) for x in rows if x[5] == r[5])[1] for r in rows}
        want = [a for a in firsts.values() if not any(rank[y[0]] < rank[a] and met(x[5], y[5]) >= share * sum(b[2] for b in x[5]) for x in rows if x[0] == a for y in rows)]
        assert sorted(r.aid for r in absorb.absorbed(df, share).collect()) == sorted(want)
    b = [(i, "t", "q", "+", {"s": -i}, 110, 0, lo, lo + n) for i in range(50) for lo, n in ((0, 10), (1000 * i + 50, 100))]
    alike = spark.createDataFrame([(*x[:4], (x[4]["s"],), *x[5:]) for x in b], "aid long, t_name string, q_name string, strand string, rank struct<s:int>, bases long, diagonal long, lo long, hi long")
    assert absorb._candidates(alike, 0.9).count() == 0  # the small block that all share meets nothing


def test_short_alignments_meet_without_pairs(spark, monkeypatch):
    """Short alignments on few places, copies and near copies among them, against all pairs; pairs are never listed."""

    def listed(*_):
        raise AssertionError("pairs were listed")

    monkeypatch.setattr(absorb, "_candidates", listed)
    pick, rows = random.Random(9), []
    for aid in range(300):
        blocks = [(60 * t - 600, 60 * t - 600 + aid % 2, pick.choice([1, 9, 30, 31, 32, 50])) for t in sorted(pick.sample(range(20), pick.randint(1, 4)))]
        rows.append((aid, f"t{aid % 3}" if aid % 3 else None, "q", "+", 91 * sum(b[2] for b in blocks), blocks))
    df = spark.createDataFrame(rows, "aid long, t_name string, q_name string, strand string, score long, blocks array<struct<t:long,q:long,size:long>>")
    rank = {r[0]: (-r[4], *r[5][0][:2], r[0]) for r in rows}
    met = lambda x, y: sum(max(0, min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])) for a in x for b in y if a[0] - a[1] == b[0] - b[1])
    for share in (0.95, 0.6):
        firsts = {(r[1], *r[5]): min((rank[x[0]], x[0]) for x in rows if x[1] == r[1] and x[5] == r[5])[1] for r in rows}
        want = [a for a in firsts.values() if not any(x[1] and x[1] == y[1] and rank[y[0]] < rank[a] and met(x[5], y[5]) >= share * sum(b[2] for b in x[5]) for x in rows if x[0] == a for y in rows)]
        assert sorted(r.aid for r in absorb.absorbed(df, share).collect()) == sorted(want)


def test_products_of_long_names_take_few_bytes(spark, tmp_path):
    """A task's rows have so few distinct names that a file writes each once; pairs don't repeat them."""
    pick = random.Random(5)
    name = lambda: "".join(pick.choices("0123456789abcdef", k=500))
    left, right = spark.createDataFrame([(name(),) for _ in range(60)], "x string"), spark.createDataFrame([(name(), i) for i in range(3003)], "y string, i long")
    partition.crossed(left, right).write.parquet(str(tmp_path / "pairs"))
    got = spark.read.parquet(str(tmp_path / "pairs"))
    assert got.count() == got.select("x", "i").distinct().count() == 60 * 3003 and got.select("y", "i").distinct().count() == 3003
    assert sum(p.stat().st_size for p in (tmp_path / "pairs").glob("part-*")) < 8_000_000


def test_short_gaps_are_aligned_side_by_side(monkeypatch):
    """Extensions of short sides made together are those made one by one, ties and unknown bases too; none goes row by row alone."""
    pick, sides = random.Random(12), []
    for _ in range(400):
        t = "".join(pick.choices("ACGTNa" if pick.random() < 0.3 else "ACGT", k=pick.randint(11, 50)))
        at = pick.randrange(20)
        q = "".join(c if pick.random() < 0.93 else pick.choice(["", "A", "GG", "T"]) for c in t[at:])[:50]
        sides.append((t, pick.choice([q, q[::-1], q + q])[:50]))
    one = [align.advanced(align.codes(t), align.codes(q), 9400)[:2] for t, q in sides if t and q]
    words = lambda s: {(i, s[i : i + 11]) for i in range(len(s) - 10) if set(s[i : i + 11]) <= set("ACGT")}
    monkeypatch.setattr(align, "_stretch", lambda *_: pytest.fail("a short side was aligned alone"))
    assert align._ended([(align.codes(t), align.codes(q)) for t, q in sides if t and q], 9400, DEFAULT) == one
    for t, q in sides:
        assert fill._diagonals(t, q, 11) == {j - i for i, x in words(t) for j, y in words(q) if x == y}
    together = fill.local_alignments_of(sides, 11, 500, 500, 9400)
    assert together == [fill.local_alignments(t, q, 11, 500, 500, 9400) for t, q in sides] and sum(map(len, together)) > 100


def test_ends_of_alignments_are_dealt_evenly(spark, monkeypatch):
    """Small rows that take long don't share a task by their bytes."""
    from chainspark.scratch import Scratch

    files, keep = [], Scratch.keep

    def kept(self, df, name):
        out = keep(self, df, name)
        files.extend([len(out.inputFiles())] if name == "moved" else [])
        return out

    monkeypatch.setattr(Scratch, "keep", kept)
    rng = random.Random(3)
    seqs = [(f"c{i}", dna(rng, 300)) for i in range(40)]
    genome = spark.createDataFrame(seqs, "chrom string, seq string")
    pairs = spark.createDataFrame([(c, c, 100, 100, 40) for c, _ in seqs], "t_chrom string, q_chrom string, t long, q long, length long")
    found = align.gapped(pairs, genome, genome, 3000)
    assert files[0] == 4 and found.count() == 40
