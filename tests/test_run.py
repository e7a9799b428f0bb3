"""A whole run on genomes with planted homologies."""

import os
import random

import numpy as np
import pytest

from chainspark.params import Params
from chainspark.plans.run import Run
from chainspark.scratch import checkpoint_dir
from chainspark.sources import chain_text

from .test_operators import dna, mutated


def test_planted_homologies_become_chains(spark, tmp_path):
    rng = random.Random(51)
    turn = str.maketrans("ACGT", "TGCA")
    t1, t2 = dna(rng, 12_000), dna(rng, 6_000)
    same = mutated(rng, t1[2000:9000], 0.05, 12, 30)
    back = mutated(rng, t2[1000:5000], 0.05, 6, 20)[::-1].translate(turn)
    q1 = dna(rng, 1500) + same[:3500] + dna(rng, 900) + same[3500:] + dna(rng, 700)
    q2 = dna(rng, 800) + back + dna(rng, 1200)
    chunked = lambda s, n: [(c, i, x[i : i + n]) for c, x in s for i in range(0, len(x), n)]
    genome = lambda s, n: spark.createDataFrame(chunked(s, n), "chrom string, chunk_start long, seq string")
    p = Params(seed_limit=None, reference_chunk=5000, query_chunk=4000, query_overlap=100, bundle_max_bases=10_000, fill_files=4, antirepeat_min_score=1000)
    run = Run(spark, genome([("t1", t1), ("t2", t2)], 1000), genome([("q1", q1), ("q2", q2)], 3000), p, str(tmp_path / "out"))
    shared = checkpoint_dir(spark).removeprefix("file://")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    got = run.run().collect()
    assert {x.rpartition("-")[0] for x in set(os.listdir(shared)) - before} == set()  # nothing is left beside the stages
    assert run.counts["final"] == len(got) and run.counts["psl"] == run.read("bundles").count()
    assert run.expected_pairs() == 5 * 5
    one = max((r for r in got if r.t_name == "t1" and r.q_name == "q1"), key=lambda r: r.score)
    assert one.q_strand == "+" and one.t_start < 2100 and one.t_end > 8900 and abs(one.q_start - 1500) < 100
    two = max((r for r in got if r.t_name == "t2" and r.q_name == "q2"), key=lambda r: r.score)
    assert two.q_strand == "-" and two.t_start < 1100 and two.t_end > 4900 and abs(two.q_start - 1200) < 100
    assert [int(r.id) for r in sorted(got, key=lambda r: -r.score)] == sorted(int(r.id) for r in got)
    for r in got:  # spans, and scores near those of the bases
        n = [(b.size, b.dt or 0, b.dq or 0) for b in r.blocks]
        assert np.sum([s + dt for s, dt, _ in n]) == r.t_end - r.t_start and np.sum([s + dq for s, _, dq in n]) == r.q_end - r.q_start
    chain_text.write_chains(run.read("final"), str(tmp_path / "text"))
    assert chain_text.read_headers(spark, str(tmp_path / "text")).count() == len(got)
    # a later start reads the tables that are there
    again = Run(spark, run.target, run.query, Params(**{**p.__dict__, "start": "clean"}), str(tmp_path / "out")).run()
    assert again.count() == len(got)


def test_a_run_checks_its_partitions(spark, tmp_path):
    genome = spark.createDataFrame([("t1", "ACGT" * 300), ("t2", "ACGT" * 20), ("t:3", "ACGT" * 10)], "chrom string, seq string")
    run = Run(spark, genome, genome, Params(reference_chunk=500, query_chunk=400, query_overlap=10), str(tmp_path / "out"))
    parts = [tuple(r) for r in run.kept(run.partitions(), "partitions").collect()]
    run.check_partitions()
    shape = "side string, kind string, no long, part string"
    chunk = next(r for r in parts if r[0] == "query" and ":t1:" in r[3])
    run.kept(spark.createDataFrame([r for r in parts if r != chunk], shape), "partitions")
    with pytest.raises(RuntimeError, match="bases of t1 .query. are in no partition"):
        run.check_partitions()
    run.kept(spark.createDataFrame([*parts, chunk], shape), "partitions")
    with pytest.raises(RuntimeError, match="twice"):
        run.check_partitions()
