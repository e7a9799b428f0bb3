"""Top-k search, Merkle manifest and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chainspark.llm import bitslice, merkle, resample
from chainspark.llm.common import Scratch
from chainspark.llm.ordered import positions

# --- 11 ---

VECTORS = "vec_id long, embedding array<float>, score long, block int, id string"


def vectors(spark, rows):
    """Embeddings with columns whose names clash with the operator's own."""
    return spark.createDataFrame([(i, e, 0, 0, "x") for i, e in rows], VECTORS).repartition(3)


def plain_top(rows, k, every):
    ok = [(i, [math.floor(256 * np.float64(np.float32(x))) for x in e]) for i, e in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i is None or i % every:
            continue
        found = [(-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0) for m, (j, v) in enumerate(ok) if m != n]
        out += [(i, r + 1, None if no else j, -s) for r, (s, no, j) in enumerate(sorted(found)[:k])]
    return out


def test_top_k_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 64)
    monkeypatch.setattr(bitslice, "BLOCK_QUERIES", 64)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)]) for i in range(300)]
    rows += [(i, list(rows[10][1])) for i in range(300, 500)]  # many equal vectors
    rows += [(700, None), (701, []), (702, [1.0, None]), (750, [float("nan")] * 12), (751, [float("inf")] + [0.0] * 11), (None, [0.9] * 12), (None, [0.9] * 12)]
    rows += [(800, [0.5, -0.5]), (850, [0.25] * 20), (900, [-1.0] * 12), (900, [-1.0] * 12), (7, [2.0] * 12)]
    key = lambda x: (x[0], x[1], x[3], x[2] is None, x[2] or 0)
    got = sorted((tuple(r)[:4] for r in bitslice.top_k(vectors(spark, rows), k=5, every=10).collect()), key=key)
    assert got == sorted(plain_top(rows, 5, 10), key=key)


def test_top_k_of_few_rows_and_large_values(spark):
    assert bitslice.top_k(vectors(spark, []), k=5).collect() == []
    assert bitslice.top_k(vectors(spark, [(0, [1.0])]), k=5).collect() == []
    assert bitslice.top_k(vectors(spark, [(1, [1.0]), (2, [1.0])]), k=5).collect() == []
    got = bitslice.top_k(vectors(spark, [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 2.0])]), k=5)
    assert [tuple(r)[:4] for r in got.orderBy("rank").collect()] == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 256 * 512), (0, 3, 2, -(2**63))]


def test_blocks_of_an_index_are_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    got = bitslice.top_k(vectors(spark, [(i, rng.normal(size=4).tolist()) for i in range(400)]), k=5)
    assert len(got.collect()) == 40
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(5))
def test_sliced_scores_are_products(seed):
    rng = np.random.default_rng(seed)
    values = rng.integers(-300, 300, (130, 9)) * (rng.random((130, 9)) < 0.7)
    planes, low, bits = bitslice.slices(values)
    block = bitslice.Block(planes, low, bits, 130)
    for q in rng.integers(-300, 300, (5, 9)):
        want = sorted(((-int(s), r) for r, s in enumerate(values @ q) if r != 3))[:7]
        assert [(-s, r) for r, s in block.top(q, 7, 3)] == want


# --- 12 ---

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree long, row long, leaf string"


def table(spark, rows):
    """documents with columns whose names clash with the operators' own; rows: (doc_id, text, lang, source, n_chars)."""
    return spark.createDataFrame([(*r, 0, 0, "x") for r in rows], DOCS).repartition(3)


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(r, more=0):
    i, text, lang, source, n = r
    put = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return sha("".join(map(put, (i, source, lang, n if n is None else n + more, text))))


def plain_ways(hashes):
    """(siblings with their side, for each leaf; the root) of a tree over hashes."""
    ways, at = [[] for _ in hashes], list(range(len(hashes)))
    while len(hashes) > 1:
        for x, i in enumerate(at):
            other = i ^ 1
            ways[x].append(("", "") if other >= len(hashes) else (hashes[other], "") if other < i else ("", hashes[other]))
        hashes = [sha("".join(hashes[i : i + 2])) for i in range(0, len(hashes), 2)]
        at = [i // 2 for i in at]
    return ways, hashes[0]


def plain_manifest(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: sorted(langs[x], key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))) for x in order}
    inner = {x: plain_ways([plain_leaf(r) for r in trees[x]]) for x in order}
    above, root = plain_ways([inner[x][1] for x in order])
    out = []
    for x, up in zip(order, above, strict=True):
        for r, way in zip(trees[x], inner[x][0], strict=True):
            fold = plain_leaf(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            for a, b in way + up:
                fold = sha(a + fold + b)
            out.append((r[0], plain_leaf(r), inner[x][1], root, sha("".join(a + b for a, b in way + up)), fold, fold == root))
    return out


@pytest.mark.parametrize(("levels", "langs"), [(1, 3), (2, 9), (10, 2)])
def test_manifest_against_plain_trees(spark, levels, langs):
    rng = random.Random(levels)
    names = [None, "en", "", "é", "zz", *[f"l{i}" for i in range(20)]][:langs]
    rows = [(i, f"text {i} é", names[min(rng.randrange(2 * langs), langs - 1)], rng.choice([None, "s"]), rng.choice([None, i])) for i in range(120)]
    rows += [(5, "again", names[0], None, 1), (7, None, names[0], "", 0), (7, None, names[0], "", 0), (None, "no id", names[1], "s", 4), (None, "", names[1], "s", 0), (-3, "x" * 100_000, names[1], "s", 2**62)]
    rows += [(1000, "only one", "single", "s", 8)]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, merkle.leaf(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1))
    got = merkle.manifest(table(spark, rows), tampered, levels).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_manifest(rows), key=key)


def test_manifest_of_few_rows(spark):
    assert merkle.manifest(table(spark, [])).collect() == []
    one = (4, "a", None, None, None)
    r = merkle.manifest(table(spark, [one])).first()
    assert (r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["verified"]) == (plain_leaf(one), plain_leaf(one), plain_leaf(one), sha(""), True)


# --- 13 ---


def runs(text, n=1):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) for k in range(1, n + 1) for i in range(len(w) - k + 1)], len(w)


def plain_draw(rows, target, percent, least, buckets, n):
    s, t = Counter(), Counter()
    for r in rows:
        s.update(h % buckets for h in runs(r[1], n)[0])
    for x in target:
        t.update(h % buckets for h in runs(x, n)[0])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, text, *_ in rows:
        found, words = runs(text, n)
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        weight = sum(gain(f % buckets) for f in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): p + 1 for p, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


@pytest.mark.parametrize(("n", "percent", "buckets"), [(1, 10, 10_000), (2, 37, 50), (3, 100, 1000)])
def test_resampling_against_a_plain_draw(spark, n, percent, buckets):
    rng = random.Random(n)
    words = ["alpha", "Beta", "x1", "é", "漢字", "don't", "w" * 70, "v" * 200, "a-b", "\x7fz\x1cq"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60))), "en", "s", 0) for i in range(150)]
    rows += [(200, None, None, None, None), (201, "", "en", "s", 0), (None, "alpha " * 30, "en", "s", 0), (-4, "beta x1 " * 9000, "en", "s", 0), (2**62, "x1 " * 25, "en", "s", 0)]
    rows += [(300, "same text of it " * 10, "en", "s", 0)] * 5  # equal keys
    target = ["alpha x1 x1 alpha", None, "beta é"]
    got = resample.resampled(table(spark, rows), spark.createDataFrame([(x, 1) for x in target], "text string, weight int"), percent, 20, buckets, n)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain_draw(rows, target, percent, 20, buckets, n), key=key)


def test_resampling_of_few_rows(spark):
    empty = spark.createDataFrame([], "text string")
    assert resample.resampled(table(spark, []), empty).collect() == []
    (r,) = resample.resampled(table(spark, [(1, "one two", "en", "s", 0)]), empty).collect()
    assert (r["n_features"], r["rank"]) == (2, None)


@pytest.mark.parametrize("k", [0, 1, 2, 40, 79, 80, 99])
def test_kth_key(spark, k):
    rng = random.Random(k)
    rows = [(rng.choice([-(2**63), -5, -4, 0, 3, 4096, 2**40, 2**63 - 1]), i) for i in range(80)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = df.where(resample.up_to_kth(df, [F.col("a"), F.col("b")], k)).collect()
    assert sorted(map(tuple, got)) == sorted(rows)[:k]


def test_positions(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(500)], "a int, idx_ long").repartition(5)
    got = positions(df, [F.desc("a"), F.col("idx_")], Scratch(spark, "test"), "p", 6).orderBy("idx").collect()
    assert [(r["a"], r["idx_"]) for r in got] == sorted(((i % 7, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
    assert [r["idx"] for r in got] == list(range(500))
