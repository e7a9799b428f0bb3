"""Files: round trips and the cases that differ between readers."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from chainspark.params import read_params
from chainspark.sources import chain_text, sequences, sizes
from chainspark.streaming import ingest

CHAINS = """##matrix=x
chain 300 chr1 1000 + 10 9104 chrQ 50000 + 5 13426 1
49\t126\t135
480\t43\t34
11\t7821\t12148
564

chain 20 chr2 500 + 0 7 chrQ 50000 - 3 10 2
7

"""


def test_chains_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.chain").write_text("shell$ tool\n" + CHAINS)
    got = chain_text.read_chains(spark, str(tmp_path / "in"))
    rows = {r.id: r for r in got.collect()}
    assert rows["1"].score == 300 and [tuple(b) for b in rows["1"].blocks] == [(49, 126, 135), (480, 43, 34), (11, 7821, 12148), (564, None, None)]
    assert rows["2"].q_strand == "-" and len(rows["2"].blocks) == 1
    chain_text.write_chains(got, str(tmp_path / "out"))
    again = chain_text.read_chains(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    assert chain_text.read_headers(spark, str(tmp_path / "out")).count() == 2


def test_fasta_in_chunks(spark, tmp_path):
    seqs = {"a": "ACGTacgtNN" * 7, "b": "", "c": "TTGCA"}
    body = "".join(f">{n} more words\n" + "".join(s[i : i + 9] + "\r\n" for i in range(0, len(s), 9)) for n, s in seqs.items())
    (tmp_path / "g.fa").write_text(body)
    with gzip.open(tmp_path / "g.fa.gz", "wt") as f:
        f.write(body)
    for name in ("g.fa", "g.fa.gz"):
        rows = sequences.read_fasta(spark, str(tmp_path / name), chunk=16).collect()
        assert all(len(r.seq) <= 16 for r in rows)
        assert {n: "".join(r.seq for r in sorted(rows, key=lambda r: r.chunk_start) if r.chrom == n) for n in seqs} == seqs
    got = {r.chrom: r.size for r in sequences.lengths(sequences.read_genome(spark, str(tmp_path / "g.fa"))).collect()}
    assert got == {n: len(s) for n, s in seqs.items()}


def test_twobit(spark, tmp_path):
    seqs = [("chr1", "ACGTNNNNacgtTTnnGA"), ("chr2", "NNNN"), ("chr3", "T" * 41 + "acg")]
    (tmp_path / "g.2bit").write_bytes(sequences.encoded_twobit(seqs))
    rows = sequences.read_twobit(spark, str(tmp_path / "g.2bit"), chunk=8).collect()
    assert {n: "".join(r.seq for r in sorted(rows, key=lambda r: r.chunk_start) if r.chrom == n) for n, _ in seqs} == dict(seqs)
    assert {r.chrom for r in sequences.read_twobit(spark, str(tmp_path / "g.2bit"), ["chr2"]).collect()} == {"chr2"}
    assert sequences.header(bytes.fromhex("1A41274300000001")) == (">", 1)
    with pytest.raises(ValueError):
        sequences.header(b"notatwob")


def test_sizes(spark, tmp_path):
    (tmp_path / "s").write_text("a\t5\tx\nb\t7\na\t9\n")
    assert [tuple(r) for r in sizes.read_sizes(spark, str(tmp_path / "s")).orderBy("ord").collect()] == [("a", 9, 0), ("b", 7, 1)]
    with pytest.raises(Exception, match="line 1"):
        sizes.read_sizes_strict(spark, str(tmp_path / "s")).collect()
    (tmp_path / "blank").write_text("a\t5\n\nb\t7\n")
    with pytest.raises(Exception, match="line 2"):
        sizes.read_sizes(spark, str(tmp_path / "blank")).collect()


def test_psl_round_trip(spark, tmp_path):
    line = "9\t1\t0\t0\t0\t0\t1\t3\t+\tq1\t100\t0\t10\tt1\t200\t5\t18\t2\t4,6,\t0,4,\t5,12,"
    (tmp_path / "a.psl").write_text("psLayout version 3\n\n" + line + "\n")
    got = chain_text.read_psl(spark, str(tmp_path / "a.psl"))
    assert got.first().t_starts == [5, 12]
    chain_text.write_psl(got, str(tmp_path / "out"), by="t_name")
    assert chain_text.read_psl(spark, str(tmp_path / "out" / "t_name=t1")).collect() == got.collect()


def test_manifest_and_lists(spark, tmp_path):
    (tmp_path / "m").write_text("a\t/a.fa\tb\t/b.fa\n")
    assert chain_text.read_manifest(spark, str(tmp_path / "m")).count() == 1
    (tmp_path / "bad").write_text("a\t/a.fa\t\t/b.fa\n")
    with pytest.raises(Exception, match="four fields"):
        chain_text.read_manifest(spark, str(tmp_path / "bad")).collect()
    (tmp_path / "l").write_text("x.2bit:chr1:9\n\n x.2bit:chr2 \n")
    assert [r.chrom for r in chain_text.read_list(spark, str(tmp_path / "l")).collect()] == ["chr1", "chr2"]


def test_bed(spark, tmp_path):
    rows = spark.createDataFrame([("c", 1, 5, "x")], "chrom string, start long, end long, name string")
    chain_text.write_bed(rows, str(tmp_path / "b"))
    assert chain_text.read_bed(spark, str(tmp_path / "b")).collect() == rows.collect()


def test_parameter_file(tmp_path):
    (tmp_path / "p.json").write_text('{"lastz_h": 0, "linear_gap": "medium",}')
    assert read_params(str(tmp_path / "p.json")).linear_gap == "medium"
    (tmp_path / "q.json").write_text(json.dumps([1]))
    with pytest.raises(ValueError):
        read_params(str(tmp_path / "q.json"))


def test_stream_takes_each_file_once(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "1.chain").write_text(CHAINS)
    args = (str(src), str(tmp_path / "out"), str(tmp_path / "cp"))
    ingest.ingest(spark, *args).awaitTermination()
    (src / "2.chain").write_text(CHAINS)
    ingest.ingest(spark, *args).awaitTermination()
    got = spark.read.parquet(args[1])
    assert got.count() == 4
    assert {r.t_name: r.chains for r in ingest.totals(got).collect()} == {"chr1": 2, "chr2": 2}
    assert got.agg(F.max("score")).first()[0] == 300


def test_twobit_of_chunks_and_lists(spark, tmp_path):
    import random

    rng = random.Random(9)
    seqs = {f"c{i:02d}": "".join(rng.choice("ACGTacgtNn") * rng.randrange(1, 9) for _ in range(rng.randrange(0, 400))) for i in range(9)}
    rows = [(c, i, s[i : i + 37]) for c, s in seqs.items() for i in range(0, max(len(s), 1), 37)]
    rng.shuffle(rows)
    path = f"file://{tmp_path}/all.2bit"
    sequences.write_twobit(spark.createDataFrame(rows, "chrom string, chunk_start long, seq string"), path)
    whole = lambda df: {r.chrom: "".join(x.seq for x in sorted(r.parts, key=lambda x: x.chunk_start)) for r in df.groupBy("chrom").agg(F.collect_list(F.struct("chunk_start", "seq")).alias("parts")).collect()}
    assert whole(sequences.read_twobit(spark, path, chunk=64)) == seqs
    assert sorted(x.name for x in tmp_path.iterdir()) == ["all.2bit"]
    (tmp_path / "some.fa").write_text(">x\nACGT\n>y\nGGTT\n")
    (tmp_path / "a.lst").write_text(f"{path.removeprefix('file://')}:c03\n\n{path.removeprefix('file://')}:c05:ignored\n{tmp_path}/some.fa:y\n")
    got = whole(sequences.read_listed(spark, chain_text.read_list(spark, str(tmp_path / "a.lst"))))
    assert got == {"c03": seqs["c03"], "c05": seqs["c05"], "y": "GGTT"}
    (tmp_path / "b.lst").write_text(f"{tmp_path}/some.fa\n{tmp_path}/some.fa:y\n")
    assert whole(sequences.read_listed(spark, chain_text.read_list(spark, str(tmp_path / "b.lst")))) == {"x": "ACGT", "y": "GGTT"}


def test_partition_list_in_order_and_appended(spark, tmp_path):
    from chainspark.operators import partition

    s = spark.createDataFrame([("big", 2500, 0), ("small", 100, 1), ("mid", 1200, 2), ("tiny", 50, 3)], "chrom string, size long, ord long")
    want = ["g:big:0-1000", "g:big:1000-2000", "g:big:2000-2500", "g:mid:0-1000", "g:mid:1000-1200", "BULK_1:g:small:tiny"]
    for _ in range(2):
        chain_text.write_partitions(partition.ordered(s, 1000, 0, "g"), str(tmp_path / "p"), mode="append")
    lines = [x for f in sorted((tmp_path / "p").glob("part-*")) for x in f.read_text().splitlines()]
    assert sorted(lines) == sorted(want * 2)
    chain_text.write_partitions(partition.ordered(s, 1000, 0, "g"), str(tmp_path / "q"))
    assert [x for f in sorted((tmp_path / "q").glob("part-*")) for x in f.read_text().splitlines()] == want


def test_bundles_are_folders(spark, tmp_path):
    from chainspark.operators import bundle
    from chainspark.schemas import PSL

    row = lambda name: (9, 1, 0, 0, 0, 0, 0, 0, "+", "q", 50, 0, 10, name, 99, 5, 15, 1, [10], [0], [5])
    rows = spark.createDataFrame([row("a"), row("a"), row("b"), row("c"), row("nowhere")], PSL)
    s = spark.createDataFrame([("a", 10, 0), ("b", 20, 1), ("c", 5, 2), ("d", 9, 3)], "chrom string, size long, ord long")
    put = bundle.bundles(s, rows.select(F.col("t_name").alias("chrom")), 12)
    chain_text.write_psl(bundle.bundled_rows(rows, put), str(tmp_path / "b"), by="bundle")
    assert sorted(x.name for x in (tmp_path / "b").iterdir() if x.is_dir()) == ["bundle=0", "bundle=1"]
    assert sorted(r.t_name for r in chain_text.read_psl(spark, str(tmp_path / "b" / "bundle=1")).collect()) == ["a", "a", "c"]


def test_psl_of_blocks_by_hand(spark):
    from chainspark.operators import psl

    blocks = [(5, 2, 4, "ACGt", "ACCT"), (9, 8, 3, "NAC", "GAC")]
    df = spark.createDataFrame([("q", 40, "-", "t", 100, blocks)], "q_name string, q_size long, strand string, t_name string, t_size long, blocks array<struct<t:long,q:long,size:long,t_seq:string,q_seq:string>>")
    r = psl.from_blocks(df).first()
    assert (r.matches, r.mismatches, r.rep_matches, r.n_count) == (5, 1, 1, 1)
    assert (r.q_num_insert, r.q_base_insert, r.t_num_insert, r.t_base_insert) == (1, 2, 0, 0)
    assert (r.q_start, r.q_end, r.t_start, r.t_end) == (40 - 11, 40 - 2, 5, 12)
    assert (r.block_count, r.block_sizes, r.q_starts, r.t_starts) == (2, [4, 3], [2, 8], [5, 9])


def test_genome_store_opens_one_chromosome(spark, tmp_path):
    rows = [("a", 0, "ACGT"), ("a", 4, "GG"), ("b", 0, "TTT")]
    sequences.write_genome(spark.createDataFrame(rows, "chrom string, chunk_start long, seq string"), str(tmp_path / "g"))
    back = spark.read.parquet(str(tmp_path / "g"))
    one = back.where("chrom = 'a'")
    assert sorted((r.chrom, r.chunk_start, r.seq) for r in one.collect()) == rows[:2]
    assert {r.chrom: r["size"] for r in sequences.lengths(back).collect()} == {"a": 6, "b": 3}


AXT = """##a comment
0 t1 101 108 q1 11 17 + 500
ACGT-ACGT
ac-TTACG-

# another
1 t2 1 4 q 3 6 - -7
NNAC
ACAC

"""


def test_axt_text(spark, tmp_path):
    """Comments, gaps on both lines, unequal lines; text to blocks, and back to the same text."""
    from chainspark.sources import axt_text

    (tmp_path / "a.axt").write_text(AXT)
    rows = axt_text.read_axt(spark, str(tmp_path / "a.axt"))
    got = {r.t_name: r for r in axt_text.with_blocks(rows).collect()}
    assert [tuple(b) for b in got["t1"].blocks] == [(100, 10, 2, "AC", "ac"), (103, 12, 1, "T", "T"), (104, 14, 3, "ACG", "ACG")]
    assert (got["t2"].strand, got["t2"].score, [tuple(b)[:3] for b in got["t2"].blocks]) == ("-", -7, [(0, 2, 4)])
    axt_text.write_axt(rows, str(tmp_path / "out"))
    again = axt_text.read_axt(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows.collect()))
    bad = spark.createDataFrame([("5 t 1 4 q 1 3 + 1\nACGT\nACG\n",)], "value string")
    with pytest.raises(Exception, match="record 5"):
        axt_text.with_blocks(axt_text.parsed(bad)).collect()
    assert axt_text.parsed(spark.createDataFrame([("# only\n",), ("",)], "value string")).count() == 0


def test_alignments_to_axt_text(spark, tmp_path):
    from chainspark.sources import axt_text

    target, query = spark.createDataFrame([("t", "GGACGTTTACCA")], "chrom string, seq string"), spark.createDataFrame([("q", "ACTTGGACCA")], "chrom string, seq string")
    kind = "t_name string, q_name string, strand string, score long, blocks array<struct<t:long,q:long,size:long>>"
    one = spark.createDataFrame([("t", "q", "+", 9, [(2, 0, 2), (5, 2, 2), (8, 6, 4)]), ("t", "q", "+", 3, [])], kind)
    axt = axt_text.numbered(axt_text.gapped_lines(one, target, query))
    (r,) = axt.collect()
    assert (r.n, r.t_line, r.q_line) == (0, "ACGTTT--ACCA", "AC-TT-GGACCA")
    axt_text.write_axt(axt, str(tmp_path / "x"), gzip=False)
    back = axt_text.with_blocks(axt_text.read_axt(spark, str(tmp_path / "x"))).first()
    assert [tuple(b)[:3] for b in back.blocks] == [(2, 0, 2), (5, 2, 2), (8, 6, 4)] and (back.t_start, back.t_end) == (2, 12)


def test_score_files(spark, tmp_path):
    """Both layouts, any order of bases, gap costs, comments; a file that lacks a row."""
    from chainspark.functions import sequences

    one = "# scores\n  C A G T\nA -2 1 -3 -4\nC 5 -6 -7 -8\nG 9 8 7 6\nT 0 -1 2 3\ngap_open_penalty=11\ngap_extend_penalty = 2 # each\nhsp_threshold=3000\n"
    got = sequences.scoring_of(one)
    assert (got.of("A", "C"), got.of("A", "A"), got.of("C", "C"), got.of("T", "T"), got.of("G", "A")) == (-2, 1, 5, 3, 8)
    assert (got.gap_open, got.gap_extend) == (11, 2)
    (tmp_path / "s.q").write_text("A C G T\n91 -114 -31 -123\n-114 100 -125 -31\n-31 -125 100 -114\n-123 -31 -114 91\nO = 400, E = 30\n")
    assert sequences.read_scoring(spark, str(tmp_path / "s.q")) == sequences.DEFAULT
    with pytest.raises(ValueError, match="heading"):
        sequences.scoring_of("A C G T\n1 2 3 4\n")


def plain_fasta(text):
    """[name, bases] of each sequence, in order."""
    out = []
    for line in text.replace("\r", "").split("\n"):
        if line.startswith(">"):
            out.append([(line[1:].split() or [""])[0], ""])
        elif out:
            out[-1][1] += line
    return out


@pytest.mark.parametrize("split", [1, 7, 64, 1 << 20])
def test_fasta_splits_anywhere(spark, tmp_path, monkeypatch, split):
    """Ranges that begin inside headers, lines and line ends; empty sequences; a long one over many ranges."""
    monkeypatch.setattr(sequences, "SPLIT", split if split > 1 else 23)
    text = "noise\n>a some words\nACGT\nAC\n\n>b\r\nGG\r\nTT\r\n>>empty\n>long\n" + "ACGTTGCAAC\n" * 12 + ">last"
    if split > 7:
        text += "\nA"
    (tmp_path / "x.fa").write_text(text)
    got = {}
    for r in sequences.read_fasta(spark, str(tmp_path / "x.fa"), chunk=16).collect():
        got.setdefault(r.chrom, []).append((r.chunk_start, r.seq))
    assert {c: "".join(s for _, s in sorted(x)) for c, x in got.items()} == dict(plain_fasta(text))
    for x in got.values():  # chunks follow one another, none is too long
        at = 0
        for start, seq in sorted(x):
            assert start == at and len(seq) <= 16 and (seq or len(x) == 1)
            at += len(seq)


def test_twobit_splits_inside_a_sequence(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sequences, "SPLIT", 32)
    seqs = {"one": "acgtNNNNACGTTTGACCAnnacgtAC" * 9, "two": "N" * 50 + "ACGT", "none": "", "short": "ac"}
    (tmp_path / "g.2bit").write_bytes(sequences.encoded_twobit(list(seqs.items())))
    df = sequences.read_twobit(spark, str(tmp_path / "g.2bit"), chunk=16)
    rows = df.collect()
    assert {c: "".join(r.seq for r in sorted((r for r in rows if r.chrom == c), key=lambda r: r.chunk_start)) for c in seqs} == seqs
    assert df.rdd.getNumPartitions() > 4

def test_axt_blocks_a_bounded_stretch_at_a_time(spark):
    """Records are turned to blocks in pieces of bounded width, a wide one alone, with the blocks of a plain walk."""
    import random

    import numpy as np
    from chainspark.sources import axt_text

    assert list(axt_text.pieces(np.array([3, 8, 10, 30, 31]), 7)) == [(0, 2), (2, 3), (3, 4)]
    pick, rows = random.Random(5), []
    for i in range(3000):
        n = pick.randint(1, 40)
        rows.append((i, i, 2 * i, "".join(pick.choices("ACGt-", k=n)), "".join(pick.choices("ACgT-", k=n))))
    got = axt_text.with_blocks(spark.createDataFrame(rows, "n long, t_start long, q_start long, t_line string, q_line string"))
    found = {r.n: [tuple(b) for b in r.blocks] for r in got.collect()}
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
    for i, t, q, t_line, q_line in rows:
        want, on = [], False
        for x, y in zip(t_line, q_line, strict=True):
            both = x != "-" and y != "-"
            if both and on:
                want[-1] = (*want[-1][:2], want[-1][2] + 1, want[-1][3] + x, want[-1][4] + y)
            elif both:
                want.append((t, q, 1, x, y))
            on, t, q = both, t + (x != "-"), q + (y != "-")
        assert found[i] == want
