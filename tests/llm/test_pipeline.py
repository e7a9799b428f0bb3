"""The pipeline's stages on a small corpus, each against a plain view of its own input."""

import os

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_stages(spark, tmp_path):
    from chainspark.llm import secret_scan

    from .test_operators import plain_components, plain_ids

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert after.columns == corpus_pipeline.COLUMNS
        kept[name] = (docs.collect(), after.collect())
        docs = after
    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    stay = {r.doc_id for r in after}
    assert np.mean([(r.doc_id in stay) == bool(labels[r.doc_id]) for r in before if r.doc_id in labels]) > 0.95
    before, after = kept["minhash_dedup"]
    assert {r.doc_id for r in after} == {root for _, root in plain_components([(r.doc_id, r.text, None) for r in before]).values()}
    before, after = kept["decontaminate"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if not any(x in " ".join(r.text.lower().split()) for x in items)}
    before, after = kept["secrets"]
    assert {r.doc_id: r.text for r in after} == {r.doc_id: secret_scan.redacted(r.text) for r in before}
    before, after = kept["packing"]
    for r in before:
        pieces = sorted((p for p in after if p.doc_id == r.doc_id), key=lambda p: p.start)
        assert [x for p in pieces for x in np.frombuffer(p.ids, "<u2").tolist()] == plain_ids(r.text, 1)


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def test_rows_are_judged_by_their_own_text(spark, tmp_path):
    """Rows that share a doc_id or have none, nulls, repeated rows, extra columns, empty tables."""
    import random

    rng = random.Random(5)
    say = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    a, b, c, item = say(60), say(60), say(60), say(30)
    rows = [(1, a), (5, a), (5, b), (7, b), (None, b), (None, c), (9, c), (9, c), (11, None), (12, ""), (13, None), (None, f"{say(20)} {item}"), (14, f"{item} {say(20)}"), (14, say(50))]
    full = [(i, t, "en", "s", None if t is None else len(t), 1, "x") for i, t in rows]
    docs = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, row int, component_id string").repartition(3)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    stages = dict(corpus_pipeline.STAGES)
    assert names(stages["quality"](spark, docs, str(tmp_path))) == sorted(rows, key=str)
    kept = stages["minhash_dedup"](spark, docs, str(tmp_path))
    assert kept.columns == corpus_pipeline.COLUMNS
    assert names(kept) == sorted([(1, a), (5, b), (9, c), *rows[8:]], key=str)
    assert names(stages["decontaminate"](spark, docs, str(tmp_path))) == sorted([*rows[:11], rows[13]], key=str)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    docs.drop("row", "component_id").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {1, 5, 9, 11, 12, 13, 14}
