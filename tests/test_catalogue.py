"""Every query with SQL gives the rows that DuckDB gives; the others run."""

import os

import duckdb
import pytest

from chainspark.plans.catalogue import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def rows(pdf, columns):
    return sorted(tuple(str(v) for v in r) for r in pdf[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA).toPandas()
    want = duck.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


@pytest.mark.parametrize("name", ["gapped_align", "axt_to_psl", "chain_dp", "repeat_fill"])
def test_runs(spark, name):
    QUERIES[name](spark, DATA).collect()


def test_bases_of_any_text(spark):
    """Each character is one base, whatever its bytes; text isn't walked by a pattern."""
    from chainspark.plans import adapters

    rows = spark.createDataFrame([("aé𝒳z\n# B\x00",), (None,), ("",), ("日本 xT",)], "text string")
    got = rows.select(adapters._bases(rows["text"]).alias("seq"))
    assert [r.seq for r in got.collect()] == ["ANNCNNACN".replace("AC", "Ac"), None, "", "NNAT" + adapters._TO[45]]
    assert "regexp" not in adapters.genome(spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
