"""The driver's contract."""

import os

import pytest

import __spark_entry__ as entry


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "compare_summary" in entry.queries()


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
