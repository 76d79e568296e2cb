"""The driver's contract; the real tables are used where they are there."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.exists(DATA), reason="no tables here")


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@there
def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@there
@pytest.mark.parametrize("name", sorted(n for n in entry.queries()))
def test_query_runs(spark, name):
    df = entry.queries()[name](spark, DATA)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)
