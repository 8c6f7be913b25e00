"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from catalog.oracle import ORACLE
from catalog.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables here")
    return connect(sf_dir)


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert compare(df, duck, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert len(entry_points.entry(spark).collect()) == 1
