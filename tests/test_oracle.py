"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle import compare, connect, spark_rows

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    if name in oracle_sql():
        assert compare(spark, duck, FOLDER, name, queries()[name], oracle_sql()[name]) is None
    else:
        assert spark_rows(queries()[name](spark, FOLDER))[1]


def test_entry(spark):
    assert entry(spark).columns == ["doc_id", "language", "line_count", "avg_line_length"]


def test_names():
    assert set(oracle_sql()) <= set(queries())
