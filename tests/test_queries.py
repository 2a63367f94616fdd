"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import differs, sql_engine

FOLDER = os.environ.get("TABLES_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def engine():
    return sql_engine(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, engine, name):
    problem, _ = differs(spark, engine, name, FOLDER, entry.queries(), entry.oracle_sql())
    assert problem is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "line_count"] and df.count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
