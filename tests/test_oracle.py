"""Every registered query against its SQL on the smallest data."""

import re

import duckdb
import pytest
from oracle_check import differences, duck

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def text_queries():
    """Queries of the text operators: those SQL cannot say are tested against brute force in their own folder."""
    return {n for n in QUERIES if re.match(r"op\d+_", n) or n == "pipeline"}


def test_every_query_has_sql():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - text_queries() <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), SQL[name], con) == []


def test_the_comparison_notices_differences(spark):
    con = duckdb.connect()
    df = spark.sql("select 1 a, 2.5D b")
    assert differences(df, "select 1 a, 2.5::double b", con) == []
    for wrong in ("select 2 a, 2.5::double b", "select 1 a, 2.50001::double b", "select 1 c, 2.5::double b",
                  "select 1 a, 2.5::double b union all select 1, 2.5", "select '1' a, 2.5::double b"):
        assert differences(df, wrong, con) != []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
