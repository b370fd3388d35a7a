"""Every registered query against DuckDB, or for rows where SQL has no counterpart."""

import oracle
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, duck, sf_dir, name):
    assert oracle.compare(spark, duck, QUERIES[name], SQL[name], sf_dir) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["dataset"] == "test" and 0 <= row["accuracy"] <= 1


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
