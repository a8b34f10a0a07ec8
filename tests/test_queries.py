"""Every registered query against its DuckDB statement, columns and types included."""

import compare
import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
ORACLE = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_statement(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert dict(df.dtypes) == compare.duck_types(con, ORACLE[name])
    columns, rows = compare.spark_rows(df)
    expected_columns, expected = compare.duck_rows(con, ORACLE[name])
    assert columns == expected_columns
    assert rows == expected
    assert rows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_file_queries_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["nu_terminal", "nome_prestadora", "ind_portado", "ind_designado"]
    assert df.count() > 0
