"""Every registered query against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQL[name]).fetchdf()
    assert compare(got, want) is None


def test_every_query_has_twin_or_is_listed():
    no_twin = set(E._QUERIES) - set(SQL)
    assert no_twin <= set(getattr(E, "ROWS_ONLY", ()))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["feature", "f_score"] and df.count() > 0
