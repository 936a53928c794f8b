"""Every registered query of the catalog against its DuckDB statement on
sf0.001."""

import pytest

import __spark_entry__ as entry
from starforge.compare import compare
from starforge.plans import catalog

QUERIES = catalog.queries()
ORACLE = catalog.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    res = compare(QUERIES[name](spark, sf_small), con, ORACLE[name])
    assert res["columns_match"], res
    assert res["rows_match"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "SK_CONTRATACAO"
    assert df.count() > 0
