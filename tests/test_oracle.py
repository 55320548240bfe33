"""Every registered query against its DuckDB oracle on the smallest shared
tables (the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as E
from kredex.plans import registry
from oracle_check import compare, duck

QUERIES = registry.queries()
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    res = compare(spark, con, sf_dir, name, QUERIES[name], ORACLE.get(name))
    assert res["status"] in ("OK", "no-oracle"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cod_credito", "dias_mora_principal", "dias_mora_intereses"]
    assert df.count() > 0
