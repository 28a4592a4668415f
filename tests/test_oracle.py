"""Every registered query against its DuckDB statement on the smallest driver data."""
import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck, types_of

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_of_the_catalog_has_a_statement():
    from ledgerlake.catalog import QUERIES
    assert not set(QUERIES) - set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    r = compare(df, con, ORACLE[name])
    assert r["values_match"] and r["spark_rows"] == r["duck_rows"], r
    s, d = types_of(df, con, ORACLE[name])
    assert s == d


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 1
