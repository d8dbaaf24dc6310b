"""Every registered query against its DuckDB oracle (sf0.001 here; the
CLI ``python tests/oracle_compare.py`` runs sf0.01)."""

import pytest

import __spark_entry__ as entry
from larch.plans.oracle import ORACLE
from larch.plans.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_registered():
    # A fitted model's error has no SQL; the rating tests check these.
    assert set(QUERIES) - set(ORACLE) == {"als_rmse", "als_bias_rmse"}
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, detail, _, _ = compare(spark, con, name, SF_SMALL, QUERIES[name], ORACLE[name])
    assert ok, detail


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "n"]
    assert 0 < df.count() <= 10
