"""Every registered query against its DuckDB oracle on the smallest test data."""

import os

import pytest

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _names():
    from ledgerline.plans.queries import QUERIES  # the corpus operators have tests of their own
    return sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    from tools.oracle_check import duck
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql
    from tools.oracle_check import compare
    res = compare(spark, SF, [name], con=con, verbose=False)[name]
    if name in oracle_sql():
        assert res[0] == "ok", res
    else:
        assert res[1] >= 0


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    from ledgerline.plans.queries import QUERIES
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["month_start", "plan_name", "mrr", "active_subscriptions"]
    assert df.count() > 0
