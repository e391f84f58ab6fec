"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_queries import compare, connect
from common import SF

ORACLE = contract.oracle_sql()
# Whole-stage and training queries are run by check_queries.py; here one model per family is enough.
SLOW = {"compare_stage", "interpret_stage", "nested_model_comparison", "partial_dependence_trees", "importance_stability"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert compare(got, con.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(ORACLE) - SLOW))
def test_runs(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["feature", "importance"] and out.count() == 5
