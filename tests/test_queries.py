import pytest

from genescreen.plans.queries import ORACLES, QUERIES
from oracle import differences


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, name):
    assert not differences(spark, QUERIES[name], ORACLES[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert not set(__spark_entry__.oracle_sql()) - set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["agg8_functional_redundancy", "joi3_extract_regions", "eva6_diagnose_missing", "fun1_funnel"])
def test_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
