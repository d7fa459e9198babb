"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from compare import compare, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
PLANS, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = PLANS[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert compare(df, duck(SF), SQL[name], may_be_empty=True) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["borough", "requests", "penalty_usd", "breach_pct", "agencies"]
    assert df.count() == 5


def test_every_sql_has_a_query():
    assert set(SQL) <= set(PLANS)
