"""Queries with SQL equal it on the smallest fixture; no query plans a cross join or a row UDF."""

import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck
from txnguard.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", list(ORACLE_SQL))
def test_query_matches_oracle(spark, con, key):
    status, detail = compare(spark, con, SF_SMALL, key)
    assert status == "OK", detail


@pytest.mark.parametrize("key", list(QUERIES))
def test_plan_has_no_cross_join_or_row_udf(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert bad not in plan, (key, bad)
