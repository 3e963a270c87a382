"""Every registered query equals its SQL oracle (DuckDB) on the smallest fixture."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck
from txnguard.plans.catalog import QUERIES

KEYS = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(KEYS) - set(oracle_sql()) == set()
    assert set(KEYS) <= set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    status, detail = compare(spark, con, SF_SMALL, key)
    assert status in ("OK", "ROWS_ONLY"), detail


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 1000
    assert "fraud_score" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_plan_has_no_cross_join_or_row_udf(spark, key):
    df = queries()[key](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
        assert bad not in plan, (key, bad)


def test_marts_keep_dates(spark):
    """The registered outputs hand dates over as timestamps; the tables keep them as dates."""
    from txnguard.plans.pipeline import Pipeline
    p = Pipeline(spark, SF_SMALL)
    assert dict(p.daily().dtypes)["txn_date"] == dict(p.staging().dtypes)["txn_date"] == "date"


def test_a_wrong_constant_shows(spark, con, monkeypatch):
    from txnguard.params import FIXTURE_PARAMS
    wrong = FIXTURE_PARAMS.with_(velocity_max_count=6)
    monkeypatch.setattr("txnguard.plans.catalog.FIXTURE_PARAMS", wrong)
    status, _ = compare(spark, con, SF_SMALL, "rule_velocity")
    assert status not in ("OK", "ROWS_ONLY")
