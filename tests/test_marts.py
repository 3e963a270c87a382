"""Staging classifiers, marts, dashboard and quality checks: boundaries and invariants."""

import pytest
from pyspark.sql import functions as F

from txnguard.functions.buckets import amount_bucket, rate_severity, risk_level
from txnguard.operators import dashboard, marts, quality
from txnguard.plans.pipeline import Pipeline


@pytest.mark.parametrize("amount,bucket", [
    (5000.01, "very_high"), (5000.0, "high"), (1000.0, "medium"), (100.0, "low"),
    (10.0, "micro"), (None, "micro")])
def test_amount_bucket(spark, amount, bucket):
    df = spark.createDataFrame([(amount,)], "amount double")
    assert df.select(amount_bucket(F.col("amount"))).first()[0] == bucket


@pytest.mark.parametrize("score,level", [
    (0.9, "critical"), (0.8999, "high"), (0.7, "high"), (0.4, "medium"), (0.3999, "low"),
    (None, "low")])
def test_risk_level(spark, score, level):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(risk_level(F.col("s"))).first()[0] == level


@pytest.mark.parametrize("rate,sev", [(None, "green"), (2.99, "green"), (3.0, "yellow"),
                                      (5.0, "red")])
def test_severity(spark, rate, sev):
    df = spark.createDataFrame([(rate,)], "r double")
    assert df.select(rate_severity(F.col("r"))).first()[0] == sev


def stg_rows(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, fraud_score double, is_fraud boolean, "
                                       "amount double, country string, category string, "
                                       "merchant string, event_time timestamp, rules_fired int")


def test_risk_status_branches(spark):
    from datetime import datetime
    t = datetime(2024, 1, 1)
    rows = ([("blocked_by_max", 0.96, True, 1.0, "US", "gas", "m", t, 1)]
            + [("blocked_by_count", 0.7, True, 1.0, "US", "gas", "m", t, 1)] * 5
            + [("high_by_avg", 0.6, False, 1.0, "US", "gas", "m", t, 1)]
            + [("watch_by_count", 0.1, True, 1.0, "US", "gas", "m", t, 1)]
            + [("watch_by_avg", 0.3, False, 1.0, "US", "gas", "m", t, 1)]
            + [("clean", 0.29, False, 1.0, "US", "gas", "m", t, 1)])
    d = {r.customer_id: r.risk_status for r in marts.dim_customers(stg_rows(spark, rows)).collect()}
    assert d == {"blocked_by_max": "blocked", "blocked_by_count": "blocked",
                 "high_by_avg": "high_risk", "watch_by_count": "watch",
                 "watch_by_avg": "watch", "clean": "clean"}


def test_daily_totals_equal_row_count(spark):
    p = Pipeline(spark, "/root/testdata/sf0.001")
    daily = p.daily()
    assert daily.agg(F.sum("total_transactions")).first()[0] == 1000
    checks = quality.mart_checks(daily, p.category(), p.customers())
    for kind, df in checks.items():
        assert {r.status for r in df.collect()} == {"pass"}, kind


def test_dashboard_day_missing_gives_null(spark):
    p = Pipeline(spark, "/root/testdata/sf0.001")
    assert dashboard.dash_volume(p.daily(), "1999-01-01").first()["value"] is None


def test_freshness_levels(spark):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2024, 1, 1, 12, 0),)], "loaded_at timestamp")
    f = lambda as_of: quality.freshness(df, "t", "loaded_at", as_of).first().status  # noqa
    assert f("2024-01-01 12:05:00") == "pass"
    assert f("2024-01-01 12:10:00") == "warn"
    assert f("2024-01-01 13:00:00") == "error"
    empty = df.filter("false")
    assert quality.freshness(empty, "t", "loaded_at", "2024-01-01").first().status == "error"


def test_quality_detects_violations(spark):
    df = spark.createDataFrame([("a", 101.0), ("a", -1.0), (None, 5.0)], "k string, r double")
    assert quality.unique(df, "t", "k").first().violations == 1
    assert quality.not_null(df, "t", "k").first().violations == 1
    assert quality.in_range(df, "t", "r", 0, 100).first().violations == 2
