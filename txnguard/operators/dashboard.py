"""Dashboard panel queries (D1-D7) over the marts.

The "today" panels take the as-of date as a parameter: a job run for a given day gives the same
answer tomorrow. A missing day gives one row with NULL, as SQL `sum` over no rows does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.buckets import rate_severity
from txnguard.params import HIGH_RISK_STATUSES


def dash_rate(daily: DataFrame) -> DataFrame:
    return daily.select(F.col("txn_date").alias("time"), "fraud_rate_pct").orderBy("txn_date")


def _day_sum(daily: DataFrame, col: str, as_of: str) -> DataFrame:
    return daily.filter(F.col("txn_date") == F.to_date(F.lit(as_of))).agg(
        F.sum(col).alias("value"))


def dash_volume(daily: DataFrame, as_of: str) -> DataFrame:
    return _day_sum(daily, "total_transactions", as_of)


def dash_count(daily: DataFrame, as_of: str) -> DataFrame:
    return _day_sum(daily, "fraud_count", as_of)


def dash_amount(daily: DataFrame, as_of: str) -> DataFrame:
    return _day_sum(daily, "fraud_amount", as_of)


def dash_category(category: DataFrame) -> DataFrame:
    return category.select("category", "fraud_rate_pct", "fraud_count").orderBy(
        F.col("fraud_rate_pct").desc(), "category")


def dash_high_risk(customers: DataFrame, n: int = 20) -> DataFrame:
    """Top-n blocked / high-risk customers by fraud count (TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task reach the final merge). Ties broken by customer_id."""
    return (customers.filter(F.col("risk_status").isin(*HIGH_RISK_STATUSES))
            .select("customer_id", "risk_status", "fraud_count", "fraud_amount", "avg_fraud_score")
            .orderBy(F.col("fraud_count").desc(), F.col("customer_id"))
            .limit(n))


def dash_severity(daily: DataFrame) -> DataFrame:
    return daily.select("txn_date", "fraud_rate_pct",
                        rate_severity(F.col("fraud_rate_pct")).alias("severity"))
