"""CASE-style classifiers and rounding helpers shared by staging, marts and dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnguard.params import (
    AMOUNT_BUCKET_ELSE,
    AMOUNT_BUCKETS,
    RISK_LEVEL_ELSE,
    RISK_LEVELS,
    RISK_STATUS_ELSE,
    RISK_STATUS_STEPS,
    SEVERITY_ELSE,
    SEVERITY_STEPS,
)


def _chain(pairs, test, default) -> Column:
    expr = None
    for bound, label in pairs:
        cond = test(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def amount_bucket(amount: Column) -> Column:
    """Strict `>` boundaries; NULL falls through to the last bucket."""
    return _chain(AMOUNT_BUCKETS, lambda b: amount > F.lit(b), AMOUNT_BUCKET_ELSE)


def risk_level(score: Column) -> Column:
    """`>=` boundaries; NULL falls through to 'low'."""
    return _chain(RISK_LEVELS, lambda b: score >= F.lit(b), RISK_LEVEL_ELSE)


def rate_severity(rate_pct: Column) -> Column:
    return _chain(SEVERITY_STEPS, lambda b: rate_pct >= F.lit(b), SEVERITY_ELSE)


def risk_status(fraud_count: Column, max_score: Column, avg_score: Column) -> Column:
    """First match wins: blocked, high_risk, watch, clean."""
    expr = None
    for status, min_count, measure, min_score in RISK_STATUS_STEPS:
        score = max_score if measure == "max" else avg_score
        cond = (fraud_count >= min_count) | (score >= F.lit(min_score))
        expr = F.when(cond, F.lit(status)) if expr is None else expr.when(cond, F.lit(status))
    return expr.otherwise(F.lit(RISK_STATUS_ELSE))


def round_half_up(x: Column, digits: int) -> Column:
    """Half-up rounding of a double, in a form SQL engines evaluate identically."""
    scale = float(10 ** digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def exact_avg(col: Column, digits: int | None = None) -> Column:
    """Mean through an exact decimal sum, then one double division; NULL when no values.

    Summing decimals makes the result independent of partitioning and summation order.
    """
    s = F.sum(col.cast("decimal(18,4)")).cast("double")
    n = F.count(col)
    avg = s / F.nullif(n, F.lit(0))
    return avg if digits is None else round_half_up(avg, digits)


def pct(numer: Column, denom: Column, digits: int) -> Column:
    """numer / nullif(denom, 0) * 100, rounded half-up."""
    return round_half_up(numer.cast("double") / F.nullif(denom, F.lit(0)).cast("double")
                         * F.lit(100.0), digits)
