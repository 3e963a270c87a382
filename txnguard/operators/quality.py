"""Data-quality checks (Q1-Q5).

Each check is one aggregate per (table, column) and returns rows
`(table_name, check_name, column_name, violations, status)`; several checks union into one report.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.buckets import round_half_up
from txnguard.params import RISK_STATUS_VALUES


def _report(df: DataFrame, table: str, check: str, column: str, violations) -> DataFrame:
    return df.agg(violations.cast("long").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.col("violations"), F.lit(0).cast("long")).alias("violations"),
        F.when(F.coalesce(F.col("violations"), F.lit(0)) == 0, F.lit("pass"))
        .otherwise(F.lit("fail")).alias("status"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def violates(check: str, column: str, *args):
    """Whether a row violates a check that looks at one row."""
    c = F.col(column)
    if check == "not_null":
        return c.isNull()
    if check == "between":
        return c.isNotNull() & ((c < F.lit(args[0])) | (c > F.lit(args[1])))
    if check == "accepted_values":
        return c.isNotNull() & ~c.isin(*args[0])
    raise ValueError(check)


def not_null(df: DataFrame, table: str, column: str) -> DataFrame:
    return _report(df, table, "not_null", column,
                   F.sum(F.when(violates("not_null", column), 1).otherwise(0)))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once (NULLs are not_null's business)."""
    dup = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return _report(dup, table, "unique", column, F.sum(F.when(F.col("n") > 1, 1).otherwise(0)))


def in_range(df: DataFrame, table: str, column: str, lo: float, hi: float) -> DataFrame:
    bad = violates("between", column, lo, hi)
    return _report(df, table, "between", column, F.sum(F.when(bad, 1).otherwise(0)))


def accepted_values(df: DataFrame, table: str, column: str,
                    values=RISK_STATUS_VALUES) -> DataFrame:
    bad = violates("accepted_values", column, values)
    return _report(df, table, "accepted_values", column, F.sum(F.when(bad, 1).otherwise(0)))


def freshness(df: DataFrame, table: str, loaded_at_field: str, as_of: str,
              warn_minutes: int = 10, error_minutes: int = 60) -> DataFrame:
    """Age of max(loaded_at_field) at `as_of`: pass / warn / error (error also when empty)."""
    newest = df.agg(F.max(loaded_at_field).alias("newest"))
    age_min = ((F.unix_micros(F.to_timestamp(F.lit(as_of))) - F.unix_micros("newest"))
               / F.lit(60_000_000.0))
    return newest.select(
        F.lit(table).alias("table_name"), F.lit("freshness").alias("check_name"),
        F.lit(loaded_at_field).alias("column_name"),
        F.col("newest").cast("timestamp_ntz").alias("newest"),
        round_half_up(age_min, 2).alias("age_minutes"),
        F.when(F.col("newest").isNull() | (age_min >= F.lit(float(error_minutes))), F.lit("error"))
        .when(age_min >= F.lit(float(warn_minutes)), F.lit("warn"))
        .otherwise(F.lit("pass")).alias("status"))


# the checks declared on the three marts: (check, column, arguments)
MART_CHECKS = {
    "fct_fraud_daily": (("not_null", "txn_date"), ("unique", "txn_date"),
                        ("between", "fraud_rate_pct", 0, 100)),
    "fct_fraud_by_category": (("not_null", "category"), ("unique", "category")),
    "dim_fraud_customers": (("not_null", "customer_id"), ("unique", "customer_id"),
                            ("accepted_values", "risk_status", RISK_STATUS_VALUES)),
}


def checked(df: DataFrame, table: str, checks: tuple) -> DataFrame:
    """A report of checks of one table by reading it."""
    run = {"not_null": not_null, "unique": unique, "between": in_range,
           "accepted_values": accepted_values}
    return union_all([run[k](df, table, column, *args) for k, column, *args in checks])


MART_CHECK_KINDS = ("not_null", "unique", "range", "accepted")


def mart_check(kind: str, daily: DataFrame, category: DataFrame,
               customers: DataFrame) -> DataFrame:
    """One kind of the checks declared on the three marts."""
    if kind == "not_null":
        return union_all([not_null(daily, "fct_fraud_daily", "txn_date"),
                          not_null(category, "fct_fraud_by_category", "category"),
                          not_null(customers, "dim_fraud_customers", "customer_id")])
    if kind == "unique":
        return union_all([unique(daily, "fct_fraud_daily", "txn_date"),
                          unique(category, "fct_fraud_by_category", "category"),
                          unique(customers, "dim_fraud_customers", "customer_id")])
    if kind == "range":
        return in_range(daily, "fct_fraud_daily", "fraud_rate_pct", 0, 100)
    if kind == "accepted":
        return accepted_values(customers, "dim_fraud_customers", "risk_status")
    raise ValueError(kind)


def mart_checks(daily: DataFrame, category: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """All checks declared on the three marts, grouped by kind."""
    return {k: mart_check(k, daily, category, customers) for k in MART_CHECK_KINDS}
