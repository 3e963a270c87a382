"""Warehouse row contract (K4 + P11 defaults) and the staging view (P1-P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.buckets import amount_bucket, risk_level
from txnguard.params import LOOKUP_DEFAULTS, WAREHOUSE_DEFAULTS
from txnguard.schemas import AMOUNT_LIMIT, WAREHOUSE_VARCHAR_LIMITS

WAREHOUSE_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "merchant", "category", "country",
    "card_type", "fraud_score", "is_fraud", "rules_fired", "event_time", "scored_at", "loaded_at",
)
STAGING_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "merchant", "category", "country",
    "card_type", "fraud_score", "is_fraud", "rules_fired", "event_time", "scored_at",
    "txn_date", "txn_hour", "amount_bucket", "risk_level",
)


def _col_or_null(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill only values that are really missing (NULL or absent column)."""
    return df.withColumns({k: F.coalesce(_col_or_null(df, k), F.lit(v))
                           for k, v in defaults.items()})


def first_of_each(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the smallest by `order`, then by the other columns, so that every attempt
    of a task picks the same one. A partial aggregate: repeats shrink before they move."""
    keys = list(keys)
    rest = [*order, *[c for c in df.columns if c not in (*order, *keys)]]
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return least.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                          for c in df.columns])


def unfit_reason():
    """Why the warehouse table can't hold a scored row (amount or text too large); NULL if it can."""
    expr = F.when(~(F.abs(F.col("amount")) < F.lit(AMOUNT_LIMIT)), F.lit("amount_out_of_range"))
    for c, n in WAREHOUSE_VARCHAR_LIMITS.items():
        expr = expr.when(F.length(F.col(c)) > n, F.lit(f"{c}_too_long"))
    return expr


def split_unfit(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows for the warehouse, scored rows that its table can't hold, with the reason)."""
    full = scored.withColumns({c: F.lit(None).cast("string") for c in WAREHOUSE_VARCHAR_LIMITS
                               if c not in scored.columns})
    tagged = full.withColumn("unfit_reason", unfit_reason())
    fit = tagged.filter(F.col("unfit_reason").isNull()).select(*scored.columns)
    unfit = tagged.filter(F.col("unfit_reason").isNotNull()).select(
        "transaction_id", "customer_id", "amount", "event_time", "fraud_score", "is_fraud",
        "unfit_reason")
    return fit, unfit


def to_warehouse(scored: DataFrame, loaded_at=None) -> DataFrame:
    """Scored rows in the `scored_transactions` shape: decimals, defaults, load stamp.

    `event_time` comes from the row (or its ISO `timestamp` text), never defaulted.
    """
    df = with_defaults(scored, WAREHOUSE_DEFAULTS)
    if "event_time" in scored.columns:
        et = F.col("event_time")
    else:
        et = F.try_to_timestamp(_col_or_null(scored, "timestamp"))
    return df.select(
        F.col("transaction_id").cast("string"),
        F.col("customer_id").cast("string"),
        F.col("amount").cast("decimal(12,2)").alias("amount"),
        "currency", "merchant", "category", "country", "card_type",
        F.col("fraud_score").cast("decimal(6,4)").alias("fraud_score"),
        F.col("is_fraud").cast("boolean").alias("is_fraud"),
        F.col("rules_fired").cast("int").alias("rules_fired"),
        et.cast("timestamp").alias("event_time"),
        _col_or_null(scored, "scored_at").try_cast("timestamp").alias("scored_at"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at"),
    )


def to_lookup(scored: DataFrame) -> DataFrame:
    """Scored rows in the lookup-table shape (P12): event time falls back to scored_at,
    scored_at to now."""
    df = with_defaults(scored, LOOKUP_DEFAULTS)
    scored_at = F.coalesce(_col_or_null(scored, "scored_at").try_cast("timestamp"),
                           F.current_timestamp())
    event_time = F.coalesce(_col_or_null(scored, "event_time").try_cast("timestamp"), scored_at)
    return df.select(
        "customer_id", "transaction_id", F.col("amount").cast("double").alias("amount"),
        "merchant", "category", "country",
        F.col("fraud_score").cast("double").alias("fraud_score"), "is_fraud",
        event_time.alias("event_time"), scored_at.alias("scored_at"),
    )


def stg_scored(warehouse: DataFrame) -> DataFrame:
    """Staging view: the 13 warehouse columns plus date, hour, amount bucket, risk level."""
    return warehouse.select(
        *STAGING_COLUMNS[:13],
        F.to_date("event_time").alias("txn_date"),
        F.hour("event_time").alias("txn_hour"),
        amount_bucket(F.col("amount")).alias("amount_bucket"),
        risk_level(F.col("fraud_score")).alias("risk_level"),
    )
