"""Lookup-store tables as DataFrames (K5-K7, O4, O5).

* `latest_n_per_customer`: `row_number() <= n` over event time descending. Spark plans it with
  a partial WindowGroupLimit before the exchange, so at most n rows per customer per map task
  cross the network even for a customer that holds a third of the data.
* `upsert_last_write`: keyed last-write-wins through `max_by` on the write version, a plain
  aggregate with partial aggregation; the key includes transaction_id, so it is not skewed.
* `customer_stats`: counters and sorted sets of countries and devices per customer, the reference's
  row shape. A set grows with the customer's distinct devices; batch loads store counters and one
  row per (customer, country or device) instead (plans/group_store.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.params import LOOKUP_RETENTION_DAYS

LOOKUP_KEY = ("customer_id", "event_time", "transaction_id")
ALERT_KEY = ("alert_date", "scored_at", "transaction_id")


def latest_n_per_customer(lookup: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy(F.col("event_time").desc(),
                                                  F.col("transaction_id").desc())
    return (lookup.withColumn("recency_rank", F.row_number().over(w))
            .filter(F.col("recency_rank") <= n))


def upsert_last_write(writes: DataFrame, key=LOOKUP_KEY, version: str = "write_version") -> DataFrame:
    """Collapse repeated writes of a key to the last one (highest `version`)."""
    value_cols = [c for c in writes.columns if c not in key and c != version]
    latest = writes.groupBy(*key).agg(
        F.max_by(F.struct(*value_cols, version), F.col(version)).alias("_v"))
    return latest.select(*key, *[F.col(f"_v.{c}").alias(c) for c in value_cols],
                         F.col(f"_v.{version}").alias(version))


def within_retention(lookup: DataFrame, as_of: str, days: int = LOOKUP_RETENTION_DAYS,
                     time_col: str = "event_time") -> DataFrame:
    """Row expiry: keep rows written (or, for replays, timed) within `days` of `as_of`."""
    return lookup.filter(F.col(time_col) > F.to_timestamp(F.lit(as_of)) - F.expr(
        f"INTERVAL {int(days)} DAYS"))


def alerts_rows(scored_lookup: DataFrame) -> DataFrame:
    """Fraud rows in the alert-table shape, partitioned by the date of scored_at."""
    return scored_lookup.filter(F.col("is_fraud")).select(
        F.to_date("scored_at").alias("alert_date"), "scored_at", "transaction_id", "customer_id",
        "amount", "fraud_score", "country", "merchant")


def alerts_by_day(alerts: DataFrame, day: str) -> DataFrame:
    """One day of alerts, newest first (partition filter reaches the scan when the table is
    partitioned by alert_date)."""
    return (alerts.filter(F.col("alert_date") == F.to_date(F.lit(day)))
            .orderBy(F.col("scored_at").desc(), F.col("transaction_id").desc()))


def customer_stats(scored: DataFrame) -> DataFrame:
    return scored.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.when(F.col("is_fraud"), 1).otherwise(0)).cast("long").alias("total_fraud"),
        F.max("event_time").alias("last_transaction_time"),
        F.sort_array(F.collect_set("country")).alias("known_countries"),
        F.sort_array(F.collect_set("device_id")).alias("known_devices"),
    )
