"""Transactions derived from the driver's `events` table (FIXTURES.md, "Transactions from events").

All derivation is column expressions on the scan, so it stays inside one codegen stage and the
scan only reads the five columns it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.params import CARD_TYPES, CATEGORIES, MERCHANTS
from txnguard.sources.tables import read_table

# Country derived from the integer `k` of `events.props`, upper bounds in order.
COUNTRY_BY_K = ((82, "US"), (85, "CA"), (88, "GB"), (91, "DE"), (93, "BR"), (96, "NG"), (98, "RU"))
COUNTRY_BY_K_ELSE = "CN"

TXN_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "merchant", "category", "country",
    "card_type", "device_id", "is_online", "timestamp", "event_time",
)


def _pick(values, idx: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[idx]


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds and an explicit UTC offset."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def country_from_k(k: Column) -> Column:
    expr = None
    for bound, name in COUNTRY_BY_K:
        expr = (F.when(k < bound, F.lit(name)) if expr is None
                else expr.when(k < bound, F.lit(name)))
    return expr.otherwise(F.lit(COUNTRY_BY_K_ELSE))


def transactions_from_events(events: DataFrame, keep: tuple = ()) -> DataFrame:
    """Transactions per FIXTURES.md; `keep` carries extra event columns along."""
    et = F.col("event_type")
    v = F.col("value")
    amount = (F.when(et == "click", F.greatest(F.lit(0.01), F.floor(v * 5) / 100))
              .when(et == "purchase", F.round(v * 60, 2))
              .otherwise(F.round(v * 10, 2)))
    k = F.get_json_object("props", "$.k").cast("int")
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        *keep,
        F.concat(F.lit("txn-"), F.lpad(F.col("event_id").cast("string"), 8, "0"))
        .alias("transaction_id"),
        F.concat(F.lit("cust-"), F.lpad(F.col("user_id").cast("string"), 6, "0"))
        .alias("customer_id"),
        amount.alias("amount"),
        F.lit("USD").alias("currency"),
        _pick(MERCHANTS, F.col("event_id") % len(MERCHANTS)).alias("merchant"),
        _pick(CATEGORIES, F.col("event_id") % len(CATEGORIES)).alias("category"),
        country_from_k(k).alias("country"),
        _pick(CARD_TYPES, F.col("user_id") % len(CARD_TYPES)).alias("card_type"),
        F.concat(F.lit("device_"), F.lpad(F.col("user_id").cast("string"), 4, "0"))
        .alias("device_id"),
        (F.col("event_id") % 5 < 3).alias("is_online"),
        iso_text(event_time).alias("timestamp"),
        event_time.alias("event_time"),
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"))
