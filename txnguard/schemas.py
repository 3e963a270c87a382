"""Schemas of the raw and the scored message, and the limits of the warehouse table."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Raw transaction message (fixed values: names and types of the message contract). `nullable=False` documents the contract; `from_json` does not enforce
# it, the dead-letter split does (sources/ingest.py).
TXN_SCHEMA = StructType([
    StructField("transaction_id", StringType(), False),
    StructField("customer_id", StringType(), False),
    StructField("amount", DoubleType(), False),
    StructField("currency", StringType(), True),
    StructField("merchant", StringType(), True),
    StructField("category", StringType(), True),
    StructField("country", StringType(), True),
    StructField("card_type", StringType(), True),
    StructField("card_last_four", StringType(), True),
    StructField("timestamp", StringType(), True),
    StructField("ip_address", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("is_online", BooleanType(), True),
    StructField("label", StringType(), True),
])
REQUIRED_FIELDS = ("transaction_id", "customer_id", "amount")
TXN_FIELDS = tuple(f.name for f in TXN_SCHEMA.fields)

# Scored message: the reference's nine fields plus the four it drops and its readers need.
SCORED_FIELDS = (
    "transaction_id", "customer_id", "amount", "merchant", "category", "country",
    "fraud_score", "is_fraud", "scored_at",
    "currency", "card_type", "rules_fired", "timestamp",
)
SCORED_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("merchant", StringType()),
    StructField("category", StringType()),
    StructField("country", StringType()),
    StructField("fraud_score", DoubleType()),
    StructField("is_fraud", BooleanType()),
    StructField("scored_at", StringType()),
    StructField("currency", StringType()),
    StructField("card_type", StringType()),
    StructField("rules_fired", IntegerType()),
    StructField("timestamp", StringType()),
])
ALERT_FIELDS = (
    "transaction_id", "customer_id", "amount", "merchant", "country", "fraud_score", "scored_at",
)

# Text widths of the warehouse table `scored_transactions` (fixed values).
WAREHOUSE_VARCHAR_LIMITS = {
    "transaction_id": 36, "customer_id": 36, "currency": 3, "merchant": 255,
    "category": 50, "country": 5, "card_type": 20,
}

# Largest magnitude a DECIMAL(12,2) amount can hold (exclusive).
AMOUNT_LIMIT = 1e10
# Amounts from here on are not scored: sums in units of 1/10,000 would leave exact arithmetic.
SCORABLE_AMOUNT = 1e14
