"""Ingest: raw JSON messages -> typed transactions + dead letters (S1-S4, K8).

The parse step takes any DataFrame with a string/binary `value` column, so the same code runs
behind a Kafka stream, a file stream or a batch table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txnguard.schemas import REQUIRED_FIELDS, SCORABLE_AMOUNT, TXN_FIELDS, TXN_SCHEMA
from txnguard.sources.fixtures import transactions_from_events
from txnguard.sources.tables import read_table

CORRUPT = "_corrupt_record"
PARSE_SCHEMA = StructType(list(TXN_SCHEMA.fields) + [StructField(CORRUPT, StringType(), True)])

# Kinds of hand-made faults injected into the raw-message fixture for events of type 'error'.
FAULT_KINDS = ("truncated", "no_amount", "amount_as_text", "bad_timestamp", "no_customer",
               "not_json", "null_message")


# -------------------------------------------------------------------------------------------
# Sources
# -------------------------------------------------------------------------------------------

def kafka_options(bootstrap: str, topic: str, starting: str = "latest",
                  fail_on_data_loss: bool = False, max_offsets: int | None = None) -> dict:
    """Options of the reference's topic readers (start at latest, do not fail on data loss)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets:
        opts["maxOffsetsPerTrigger"] = str(max_offsets)
    return opts


def read_kafka_stream(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Raw topic as a stream of (key, value, ...). Needs the Kafka connector on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topic, **kw)).load()


# -------------------------------------------------------------------------------------------
# Raw-message fixture derived from `events`
# -------------------------------------------------------------------------------------------

def _q(s: Column) -> Column:
    return F.concat(F.lit('"'), s, F.lit('"'))


def txn_json_parts(amount_text: Column, ts_text: Column, with_amount: Column,
                   with_customer: Column) -> Column:
    """A transaction as JSON text, built by concatenation so its exact text is reproducible."""
    parts = [
        F.lit('{"transaction_id":'), _q(F.col("transaction_id")),
        F.when(with_customer, F.concat(F.lit(',"customer_id":'), _q(F.col("customer_id"))))
        .otherwise(F.lit("")),
        F.when(with_amount, F.concat(F.lit(',"amount":'), amount_text)).otherwise(F.lit("")),
        F.lit(',"currency":'), _q(F.col("currency")),
        F.lit(',"merchant":'), _q(F.col("merchant")),
        F.lit(',"category":'), _q(F.col("category")),
        F.lit(',"country":'), _q(F.col("country")),
        F.lit(',"card_type":'), _q(F.col("card_type")),
        F.lit(',"timestamp":'), _q(ts_text),
        F.lit(',"device_id":'), _q(F.col("device_id")),
        F.lit(',"is_online":'), F.when(F.col("is_online"), F.lit("true")).otherwise(F.lit("false")),
        F.lit("}"),
    ]
    return F.concat(*parts)


def raw_messages_from_events(events: DataFrame) -> DataFrame:
    """Every event becomes one message keyed by customer. Events of type 'error' carry one of
    the fault kinds, chosen by event_id; all others are valid JSON transactions. One projection
    of one scan."""
    tx = transactions_from_events(events, keep=("event_id", "event_type"))
    kind = F.when(F.col("event_type") == "error", F.col("event_id") % len(FAULT_KINDS))
    amt = F.format_string("%.2f", F.col("amount"))
    ts = F.col("timestamp")
    full = txn_json_parts(amt, ts, F.lit(True), F.lit(True))
    value = (
        F.when(kind.isNull(), full)
        .when(kind == 0, F.substring(full, 1, 40))
        .when(kind == 1, txn_json_parts(amt, ts, F.lit(False), F.lit(True)))
        .when(kind == 2, txn_json_parts(_q(amt), ts, F.lit(True), F.lit(True)))
        .when(kind == 3, txn_json_parts(amt, F.lit("not-a-time"), F.lit(True), F.lit(True)))
        .when(kind == 4, txn_json_parts(amt, ts, F.lit(True), F.lit(False)))
        .when(kind == 5, F.concat(F.lit("garbage:"), F.col("transaction_id")))
        .otherwise(F.lit(None).cast("string"))
    )
    return tx.select(F.col("customer_id").alias("key"), value.alias("value"),
                     F.col("event_id").alias("offset"), F.col("event_time").alias("publish_time"))


def load_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages_from_events(read_table(spark, sf_dir, "events"))


# -------------------------------------------------------------------------------------------
# Decode, event time, dead letters
# -------------------------------------------------------------------------------------------

def decode(raw: DataFrame, value_col: str = "value", keep: tuple = ()) -> DataFrame:
    """PERMISSIVE JSON decode with the fixed schema; malformed text lands in `_corrupt_record`.

    Adds `event_time` with `try_to_timestamp` (NULL for unparsable text instead of an error).

    The parse runs inside a one-row generator (`inline`): a later filter on decoded fields (the
    dead-letter split) cannot be pushed beneath a generator, so each message is parsed once.
    Pushed below a plain projection, the filter would carry its own copies of `from_json`."""
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, PARSE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    row = F.struct(*[F.col(k) for k in keep], text.alias("value"), parsed.alias("txn"))
    out = raw.select(F.inline(F.array(row)))
    return out.select(*keep, "value", *[F.col(f"txn.{f}").alias(f) for f in TXN_FIELDS],
                      F.col(f"txn.{CORRUPT}").alias(CORRUPT)).withColumn(
        "event_time", F.try_to_timestamp(F.col("timestamp")))


def dlq_reason() -> Column:
    """First failing check wins; NULL means the row is good.

    These are faults that make a message unscorable: malformed text, a missing required field, a
    time that can't be read, an amount that is no number or beyond exact arithmetic. What the
    warehouse table can't hold (long texts, amounts above its decimal) is scored all the same and
    told apart by the warehouse writer (operators/staging.py `unfit_reason`)."""
    blank = F.col("value").isNull() | (F.trim(F.col("value")) == "")
    expr = (F.when(blank, F.lit("null_message"))
            .when(F.col(CORRUPT).isNotNull(), F.lit("malformed_json")))
    for f in REQUIRED_FIELDS:
        expr = expr.when(F.col(f).isNull(), F.lit(f"missing_{f}"))
    expr = expr.when(F.col("event_time").isNull(), F.lit("bad_timestamp"))
    return expr.when(~(F.abs(F.col("amount")) < F.lit(SCORABLE_AMOUNT)),
                     F.lit("amount_out_of_range"))


def split_dead_letters(decoded: DataFrame, keep: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters). Both come from one projection of the same input; write them
    from one `foreachBatch` (or persist) so the source is read once."""
    tagged = decoded.withColumn("dlq_reason", dlq_reason())
    good = tagged.filter(F.col("dlq_reason").isNull()).drop("dlq_reason", CORRUPT)
    dead = tagged.filter(F.col("dlq_reason").isNotNull()).select(
        *keep, "value", F.col("dlq_reason").alias("reason"),
        F.current_timestamp().alias("ingested_at"))
    return good, dead
