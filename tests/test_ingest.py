"""JSON decode, event-time parsing and the dead-letter split on hand-made messages."""

from pyspark.sql import functions as F

from txnguard.sources import ingest

VALID = ('{"transaction_id":"t1","customer_id":"c1","amount":12.5,"currency":"USD",'
         '"country":"US","timestamp":"2024-06-15T03:00:00+00:00","is_online":true}')


def decode_rows(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, value string")
    dec = ingest.decode(df, keep=("id",)).withColumn("reason", ingest.dlq_reason())
    return {r.id: r for r in dec.collect()}


def test_reasons(spark):
    msgs = [
        VALID,
        VALID[:30],                                             # truncated
        "not json at all",
        None,                                                   # null message
        VALID.replace('"amount":12.5,', ""),                    # missing amount
        VALID.replace('"amount":12.5', '"amount":"12.5"'),      # wrong type
        VALID.replace('"customer_id":"c1",', ""),               # missing customer
        VALID.replace("2024-06-15T03:00:00+00:00", "yesterday"),  # bad timestamp
        VALID.replace("+00:00", "Z"),
        VALID.replace("03:00:00+00:00", "03:00:00+05:00"),
        VALID.replace("03:00:00+00:00", "03:00:00.123456+00:00"),
        VALID.replace('"country":"US",', ""),                   # missing country is fine
        VALID.replace('"transaction_id":"t1",', ""),
        VALID.replace('"amount":12.5', '"amount":1e14'),             # beyond exact sums
        VALID.replace('"amount":12.5', '"amount":NaN'),
        VALID.replace('"amount":12.5', '"amount":1e12'),             # only the table can't hold it
        VALID.replace('"country":"US"', '"country":"' + "X" * 6 + '"'),  # nor this
    ]
    r = decode_rows(spark, msgs)
    assert [r[i].reason for i in range(len(msgs))] == [
        None, "malformed_json", "malformed_json", "null_message", "missing_amount",
        "malformed_json", "missing_customer_id", "bad_timestamp", None, None, None, None,
        "missing_transaction_id", "amount_out_of_range", "amount_out_of_range", None, None]
    # wrong-typed field: the other fields survive (partial result), the field is NULL
    assert r[5].customer_id == "c1" and r[5].amount is None
    # offsets are honoured: 03:00+05:00 is 22:00 UTC the day before
    assert str(r[9].event_time) == "2024-06-14 22:00:00"
    assert str(r[10].event_time) == "2024-06-15 03:00:00.123456"
    assert r[11].country is None


def test_split_routes_every_row_once(spark):
    raw = ingest.load_raw_messages(spark, "/root/testdata/sf0.001")
    good, dead = ingest.split_dead_letters(ingest.decode(raw))
    assert good.count() + dead.count() == raw.count()
    # all dead letters come from the 'error' events
    errors = spark.read.parquet("/root/testdata/sf0.001/events.parquet").filter(
        F.col("event_type") == "error").count()
    assert dead.count() == errors


def test_decode_parses_once(spark):
    raw = ingest.load_raw_messages(spark, "/root/testdata/sf0.001")
    _, dead = ingest.split_dead_letters(ingest.decode(raw))
    plan = dead._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_kafka_options_follow_the_reference():
    opts = ingest.kafka_options("broker:9092", "txn.raw", max_offsets=1000)
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "txn.raw",
                    "startingOffsets": "latest", "failOnDataLoss": "false",
                    "maxOffsetsPerTrigger": "1000"}
