"""Writers: idempotent warehouse append, keyed upserts, incremental daily model."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from txnguard.operators import marts
from txnguard.operators.staging import stg_scored, to_warehouse
from txnguard.plans import sinks
from txnguard.plans.pipeline import Pipeline


def wh_batch(spark):
    return to_warehouse(Pipeline(spark, "/root/testdata/sf0.001").scored())


def test_append_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "scored_transactions")
    b = wh_batch(spark)
    sinks.append_warehouse(b, path, load_id=1)
    sinks.append_warehouse(b, path, load_id=1)           # replayed load: same files
    sinks.append_warehouse(b, path, load_id=2)           # the same rows again: all skipped
    t = spark.read.parquet(path)
    assert t.count() == 1000
    assert t.select("transaction_id").distinct().count() == 1000
    assert {"txn_date", "load_id"} <= set(t.columns)


def test_append_adds_only_new_keys(spark, scratch):
    path = os.path.join(scratch, "scored_transactions")
    b = wh_batch(spark)
    first = b.filter(F.col("event_time") < F.lit("2024-01-15").cast("timestamp"))
    sinks.append_warehouse(first, path, load_id=1)
    sinks.append_warehouse(b, path, load_id=2)
    t = spark.read.parquet(path)
    assert t.count() == 1000
    assert t.filter("load_id = '1'").count() == first.count()


def test_versions_last_write_wins_and_compaction(spark, scratch):
    path = os.path.join(scratch, "transactions")
    t = datetime(2024, 1, 1, 10)
    schema = "customer_id string, event_time timestamp, transaction_id string, fraud_score double"
    key = ("customer_id", "event_time", "transaction_id")
    day = lambda df: df.withColumn("event_date", F.to_date("event_time"))
    v1 = day(spark.createDataFrame([("c1", t, "t1", 0.1), ("c1", t, "t2", 0.2)], schema))
    v2 = day(spark.createDataFrame([("c1", t, "t1", 0.9)], schema))
    sinks.append_version(v1, path, "event_date", 1)
    sinks.append_version(v2, path, "event_date", 2)
    sinks.append_version(v2, path, "event_date", 2)                      # replay
    got = {r.transaction_id: r.fraud_score for r in sinks.read_latest(spark, path, key).collect()}
    assert got == {"t1": 0.9, "t2": 0.2}
    sinks.compact(spark, path, key, "event_date", [t.date()])
    assert spark.read.parquet(path).count() == 2                         # one row per key left
    again = {r.transaction_id: r.fraud_score
             for r in sinks.read_latest(spark, path, key).collect()}
    assert again == got


def test_incremental_daily(spark, scratch):
    path = os.path.join(scratch, "fct_fraud_daily")
    stg = stg_scored(wh_batch(spark))
    early = stg.filter(F.col("txn_date") <= F.lit("2024-01-10").cast("date"))
    sinks.write_incremental_daily(early, path, marts.fct_daily)
    assert spark.read.parquet(path).count() == 10
    # strict mode (the reference): the last loaded day is never redone
    strict_rows = sinks.incremental_rows(stg, spark.read.parquet(path), strict=True)
    assert strict_rows.agg(F.min("txn_date")).first()[0].isoformat() == "2024-01-11"
    # default: one day of lookback, so day 10 is recomputed with all its rows
    sinks.write_incremental_daily(stg, path, marts.fct_daily)
    full = spark.read.parquet(path)
    assert full.count() == 30
    assert full.agg(F.sum("total_transactions")).first()[0] == 1000


def test_incremental_empty_target_loads_all(spark):
    stg = stg_scored(wh_batch(spark))
    empty = marts.fct_daily(stg.filter("false"))
    assert sinks.incremental_rows(stg, empty).count() == 1000


def test_table_and_view_models(spark, scratch):
    path = os.path.join(scratch, "fct_fraud_by_category")
    stg = stg_scored(wh_batch(spark))
    sinks.write_table(marts.fct_category(stg), path, sort_cols=("fraud_rate_pct",))
    sinks.write_table(marts.fct_category(stg), path, sort_cols=("fraud_rate_pct",))  # rebuild
    assert spark.read.parquet(path).count() == 10
    sinks.register_view(stg, "stg_scored_transactions")
    n = spark.sql("select count(*) from stg_scored_transactions where risk_level = 'low'").first()[0]
    assert n == stg.filter("risk_level = 'low'").count()


def test_read_latest_with_partition_filter(spark, scratch):
    path = os.path.join(scratch, "alerts")
    schema = "alert_date date, scored_at timestamp, transaction_id string, fraud_score double"
    d1, d2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    rows = [(d1.date(), d1, "t1", 0.5), (d2.date(), d2, "t2", 0.6)]
    sinks.append_version(spark.createDataFrame(rows, schema), path, "alert_date", 1)
    sinks.append_version(spark.createDataFrame([(d2.date(), d2, "t2", 0.9)], schema), path,
                         "alert_date", 2)
    key = ("alert_date", "scored_at", "transaction_id")
    day2 = sinks.read_latest(spark, path, key, where=F.col("alert_date") == F.lit(d2.date()))
    assert [(r.transaction_id, r.fraud_score) for r in day2.collect()] == [("t2", 0.9)]
    plan = day2._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(alert_date" in plan


def test_lookup_expiry(spark, scratch):
    path = os.path.join(scratch, "transactions")
    schema = "customer_id string, event_time timestamp, transaction_id string, fraud_score double"
    key = ("customer_id", "event_time", "transaction_id")
    rows = [("c1", datetime(2024, 1, d, 10), f"t{d}", 0.1) for d in (1, 2, 20)]
    v = spark.createDataFrame(rows, schema).withColumn("event_date", F.to_date("event_time"))
    sinks.append_version(v, path, "event_date", 1)
    sinks.append_version(v.filter("transaction_id = 't20'").withColumn("fraud_score", F.lit(0.9)),
                         path, "event_date", 2)
    as_of = "2024-02-01 12:00:00"                      # 30 days before: 2024-01-02 12:00
    got = {r.transaction_id: r.fraud_score
           for r in sinks.read_latest(spark, path, key, as_of=as_of).collect()}
    assert got == {"t20": 0.9}
    assert {r.transaction_id for r in sinks.read_latest(
        spark, path, key, as_of="2024-02-01 09:00:00").collect()} == {"t2", "t20"}
    sinks.compact(spark, path, key, "event_date", ["2024-01-01", "2024-01-20"], as_of=as_of)
    left = spark.read.parquet(path)
    assert {r.transaction_id for r in left.collect()} == {"t2", "t20"} and left.count() == 2


def test_rows_the_table_cannot_hold_are_told_apart(spark):
    from txnguard.operators.staging import split_unfit
    scored = spark.createDataFrame(
        [("a", "c", 1.0, "US"), ("b", "c", 1e10, "US"), ("c", "c", 1.0, "TOOLONG")],
        "transaction_id string, customer_id string, amount double, country string").withColumns(
        {"event_time": F.current_timestamp(), "fraud_score": F.lit(0.5), "is_fraud": F.lit(False)})
    fit, unfit = split_unfit(scored)
    assert [r.transaction_id for r in to_warehouse(fit).collect()] == ["a"]
    assert {r.transaction_id: r.unfit_reason for r in unfit.collect()} == {
        "b": "amount_out_of_range", "c": "country_too_long"}


def test_the_earliest_of_repeated_keys_stays(spark, scratch):
    path = os.path.join(scratch, "scored_transactions")
    b = wh_batch(spark).filter("transaction_id = 'txn-00000007'")
    later = b.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 SECOND"))
    sinks.append_warehouse(later.unionByName(b).repartition(2), path, load_id=1)
    assert spark.read.parquet(path).select("event_time").collect() == b.select("event_time").collect()
