"""The end-to-end batch job writes every table, and a rerun changes nothing."""

from pyspark.sql import functions as F

from txnguard.operators import marts
from txnguard.operators.lookup import customer_stats
from txnguard.operators.staging import stg_scored
from txnguard.plans.batch_job import TABLES, BatchJob, run_batch
from txnguard.sources.ingest import load_raw_messages


def counts(job):
    return {k: job.read(k).count() for k in TABLES}


def test_batch_job_end_to_end_and_rerun(spark, scratch):
    job = BatchJob(spark, scratch, run_id="1")
    run_batch(spark, "/root/testdata/sf0.001", scratch, run_id="1")
    first = counts(job)
    assert first["scored_transactions"] == 799
    assert first["dead_letters"] == 201
    assert first["transactions"] == 799
    assert first["fct_fraud_daily"] == 30
    assert first["fct_fraud_by_category"] == 10
    assert first["dim_fraud_customers"] == first["customer_stats"] == 15
    report = job.read("quality_report")
    assert {r.status for r in report.collect()} == {"pass"}
    daily_total = job.read("fct_fraud_daily").agg(
        F.sum("total_transactions")).first()[0]
    assert daily_total == 799
    # rerun: same tables
    run_batch(spark, "/root/testdata/sf0.001", scratch, run_id="1")
    assert counts(job) == first


def tables(spark, root):
    """Contents of the tables that must not depend on how the input was cut into loads."""
    job = BatchJob(spark, root)

    def rows(name, *drop):
        df = job.read(name).drop(*drop)
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return {
        "scored": rows("scored_transactions", "load_id", "loaded_at", "scored_at"),
        "daily": rows("fct_fraud_daily"), "category": rows("fct_fraud_by_category"),
        "customers": rows("dim_fraud_customers"), "stats": rows("customer_stats"),
        "sets": sorted(map(str, job.customer_sets(job.read("customer_stats")).collect())),
        "lookup": rows("transactions", "write_version", "scored_at"),
        "alerts": rows("fraud_alerts", "write_version", "scored_at", "alert_date"),
    }


def test_loads_add_up(spark, scratch):
    """Four loads equal one: in time order, with replays of earlier loads, repeats inside a load
    and a late day of customers who have nothing after it."""
    raw = load_raw_messages(spark, "/root/testdata/sf0.001").filter("value is not null")
    day = F.to_date("publish_time")
    late = (day == F.lit("2024-01-30").cast("date")) & F.col("value").contains("cust-000003")
    last = raw.filter((day >= "2024-01-30") & F.col("value").contains("cust-000003"))
    first = raw.filter((day <= "2024-01-10") & ~late)
    second = raw.filter((day > "2024-01-10") & (day <= "2024-01-20"))
    third = raw.filter((day > "2024-01-20") & ~late)
    one, many = f"{scratch}/one", f"{scratch}/many"
    BatchJob(spark, one, run_id="1").run(raw)
    BatchJob(spark, many, run_id="1").run(first)
    BatchJob(spark, many, run_id="2").run(second.unionByName(first.limit(50)))
    BatchJob(spark, many, run_id="3").run(third.unionByName(third.limit(20)))
    BatchJob(spark, many, run_id="4").run(last)
    a, b = tables(spark, one), tables(spark, many)
    for name in a:
        assert a[name] == b[name], name
    again = tables(spark, many)
    BatchJob(spark, many, run_id="4").run(last)
    assert tables(spark, many) == again


def rebuilt(spark, root):
    """The marts and stats built anew from all stored rows."""
    stg = stg_scored(spark.read.parquet(f"{root}/scored_transactions"))
    return {"fct_fraud_daily": marts.fct_daily(stg), "fct_fraud_by_category": marts.fct_category(stg),
            "dim_fraud_customers": marts.dim_customers(stg)}


def same_rows(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def test_marts_of_many_loads_equal_a_rebuild(spark, scratch):
    """Four loads with folds in between; a small one writes a part of the buckets only."""
    raw = load_raw_messages(spark, "/root/testdata/sf0.001").filter("value is not null")
    day = F.dayofmonth("publish_time")
    for i in range(3):
        BatchJob(spark, scratch, run_id=f"r{i}", fold_every=1, keep=1, buckets=8).run(
            raw.filter((day > i * 10) & (day <= i * 10 + 10)))
    job = BatchJob(spark, scratch, run_id="one customer", buckets=8)
    try:
        job.run(raw)
        raise AssertionError("a run id with a space was taken")
    except ValueError:
        pass
    job = BatchJob(spark, scratch, run_id="2024-01-31", fold_every=1, keep=1, buckets=8)
    before = {f for f in job._published("dim_fraud_customers").read().inputFiles()}
    job.run(raw.filter((day == 31) | ((day == 30) & F.col("value").contains("cust-000003"))))
    for name, df in rebuilt(spark, scratch).items():
        same_rows(job.read(name), df)
    stats = customer_stats(job.read("scored").withColumn("event_time", F.col("event_time")))
    same_rows(job.customer_sets(job.read("customer_stats")), stats)
    assert job.stores()["customers"].store.generation().number >= 2
    after = {f for f in job._published("dim_fraud_customers").read().inputFiles()}
    assert before & after or len(before) <= 1      # buckets the load doesn't touch stay


def test_run_ids_are_text(spark, scratch):
    """Ids that read as equal numbers, each run twice."""
    raw = load_raw_messages(spark, "/root/testdata/sf0.001").filter("value is not null")
    day = F.dayofmonth("publish_time")
    for i, run_id in enumerate(("01", "1")):
        part = raw.filter(day == i + 1)
        BatchJob(spark, scratch, run_id=run_id).run(part)
        first = tables(spark, scratch)
        BatchJob(spark, scratch, run_id=run_id).run(part)
        assert tables(spark, scratch) == first
        assert len(first["scored"]) > 0
