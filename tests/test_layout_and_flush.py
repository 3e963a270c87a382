"""Bucketed tables run without an exchange; flushes by rows and by time."""

import json
import os
import time

from pyspark.sql import functions as F

from txnguard.operators import lookup, marts
from txnguard.operators.scoring import rule_score
from txnguard.operators.staging import stg_scored, to_lookup, to_warehouse
from txnguard.params import FIXTURE_PARAMS
from txnguard.plans.bucketed import (dim_customers_by_bucket, exchanges,
                                     write_bucketed)
from txnguard.sources.fixtures import load_transactions
from txnguard.streaming.flush import flushes


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_bucketed_tables_need_no_exchange(spark, scratch):
    scored = rule_score(load_transactions(spark, "/root/testdata/sf0.001"), FIXTURE_PARAMS,
                        stamp=False).withColumn("scored_at", F.col("event_time")).cache()
    wh = to_warehouse(scored, loaded_at=F.col("event_time"))
    made = {}
    for name, rows, build in (
            ("wh_by_customer", wh, lambda t: dim_customers_by_bucket(stg_scored(t))),
            ("scored_by_customer", scored.select("customer_id", "is_fraud", "event_time", "country",
                                                 "device_id"), lookup.customer_stats),
            ("lookup_by_customer", to_lookup(scored),
             lambda t: lookup.latest_n_per_customer(t, 3))):
        table = write_bucketed(rows, name, 4, path=f"{scratch}/{name}")
        made[name] = build(table)
        assert exchanges(build(rows)) > 0 and exchanges(made[name]) == 0, name
        same(made[name], build(rows))
        if name == "wh_by_customer":
            full = marts.dim_customers(stg_scored(rows))
            same(made[name].select(*sorted(full.columns)), full.select(*sorted(full.columns)))
        files = [f for f in table.inputFiles()]
        assert len(files) <= 4                                 # one file per bucket
        spark.sql(f"drop table {name}")
    scored.unpersist()


def source(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/.{name}", "w") as f:
        f.writelines(json.dumps({"k": i}) + "\n" for i in rows)
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def test_flush_by_rows_and_by_time(spark, scratch):
    """130 rows, then 30: full flushes come at once, the rest after the wait; no row twice."""
    src = f"{scratch}/src"
    source(src, "a.json", range(130))
    stream = spark.readStream.schema("k long").option("maxFilesPerTrigger", 1).json(src)
    q = (flushes(stream, 50, 3000, lanes=1).writeStream.format("memory").queryName("flushed")
         .option("checkpointLocation", f"{scratch}/ck").outputMode("append")
         .trigger(processingTime="500 milliseconds").start())
    try:
        def wait(n):
            end = time.time() + 90
            while spark.table("flushed").count() < n and time.time() < end:
                time.sleep(0.5)
        wait(130)
        source(src, "b.json", range(130, 160))
        wait(160)
    finally:
        q.stop()
    rows = [(r.flush, r.reason, r.pos, json.loads(r.row)["k"])
            for r in spark.table("flushed").collect()]
    assert sorted(k for *_, k in rows) == list(range(160))
    size = {}
    for flush, reason, _, _ in rows:
        size.setdefault((flush, reason), 0)
        size[flush, reason] += 1
    assert size == {(0, "rows"): 50, (1, "rows"): 50, (2, "time"): 30, (3, "time"): 30}
    assert sorted((f, p) for f, _, p, _ in rows) == [
        (f, p) for f, n in ((0, 50), (1, 50), (2, 30), (3, 30)) for p in range(n)]
