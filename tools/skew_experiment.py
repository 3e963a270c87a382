"""Hot-customer experiment: plain per-customer window vs the segmented history operator.

Derives a skewed input from `events` (copies of the table with shifted user ids, then one third of
all rows moved to a single customer), runs both plans on local[N] and reports wall time and the
longest task of each job from Spark's event log (written to a scratch folder).

Usage: python tools/skew_experiment.py [sf_dir] [copies]
"""
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from txnguard.operators.history import with_history  # noqa: E402
from txnguard.params import RuleParams  # noqa: E402
from txnguard.session import CORE_CONF  # noqa: E402
from txnguard.sources.fixtures import transactions_from_events  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    scratch = tempfile.mkdtemp(prefix="skew-")
    logs = os.path.join(scratch, "events")
    os.makedirs(logs)
    b = (SparkSession.builder.master("local[8]").appName("skew")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logs)
         .config("spark.eventLog.compress", "false")
         .config("spark.sql.shuffle.partitions", "64").config("spark.driver.memory", "8g"))
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    # keep the 64 hash partitions as they are, so the per-task record counts show the key
    # distribution rather than AQE's coalescing to the advisory size
    b = b.config("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    n_ev = ev.count()
    parts = [ev.select((F.col("event_id") + i * n_ev).alias("event_id"), "ts",
                       (F.col("user_id") + i * 1_000_000).alias("user_id"), "event_type", "value",
                       "props") for i in range(copies)]
    skewed = parts[0]
    for p in parts[1:]:
        skewed = skewed.unionByName(p)
    skewed = skewed.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0))
                               .otherwise(F.col("user_id")))
    path = os.path.join(scratch, "events_skewed.parquet")
    skewed.write.parquet(path)
    txns = transactions_from_events(spark.read.parquet(path))
    rows = txns.count()
    hot_rows = txns.filter(F.col("customer_id") == "cust-000000").count()

    p = RuleParams()
    wv = p.velocity_window_minutes * 60_000_000
    w = Window.partitionBy("customer_id").orderBy("us")
    plain = txns.withColumn("us", F.unix_micros("event_time")).select(
        "transaction_id",
        F.count(F.lit(1)).over(w.rangeBetween(-wv, -1)).alias("recent_count"),
        F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, -1)).alias("prior_count"))
    seg = with_history(txns, p).select("transaction_id", "recent_count", "prior_count")

    results = {}
    for name, df in (("plain_window", plain), ("segmented", seg), ("plain_window_2", plain),
                     ("segmented_2", seg)):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        results[name] = {"seconds": round(time.time() - t0, 2)}
    spark.sparkContext.setJobGroup("verify", "verify")
    diff = plain.join(seg, "transaction_id").filter(
        (plain.recent_count != seg.recent_count) | (plain.prior_count != seg.prior_count)).count()
    spark.stop()

    # per job group: longest task, and the most shuffle records any single task read (the skew)
    longest, most_read, stage_group, per_stage = {}, {}, {}, {}
    for f in glob.glob(os.path.join(logs, "**", "*"), recursive=True):
        if not os.path.isfile(f):
            continue
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                ev_type = e.get("Event")
                if ev_type == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = g
                elif ev_type == "SparkListenerTaskEnd":
                    g = stage_group.get(e["Stage ID"])
                    if not g:
                        continue
                    info = e["Task Info"]
                    longest[g] = max(longest.get(g, 0), info["Finish Time"] - info["Launch Time"])
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    most_read[g] = max(most_read.get(g, 0), m.get("Total Records Read", 0))
                    key = (g, e["Stage ID"])
                    rec, ms = per_stage.get(key, (0, 0))
                    per_stage[key] = (max(rec, m.get("Total Records Read", 0)),
                                      max(ms, info["Finish Time"] - info["Launch Time"]))
    for k in results:
        results[k]["longest_task_ms"] = longest.get(k)
        results[k]["max_shuffle_records_one_task"] = most_read.get(k)
    if os.environ.get("SKEW_DETAIL"):
        for (g, sid), (n, ms) in sorted(per_stage.items(), key=lambda kv: -kv[1][1])[:12]:
            print(g, "stage", sid, "max records read by one task", n, "longest task ms", ms)
    print(json.dumps({"rows": rows, "hot_customer_rows": hot_rows, "results": results,
                      "rows_differing": diff}))


if __name__ == "__main__":
    main()
