"""Streaming: stream equals batch, restart and replay add nothing, DLQ, late rows, windows."""

import glob
import os
import shutil
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from txnguard.operators.scoring import rule_score
from txnguard.params import FIXTURE_PARAMS, StreamParams
from txnguard.sources.fixtures import load_transactions
from txnguard.sources.ingest import load_raw_messages
from txnguard.streaming import job


def day_files(spark, scratch, sf="/root/testdata/sf0.001", days=None):
    """Raw messages as one JSON-lines file per day, in event-time order."""
    src = os.path.join(scratch, "src")
    os.makedirs(src, exist_ok=True)
    raw = load_raw_messages(spark, sf).withColumn("d", F.to_date("publish_time"))
    all_days = [r.d for r in raw.select("d").distinct().orderBy("d").collect()]
    for i, d in enumerate(days or all_days):
        tmp = os.path.join(scratch, f"tmp{i}")
        raw.filter(F.col("d") == F.lit(d)).select(F.coalesce("value", F.lit("")).alias("value")) \
            .coalesce(1).write.text(tmp)
        for j, f in enumerate(sorted(glob.glob(os.path.join(tmp, "part-*")))):
            shutil.copy(f, os.path.join(src, f"day{i:03d}_{j}.json"))
    return src


def run(spark, scored, root, name, outputs):
    fo = job.FanOut(os.path.join(root, "out"), outputs=outputs, mart_every=1)
    q = job.start(scored, fo, name, available_now=True,
                  checkpoint=os.path.join(root, "ckpt", name))
    q.awaitTermination(300)
    return q


def test_rule_stream_equals_batch_and_replay_is_idempotent(spark, scratch):
    src = day_files(spark, scratch)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=7)
    q = run(spark, job.rule_stream(stream, FIXTURE_PARAMS), scratch, "rules",
            ("scored", "warehouse", "lookup", "alert_table", "daily_mart", "metrics"))
    assert q.lastProgress["batchId"] >= 3          # several micro-batches
    wh = spark.read.parquet(os.path.join(scratch, "out", "scored_transactions"))
    tx = load_transactions(spark, "/root/testdata/sf0.001")
    ok_ids = spark.read.parquet("/root/testdata/sf0.001/events.parquet") \
        .filter("event_type <> 'error'") \
        .select(F.concat(F.lit("txn-"), F.lpad(F.col("event_id").cast("string"), 8, "0"))
                .alias("transaction_id"))
    batch = rule_score(tx.join(ok_ids, "transaction_id", "left_semi"), FIXTURE_PARAMS)
    j = wh.join(batch.select("transaction_id", F.col("fraud_score").alias("b"),
                             F.col("rules_fired").alias("bf")), "transaction_id", "full_outer")
    assert wh.count() == batch.count() == 799
    assert j.filter((F.col("fraud_score").cast("double") != F.col("b"))
                    | (F.col("rules_fired") != F.col("bf"))
                    | F.col("b").isNull() | F.col("fraud_score").isNull()).count() == 0
    # restart from the checkpoint with nothing new: no batch, no new rows
    stream2 = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=7)
    run(spark, job.rule_stream(stream2, FIXTURE_PARAMS), scratch, "rules",
        ("scored", "warehouse", "lookup", "alert_table"))
    assert spark.read.parquet(os.path.join(scratch, "out", "scored_transactions")).count() == 799
    from txnguard.operators.lookup import LOOKUP_KEY
    from txnguard.plans.sinks import read_latest
    assert read_latest(spark, os.path.join(scratch, "out", "transactions"),
                       LOOKUP_KEY).count() == 799
    m = spark.read.parquet(os.path.join(scratch, "out", "metrics"))
    assert m.agg(F.sum("scored")).first()[0] == 799
    assert m.agg(F.sum("velocity_fired")).first()[0] == batch.filter("velocity_score > 0").count()
    # the daily mart maintained batch by batch equals the mart built from the whole table
    from txnguard.operators.marts import fct_daily
    from txnguard.operators.staging import stg_scored
    streamed = spark.read.parquet(os.path.join(scratch, "out", "fct_fraud_daily"))
    full = fct_daily(stg_scored(wh))
    cols = [c for c in full.columns]
    assert streamed.count() == full.count() == 30
    assert streamed.select(*cols).exceptAll(full.select(*cols)).count() == 0


def test_stateless_stream_routes_dead_letters(spark, scratch):
    src = day_files(spark, scratch)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=10)
    run(spark, job.stateless_stream(stream), scratch, "stateless", ("scored", "alerts", "dlq"))
    out = os.path.join(scratch, "out")
    scored = spark.read.parquet(os.path.join(out, "scored"))
    dead = spark.read.parquet(os.path.join(out, "dlq"))
    assert scored.count() + dead.count() == 1000
    assert dead.count() == 201
    # the reference's constants can never reach 0.7, so no alerts
    assert spark.read.parquet(os.path.join(out, "alerts")).count() == 0


def test_late_row_is_flagged(spark, scratch):
    src = os.path.join(scratch, "late")
    os.makedirs(src)
    t = datetime(2024, 1, 1, 12)
    msg = ('{{"transaction_id":"{i}","customer_id":"c","amount":1.0,'
           '"timestamp":"{ts}+00:00","country":"US"}}')
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(3):
            f.write(msg.format(i=f"a{i}", ts=(t + timedelta(minutes=i)).isoformat()) + "\n")
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write(msg.format(i="late", ts=(t - timedelta(minutes=30)).isoformat()) + "\n")
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=1)
    hist = job.rule_stream(stream, FIXTURE_PARAMS)
    q = (hist.writeStream.format("memory").queryName("late_rows")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True))
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        q = q.start()
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    q.awaitTermination(300)
    rows = {r.transaction_id: r for r in spark.sql("select * from late_rows").collect()}
    assert rows["late"].is_late is True
    assert rows["a2"].is_late is False and rows["a2"].prior_count == 2


def test_windowed_stats_close_with_watermark(spark, scratch):
    src = day_files(spark, scratch)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=10)
    good = job.tagged_stream(stream, StreamParams()).filter("dlq_reason is null")
    w = job.windowed_customer_stats(good)
    q = (w.writeStream.format("memory").queryName("win_stats").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ckw"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    n = spark.sql("select count(*) from win_stats").first()[0]
    # every good row lands in 10 sliding windows; the windows still open at the end stay out
    assert 0 < n <= 799 * 10
    bad = spark.sql("select count(*) from win_stats where window_end <= window_start").first()[0]
    assert bad == 0


def test_replay_dedup_within_watermark(spark, scratch):
    src = os.path.join(scratch, "dup")
    os.makedirs(src)
    line = ('{{"transaction_id":"{i}","customer_id":"c","amount":2.0,'
            '"timestamp":"2024-01-01T12:0{m}:00+00:00"}}')
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write("\n".join([line.format(i="x", m=0), line.format(i="y", m=1)]) + "\n")
    with open(os.path.join(src, "b.json"), "w") as f:       # replay of x, plus a new row
        f.write("\n".join([line.format(i="x", m=0), line.format(i="z", m=2)]) + "\n")
    good = job.tagged_stream(job.read_text_stream(spark, os.path.join(src, "*.json"), 1),
                             StreamParams()).filter("dlq_reason is null")
    q = (job.dedup_replays(good).select("transaction_id").writeStream.format("memory")
         .queryName("dedup_rows").option("checkpointLocation", os.path.join(scratch, "ckd"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    ids = sorted(r[0] for r in spark.sql("select * from dedup_rows").collect())
    assert ids == ["x", "y", "z"]


def test_scored_topic_roundtrip(spark):
    from txnguard.plans.pipeline import Pipeline
    scored = Pipeline(spark, "/root/testdata/sf0.001").scored()
    msgs = job.scored_messages(scored)
    back = job.read_scored_stream(msgs)
    row = back.orderBy("transaction_id").first()
    assert row.rules_fired is not None and row.timestamp.endswith("+00:00")
    assert back.count() == 1000


def test_mean_latency(spark):
    from txnguard.operators.marts import mean_latency_ms
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 0, 45000)),
                                (datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 0, 0, 55000))],
                               "event_time timestamp, scored_at timestamp")
    assert mean_latency_ms(df).first()[0] == 50.0


def test_streamed_windows_equal_batch_windows(spark, scratch):
    from txnguard.operators.marts import customer_window_stats
    from txnguard.sources import ingest
    src = day_files(spark, scratch)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=10)
    good = job.tagged_stream(stream, StreamParams()).filter("dlq_reason is null")
    q = (job.windowed_customer_stats(good).writeStream.format("memory").queryName("win_eq")
         .outputMode("append").option("checkpointLocation", os.path.join(scratch, "cke"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    streamed = spark.sql("select * from win_eq")
    dec = ingest.decode(ingest.load_raw_messages(spark, "/root/testdata/sf0.001"))
    batch = customer_window_stats(dec.withColumn("r", ingest.dlq_reason()).filter("r is null"))
    key = ["customer_id", "window_start"]
    diff = streamed.join(batch.select(*key, F.col("txn_count_10min").alias("b")), key, "left") \
        .filter("b is null or b <> txn_count_10min").count()
    assert streamed.count() > 0 and diff == 0


def test_start_pipeline_rules_writes_dead_letters(spark, scratch):
    src = day_files(spark, scratch)
    raw = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=15)
    out = os.path.join(scratch, "out")
    qs = job.start_pipeline(raw, out, FIXTURE_PARAMS, available_now=True,
                            outputs=("warehouse",),
                            checkpoint_base=os.path.join(scratch, "ck"))
    for q in qs:
        q.awaitTermination(300)
    assert spark.read.parquet(os.path.join(out, "scored_transactions")).count() == 799
    dead = spark.read.parquet(os.path.join(out, "dlq"))
    assert dead.count() == 201
    assert set(r.reason for r in dead.select("reason").distinct().collect()) == {
        "malformed_json", "null_message", "missing_amount", "missing_customer_id",
        "bad_timestamp"}


def test_console_alerts_run(spark, scratch):
    src = day_files(spark, scratch)
    raw = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=30)
    scored = job.stateless_stream(raw, StreamParams(stateless_threshold=0.3))
    q = job.start_console_alerts(scored, checkpoint=os.path.join(scratch, "ck_console"),
                                 available_now=True)
    assert q.awaitTermination(240)
    assert q.exception() is None


def test_late_and_tied_rows_within_lateness_match_batch(spark, scratch):
    from txnguard.operators.history import with_history
    src = os.path.join(scratch, "late_ok")
    os.makedirs(src)
    t = datetime(2024, 1, 1, 12)
    msg = ('{{"transaction_id":"{i}","customer_id":"c","amount":{a},'
           '"timestamp":"{ts}+00:00","country":"{c}"}}')
    first = [("a0", 0, 3.0, "US"), ("a1", 60, 2.0, "US"), ("a2", 120, 900.0, "CA")]
    second = [("late", -30, 4.0, "NG"), ("tie", 120, 1.0, "US"), ("next", 180, 2.0, "CA")]
    for name, rows in (("a.json", first), ("b.json", second)):
        with open(os.path.join(src, name), "w") as f:
            for i, secs, a, c in rows:
                f.write(msg.format(i=i, a=a, c=c, ts=(t + timedelta(seconds=secs)).isoformat()) + "\n")
    sp = StreamParams(allowed_lateness_minutes=60)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=1)
    q = (job.rule_stream(stream, FIXTURE_PARAMS, sp).writeStream.format("memory")
         .queryName("late_ok_rows").option("checkpointLocation", os.path.join(scratch, "ck2"))
         .trigger(availableNow=True))
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        q = q.start()
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    q.awaitTermination(300)
    got = {r.transaction_id: r for r in spark.sql("select * from late_ok_rows").collect()}
    schema = "transaction_id string, customer_id string, amount double, country string, event_time timestamp"
    rows = [(i, "c", a, c, t + timedelta(seconds=secs)) for i, secs, a, c in first + second]
    exp = {r.transaction_id: r for r in with_history(spark.createDataFrame(rows, schema),
                                                     FIXTURE_PARAMS).collect()}
    for k in ("late", "tie", "next"):
        g, e = got[k], exp[k]
        assert (g.recent_count, g.small_count, g.prior_count, g.has_history, g.is_new_country) == \
            (e.recent_count, e.small_count, e.prior_count, e.has_history, e.is_new_country), k
        assert abs(g.avg_amount - e.avg_amount) < 1e-12, k
    assert got["late"].is_late is False


def test_stateless_pipeline_all_outputs(spark, scratch):
    src = day_files(spark, scratch)
    raw = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=10)
    out = os.path.join(scratch, "out")
    qs = job.start_pipeline(raw, out, rules=None,
                            sp=StreamParams(stateless_threshold=0.3), available_now=True,
                            outputs=("scored", "alerts", "warehouse", "lookup", "alert_table",
                                     "daily_mart", "metrics"),
                            checkpoint_base=os.path.join(scratch, "ck"))
    for q in qs:
        assert q.awaitTermination(300)
        assert q.exception() is None
    wh = spark.read.parquet(os.path.join(out, "scored_transactions"))
    assert wh.count() == 799
    assert wh.filter("rules_fired <> 0").count() == 0          # the stateless scorer has none
    assert spark.read.parquet(os.path.join(out, "dlq")).count() == 201
    assert spark.read.parquet(os.path.join(out, "metrics")).agg(F.sum("scored")).first()[0] == 799
    assert spark.read.parquet(os.path.join(out, "fraud_alerts")).count() == \
        wh.filter("is_fraud").count()


def _message(i, ts, amount=1.0, country="US", customer="c"):
    return (f'{{"transaction_id":"{i}","customer_id":"{customer}","amount":{amount},'
            f'"timestamp":"{ts.isoformat()}+00:00","country":"{country}"}}\n')


def _write(src, name, *messages):
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, name), "w") as f:
        f.writelines(messages)


def _history_of(spark, src, scratch, sp, pause=0.0):
    """Rows of the rule stream over the files of `src`, one file per batch, `pause` s apart."""
    import time
    got = []

    def keep(batch, _):
        got.extend(batch.collect())
        time.sleep(pause)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=1)
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    spark.conf.set(key, "false")
    try:
        q = (job.rule_stream(stream, FIXTURE_PARAMS, sp).writeStream.foreachBatch(keep)
             .option("checkpointLocation", os.path.join(scratch, "ck"))
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set(key, "true")
    q.awaitTermination(300)
    return {r.transaction_id: r for r in got}


def test_active_customer_never_expires_and_idle_one_does_as_a_whole(spark, scratch):
    src = os.path.join(scratch, "ttl")
    t = datetime(2024, 1, 1, 12)
    # `c` is active in every batch; `idle` only in the first and the last
    for i in range(5):
        rows = [_message(f"c{i}", t + timedelta(minutes=i))]
        if i in (0, 4):
            rows.append(_message(f"i{i}", t + timedelta(minutes=i), customer="idle"))
        _write(src, f"{i}.json", *rows)
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    ttl = 9.0 / (24 * 3600)
    rows = _history_of(spark, src, scratch, StreamParams(state_ttl_days=ttl), pause=4.0)
    for i in range(1, 5):
        r = rows[f"c{i}"]
        assert (r.prior_count, r.recent_count, r.is_new_country) == (i, i, False)
    assert rows["i4"].prior_count == 0 and rows["i4"].is_new_country is True


def test_replays_change_nobodys_history(spark, scratch):
    src = os.path.join(scratch, "replay")
    t = datetime(2024, 1, 1, 12)
    first = [_message(f"t{i}", t + timedelta(minutes=i)) for i in range(3)]
    _write(src, "0.json", *first, first[1])
    _write(src, "1.json", *first, _message("t3", t + timedelta(minutes=3)))
    for i in range(2):
        os.utime(os.path.join(src, f"{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    rows = _history_of(spark, src, scratch, StreamParams())
    assert len(rows) == 4
    assert (rows["t3"].prior_count, rows["t3"].recent_count) == (3, 3)


def test_stream_means_equal_batch_for_odd_amounts(spark, scratch):
    src = os.path.join(scratch, "odd")
    t = datetime(2024, 1, 1, 12)
    amounts = [1.005, 2.675, 0.0001, 12345678.9015, 1.00005, 3.3333]
    _write(src, "0.json", *[_message(f"t{i}", t + timedelta(minutes=i), a)
                            for i, a in enumerate(amounts)])
    rows = _history_of(spark, src, scratch, StreamParams())
    tx = spark.createDataFrame(
        [(f"t{i}", "c", a, "US", t + timedelta(minutes=i), "x") for i, a in enumerate(amounts)],
        "transaction_id string, customer_id string, amount double, country string, "
        "event_time timestamp, timestamp string")
    for r in rule_score(tx, FIXTURE_PARAMS).collect():
        assert rows[r.transaction_id].avg_amount == r.avg_amount


def _days(spark, scratch, name="fct_fraud_daily"):
    return spark.read.parquet(os.path.join(scratch, "out", name)).agg(
        F.count(F.lit(1)), F.sum("total_transactions")).first()


def test_daily_mart_is_complete_with_default_settings(spark, scratch):
    src = day_files(spark, scratch)
    stream = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=4)
    for q in job.start_pipeline(stream, os.path.join(scratch, "out"), None, available_now=True,
                                checkpoint_base=os.path.join(scratch, "ck")):
        q.awaitTermination(300)
    assert tuple(_days(spark, scratch)) == (30, 799)


def test_daily_mart_catches_up_after_a_restart(spark, scratch):
    tx = job.stateless_score(load_transactions(spark, "/root/testdata/sf0.001"))
    day = F.to_date("event_time")
    root = os.path.join(scratch, "out")
    outputs = ("warehouse", "daily_mart")
    before = job.FanOut(root, outputs=outputs)
    for i, d in enumerate(["2024-01-01", "2024-01-02", "2024-01-03"]):
        before(tx.filter(day == d), 25 + i)            # none of these is a refresh but the first
    assert _days(spark, scratch)[0] == 1
    after = job.FanOut(root, outputs=outputs)          # the driver came back
    after(tx.limit(0), 28)                             # an empty batch is enough
    assert tuple(_days(spark, scratch)) == (3, tx.filter(day <= "2024-01-03").count())


def test_topic_frames(spark):
    tx = job.stateless_score(load_transactions(spark, "/root/testdata/sf0.001"), 0.1).limit(20)
    for rows in (job.scored_messages(tx), job.alert_messages(tx)):
        frame = job.topic_frame(rows)
        assert frame.columns == ["key", "value"] and frame.schema["key"].dataType.typeName() == "string"
        assert frame.filter("key is null or value is null").count() == 0
    dead = job.topic_frame(job.dead_letters(spark.createDataFrame(
        [("x", "malformed_json"), ("y", None)], "value string, dlq_reason string")))
    assert dead.columns == ["key", "value", "headers"]
    row, = dead.collect()
    assert row.key is None and row.value == "x"
    assert [(h.key, bytes(h.value)) for h in row.headers][0] == ("reason", b"malformed_json")
    assert row.headers[1].key == "ingested_at"


def test_pipeline_hands_topic_options_to_every_output(spark, scratch, monkeypatch):
    sent = []
    monkeypatch.setattr(job.FanOut, "_emit", lambda self, df, name, batch_id: sent.append(
        (name, self.kafka, self.topics[name], df.count())))
    src = day_files(spark, scratch)
    options = {"kafka.bootstrap.servers": "broker:9092"}
    for rules in (None, FIXTURE_PARAMS):
        sent.clear()
        stream = job.read_text_stream(spark, os.path.join(src, "*.json"))
        for q in job.start_pipeline(stream, os.path.join(scratch, f"out{rules is None}"), rules,
                                    available_now=True, outputs=("scored", "alerts"),
                                    checkpoint_base=os.path.join(scratch, f"ck{rules is None}"),
                                    kafka=options, topics={"dlq": "bad"}):
            q.awaitTermination(300)
        by_name = {n: (k, t) for n, k, t, _ in sent}
        assert by_name == {"scored": (options, "txn.scored"),
                           "alerts": (options, "txn.fraud_alerts"), "dlq": (options, "bad")}
        assert sum(c for n, _, _, c in sent if n == "dlq") == 201
        assert sum(c for n, _, _, c in sent if n == "scored") == 799


def scores_equal_batch(spark, root, sf="/root/testdata/sf0.001"):
    """The warehouse of a stream over all raw messages holds the batch scores."""
    from txnguard.sources import ingest
    good, _ = ingest.split_dead_letters(ingest.decode(load_raw_messages(spark, sf)))
    batch = rule_score(good, FIXTURE_PARAMS)
    wh = spark.read.parquet(os.path.join(root, "scored_transactions"))
    j = wh.join(batch.select("transaction_id", F.col("fraud_score").alias("b"),
                             F.col("rules_fired").alias("bf")), "transaction_id", "full_outer")
    assert wh.count() == batch.count() > 0
    assert j.filter((F.col("fraud_score").cast("double") != F.col("b"))
                    | (F.col("rules_fired") != F.col("bf"))
                    | F.col("b").isNull() | F.col("fraud_score").isNull()).count() == 0


def dead_letters_equal_split(spark, root, sf="/root/testdata/sf0.001"):
    from txnguard.sources import ingest
    _, dead = ingest.split_dead_letters(ingest.decode(load_raw_messages(spark, sf)))

    def rows(df):               # the text files of the source hold null messages as empty lines
        return sorted((r.value or "", r.reason) for r in df.select("value", "reason").collect())
    assert rows(spark.read.parquet(os.path.join(root, "dlq"))) == rows(dead)


def test_one_query_reads_the_source_once(spark, scratch):
    """Both kinds of history: one query, one source, batch scores and all dead letters."""
    src = day_files(spark, scratch)
    for history in ("state", "store"):
        raw = job.read_text_stream(spark, os.path.join(src, "*.json"), max_files=11)
        out = os.path.join(scratch, history)
        qs = job.start_pipeline(raw, out, FIXTURE_PARAMS, available_now=True,
                                outputs=("warehouse",), history=history,
                                checkpoint_base=os.path.join(scratch, "ck", history))
        assert len(qs) == 1
        qs[0].awaitTermination(600)
        assert qs[0].exception() is None
        assert all(len(p["sources"]) == 1 for p in qs[0].recentProgress)
        scores_equal_batch(spark, out)
        dead_letters_equal_split(spark, out)


def test_store_batches_drop_replays_and_can_be_run_again(spark, scratch):
    """Batches handed over twice, replays across batches, a folded batch refused."""
    rows = load_transactions(spark, "/root/testdata/sf0.001").select(*job.TXN_NAMES).withColumns(
        {"value": F.lit(None).cast("string"), "dlq_reason": F.lit(None).cast("string")}).cache()
    day = F.dayofmonth("event_time")
    fan = job.StoreFanOut(os.path.join(scratch, "s"), outputs=("warehouse",),
                          rules=FIXTURE_PARAMS, fold_every=1)
    cuts = [(0, 10), (10, 20), (20, 32)]
    for i, (a, b) in enumerate(cuts):
        part = rows.filter((day > a) & (day <= b))
        again = rows.filter((day > a - 2) & (day <= a))             # known ids of the last batch
        for _ in range(2 if i == 1 else 1):
            fan(part.unionByName(again).unionByName(part.limit(5)), i)
    wh = spark.read.parquet(os.path.join(scratch, "s", "scored_transactions"))
    want = rule_score(rows.select(*job.TXN_NAMES), FIXTURE_PARAMS)
    j = wh.join(want.select("transaction_id", F.col("fraud_score").alias("b")), "transaction_id",
                "full_outer")
    assert wh.count() == want.count() == 1000
    assert j.filter("b is null or cast(fraud_score as double) is distinct from b").count() == 0
    try:
        fan(rows.limit(3), 0)
        raise AssertionError("a folded batch was taken again")
    except ValueError:
        pass
    rows.unpersist()


def test_a_hot_customer_of_a_store_batch_is_divided(spark):
    """A customer with a third of a micro-batch of 20 minutes: its changes lie in many tasks."""
    from dataclasses import replace

    from txnguard.operators.history import history_tables
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("c"), F.col("id").cast("string"))).alias("customer_id"),
        (F.col("id") % 90).cast("double").alias("amount"), F.lit("US").alias("country"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 40_000)
        .alias("event_time"))
    changes = history_tables(rows, replace(FIXTURE_PARAMS, history_segment_minutes=1)).changes
    tasks = (changes.filter("who = 'hot'").repartition(16, "who", "seg")
             .groupBy(F.spark_partition_id()).count().collect())
    assert len(tasks) >= 10
    assert max(r["count"] for r in tasks) < 0.3 * sum(r["count"] for r in tasks)


def test_streamed_slides_are_the_state(spark, scratch):
    """Chained windows: the first aggregation keeps one row per customer and slide; late rows within
    the watermark count; every closed window equals the batch window."""
    from txnguard.operators.marts import customer_window_stats
    src = os.path.join(scratch, "w")
    os.makedirs(src)
    at = datetime(2024, 1, 1, 10, 0, 5)

    def put(name, minutes):
        with open(os.path.join(src, name), "w") as f:
            for i, m in enumerate(minutes):
                t = (at + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%S")
                f.write(f'{{"c": "a", "amount": {i + 0.5}, "t": "{t}"}}\n')
    put("a.json", [0, 0, 0, 1, 5, 5])
    put("b.json", [5.5, 4.9, 6])                         # one row is late, within the watermark
    put("c.json", [60])
    put("d.json", [120])
    schema = "c string, amount double, t timestamp"

    def rows(r):
        return r.schema(schema).json(src).selectExpr("c as customer_id", "amount",
                                                     "t as event_time")
    stream = rows(spark.readStream.option("maxFilesPerTrigger", 1))
    w = job.windowed_customer_stats(stream, StreamParams(watermark="2 minutes"))
    q = (w.writeStream.format("memory").queryName("win_chain").outputMode("append")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True)
         .start())
    q.awaitTermination(300)
    got = sorted(map(tuple, spark.sql("select * from win_chain where window_end < "
                                      "'2024-01-01 10:50'").collect()))
    want = sorted(map(tuple, customer_window_stats(rows(spark.read)).filter(
        "window_end < '2024-01-01 10:50'").collect()))
    assert got == want and len(want) >= 15
    slides = max(p["stateOperators"][-1]["numRowsTotal"] for p in q.recentProgress
                 if p["stateOperators"])
    assert len(q.recentProgress[0]["stateOperators"]) == 2 and slides <= 12
