"""Structured Streaming jobs (T1-T10, K1-K3, K8, K9).

Shape of the scoring job:

    raw (Kafka or files, `value` column)
      -> decode (one JSON parse per message), tag dead letters
      -> event-time watermark
      -> stateless score, or per-customer state + weighted rules
      -> one foreachBatch that persists the micro-batch once and writes every output

Dead letters ride along to the fan-out in every mode, so the source is read once. The rule engine has
two kinds of history: `state` keeps each customer in the state store (low latency; a customer's
rows of a micro-batch are one Python call), `store` scores a micro-batch as a load of the batch
plan over the history store (`StoreFanOut`), where a customer with any share of the rows is divided
by minute segments and rows.

Folder outputs of a micro-batch are overwritten under its batch id and tables are merged by key, so
a batch replayed after a failure (same id, same offsets from the checkpoint) leaves the same files.
Topic outputs are at-least-once: a replayed batch publishes its messages again, and consumers drop
repeats by transaction id. The job survives executor and driver restarts through its checkpoint.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators.history import exact_amount
from txnguard.operators.marts import batch_metrics, customer_window_stats
from txnguard.operators.scoring import apply_rules, rule_score, stateless_score
from txnguard.operators.staging import (first_of_each, split_unfit, stg_scored, to_lookup,
                                         to_warehouse)
from txnguard.operators.lookup import ALERT_KEY, LOOKUP_KEY, alerts_rows
from txnguard.params import RuleParams, StreamParams
from txnguard.operators.marts import fct_daily
from txnguard.plans.history_store import HistoryStore
from txnguard.plans.id_index import IdIndex
from txnguard.plans.sinks import (append_version, append_warehouse, delete_path, path_exists,
                                  refresh_daily_for_dates)
from txnguard.schemas import ALERT_FIELDS, SCORED_SCHEMA
from txnguard.session import checkpoint_root
from txnguard.sources import ingest
from txnguard.streaming.state import (DEAD, FULL_SCHEMA, GOOD, OUTPUT_SCHEMA, TXN_NAMES, UNITS,
                                      UNITS_PER_ONE, CustomerHistoryProcessor)

SCORED_MESSAGE_FIELDS = ("transaction_id", "customer_id", "amount", "merchant", "category",
                         "country", "fraud_score", "is_fraud", "scored_at", "currency",
                         "card_type", "rules_fired", "timestamp")


# -------------------------------------------------------------------------------------------
# Sources (S1, S4)
# -------------------------------------------------------------------------------------------

def read_text_stream(spark: SparkSession, path: str, max_files: int | None = None,
                     sp: StreamParams = StreamParams()) -> DataFrame:
    """A folder of JSON-lines files as a raw message stream (`value` column), with micro-batches
    capped at `max_files` files (`sp.max_files_per_trigger` by default)."""
    r = spark.readStream.format("text")
    limit = max_files or sp.max_files_per_trigger
    if limit:
        r = r.option("maxFilesPerTrigger", str(limit))
    return r.load(path)


def read_raw_topic(spark: SparkSession, bootstrap: str, topic: str = "txn.raw",
                   sp: StreamParams = StreamParams()) -> DataFrame:
    """S1/K9: the raw topic from the latest offset, tolerant of data loss, with micro-batches
    capped at `max_records_per_trigger` offsets."""
    return ingest.read_kafka_stream(spark, bootstrap, topic,
                                    max_offsets=sp.max_records_per_trigger)


def read_scored_stream(raw: DataFrame) -> DataFrame:
    """S4: the scored topic decoded with the scored-message schema."""
    return raw.select(F.from_json(F.col("value").cast("string"), SCORED_SCHEMA).alias("m")) \
        .select("m.*")


# -------------------------------------------------------------------------------------------
# Scoring streams
# -------------------------------------------------------------------------------------------

def tagged_stream(raw: DataFrame, sp: StreamParams) -> DataFrame:
    """Decoded messages with their dead-letter reason (NULL = good)."""
    dec = ingest.decode(raw)
    return dec.withColumn("dlq_reason", ingest.dlq_reason())


def stateless_stream(raw: DataFrame, sp: StreamParams = StreamParams()) -> DataFrame:
    """Decoded + tagged + stateless-scored; bad rows keep NULL scores and ride along to the
    fan-out, which routes them to the dead-letter output. No state, no shuffle."""
    t = tagged_stream(raw, sp).withWatermark("event_time", sp.watermark)
    return stateless_score(t, sp.stateless_threshold)


def rule_stream(raw: DataFrame, rp: RuleParams, sp: StreamParams = StreamParams(),
                with_dead: bool = False) -> DataFrame:
    """Good rows through per-customer state (T7, T10) and the weighted rules. With `with_dead` the
    other rows pass the state operator under salted keys, with value and dlq_reason."""
    units = (exact_amount() * UNITS_PER_ONE).cast("long").alias(UNITS)
    tagged = tagged_stream(raw, sp).withWatermark("event_time", sp.watermark)
    processor = CustomerHistoryProcessor(rp, sp.state_ttl_days, sp.allowed_lateness_minutes,
                                         sp.replay_minutes, with_dead)
    bad = F.col("dlq_reason").isNotNull()
    if with_dead:
        # the text travels for dead letters only
        salt = F.pmod(F.xxhash64("value"), F.lit(sp.dead_letter_keys)).cast("string")
        rows = tagged.select(
            *TXN_NAMES, units, F.when(bad, F.col("value")).alias("value"), "dlq_reason",
            F.when(bad, F.concat(F.lit(DEAD), salt))
            .otherwise(F.concat(F.lit(GOOD), F.col("customer_id"))).alias("state_key"))
        keyed, schema = rows.groupBy("state_key"), FULL_SCHEMA
    else:
        keyed = tagged.filter(~bad).select(*TXN_NAMES, units).groupBy("customer_id")
        schema = OUTPUT_SCHEMA
    hist = keyed.transformWithStateInPandas(processor, schema, "Append", "ProcessingTime")
    return apply_rules(hist, rp, stamp=True)


def dead_letter_stream(raw: DataFrame, sp: StreamParams = StreamParams()) -> DataFrame:
    t = tagged_stream(raw, sp).filter(F.col("dlq_reason").isNotNull())
    return t.select("value", F.col("dlq_reason").alias("reason"),
                    F.current_timestamp().alias("ingested_at"))


def windowed_customer_stats(good: DataFrame, sp: StreamParams = StreamParams()) -> DataFrame:
    """A1 on a stream: sliding windows closed by the watermark (append mode, T1/T2/T9)."""
    return customer_window_stats(good.withWatermark("event_time", sp.watermark),
                                 sp.window_length, sp.window_slide)


# -------------------------------------------------------------------------------------------
# foreachBatch fan-out (K1, K2, K4-K6, K8)
# -------------------------------------------------------------------------------------------

def scored_messages(scored: DataFrame) -> DataFrame:
    """K1/K10: key = customer_id, JSON value with every scored column the scorer produces
    (the rule engine adds rules_fired; the stateless scorer has none)."""
    fields = [c for c in SCORED_MESSAGE_FIELDS if c in scored.columns]
    return scored.select(F.col("customer_id").alias("key"),
                         F.to_json(F.struct(*fields)).alias("value"))


def alert_messages(scored: DataFrame) -> DataFrame:
    """K2: fraud rows only (P6: NULL is not fraud)."""
    return scored.filter(F.col("is_fraud")).select(
        F.col("customer_id").alias("key"), F.to_json(F.struct(*ALERT_FIELDS)).alias("value"))


def topic_frame(df: DataFrame) -> DataFrame:
    """What the topic writer gets: key, value, and every other column as a header."""
    extra = [c for c in df.columns if c not in ("key", "value")]
    if not extra:
        return df.select("key", "value")
    return df.select("key", "value", F.array(*[
        F.struct(F.lit(c).alias("key"), F.col(c).cast("string").cast("binary").alias("value"))
        for c in extra]).alias("headers"))


def dead_letters(rows: DataFrame) -> DataFrame:
    """K8: tagged rows with a reason, as messages without key."""
    return rows.filter(F.col("dlq_reason").isNotNull()).select(
        F.lit(None).cast("string").alias("key"), "value", F.col("dlq_reason").alias("reason"),
        F.current_timestamp().alias("ingested_at"))


TOPICS = {"scored": "txn.scored", "alerts": "txn.fraud_alerts", "dlq": "txn.dlq"}


@dataclass
class FanOut:
    """Writes one micro-batch to every output. Folder outputs are keyed by batch id and
    overwritten, tables are merged by key: replaying a batch changes nothing there. With `kafka`
    options the scored, alert and dead-letter messages go to topics, at least once."""

    root: str
    outputs: tuple = ("scored", "alerts", "warehouse", "lookup", "alert_table", "dlq")
    kafka: dict | None = None           # writer options, e.g. {"kafka.bootstrap.servers": ...}
    topics: dict = field(default_factory=lambda: dict(TOPICS))
    # The daily mart re-reads the touched days of the warehouse, so it is refreshed every
    # `mart_every` batches (about once a minute at 5-second triggers) and in the first batch after
    # a start, for all days that the stored log of touched days holds. A bounded run (`bounded`)
    # has no later batch to rely on and refreshes in every batch.
    mart_every: int = 12
    bounded: bool = False
    # Skip keys already stored for the touched days (reads their key column each batch). Turn
    # off when the source never repeats a transaction id: each batch then costs O(batch).
    warehouse_dedup: bool = True
    _started: bool = False

    def _emit(self, df: DataFrame, name: str, batch_id: int) -> None:
        if self.kafka:
            (topic_frame(df).write.format("kafka").options(**self.kafka)
             .option("topic", self.topics[name]).save())
        else:
            df.write.mode("overwrite").parquet(os.path.join(self.root, name, f"batch={batch_id}"))

    def _refresh_mart(self, spark: SparkSession, batch_id: int) -> None:
        """Rebuild the logged days; forget them only after that (a crash repeats the refresh)."""
        due = self.bounded or not self._started or batch_id % max(1, self.mart_every) == 0
        self._started = True
        log = os.path.join(self.root, "_touched_days")
        if not due or not path_exists(spark, log):
            return
        days = spark.read.schema("txn_date date, batch long").parquet(log)
        logged = [r[0] for r in days.select("batch").distinct().collect()]
        refresh_daily_for_dates(
            os.path.join(self.root, "scored_transactions"),
            os.path.join(self.root, "fct_fraud_daily"),
            sorted(r[0] for r in days.select("txn_date").distinct().collect()),
            lambda wh: fct_daily(stg_scored(wh)))
        for b in logged:
            delete_path(spark, os.path.join(log, f"batch={b}"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if not batch.isEmpty():        # else a watermark-only batch: nothing to write
                self._write(batch, batch_id)
            if "warehouse" in self.outputs and "daily_mart" in self.outputs:
                self._refresh_mart(batch.sparkSession, batch_id)
        finally:
            batch.unpersist()

    def _write(self, batch: DataFrame, batch_id: int) -> None:
        has_reason = "dlq_reason" in batch.columns
        good = batch.filter(F.col("dlq_reason").isNull()) if has_reason else batch
        if "scored" in self.outputs:
            self._emit(scored_messages(good), "scored", batch_id)
        if "alerts" in self.outputs:
            self._emit(alert_messages(good), "alerts", batch_id)
        if "dlq" in self.outputs and has_reason:
            self._emit(dead_letters(batch), "dlq", batch_id)
        if good.isEmpty():                 # only dead letters in this batch
            return
        if "metrics" in self.outputs and "scored_at" in good.columns:
            # A7 + A8 per micro-batch: one row, rewritten if the batch is replayed
            batch_metrics(good, batch_id).write.mode("overwrite").parquet(
                os.path.join(self.root, "metrics", f"batch={batch_id}"))
        if "warehouse" in self.outputs:
            if "daily_mart" in self.outputs:
                # logged before the rows are stored: a crash in between costs one refresh more
                (good.select(F.to_date("event_time").alias("txn_date")).distinct().coalesce(1)
                 .write.mode("overwrite")
                 .parquet(os.path.join(self.root, "_touched_days", f"batch={batch_id}")))
            fit, unfit = split_unfit(good)
            append_warehouse(to_warehouse(fit), os.path.join(self.root, "scored_transactions"),
                             load_id=batch_id, dedup=self.warehouse_dedup)
            unfit.write.mode("overwrite").parquet(
                os.path.join(self.root, "warehouse_unfit", f"batch={batch_id}"))
        if "lookup" in self.outputs:
            lk = to_lookup(good).withColumn("event_date", F.to_date("event_time"))
            append_version(lk, os.path.join(self.root, "transactions"), "event_date",
                           batch_id, sort_cols=LOOKUP_KEY)
        if "alert_table" in self.outputs:
            append_version(alerts_rows(to_lookup(good)),
                           os.path.join(self.root, "fraud_alerts"), "alert_date", batch_id,
                           sort_cols=ALERT_KEY)


@dataclass
class StoreFanOut(FanOut):
    """Scores each micro-batch as one load of the batch plan, then writes it to every output.

    Batch id n is load n + 1 of a history store and an id index below `root` (plans/history_store,
    plans/id_index): replays of known ids go, history continues from the store, and a batch that is
    run again after a failure replaces its own load. The batch plan divides a customer by segments
    of `segment_minutes` and by rows, so a customer with a third of a micro-batch is no task of its
    own, and late rows of any age see their exact history."""

    rules: RuleParams | None = None
    segment_minutes: int = 1
    fold_every: int = 8

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, load = batch.sparkSession, batch_id + 1
        rules = replace(self.rules, history_segment_minutes=self.segment_minutes)
        ids = IdIndex(spark, os.path.join(self.root, "_ids"), fold_every=self.fold_every)
        history = HistoryStore(spark, os.path.join(self.root, "_history"), rules, self.fold_every)
        if ids.store.is_final(load) or history.store.is_final(load):
            raise ValueError(f"batch {batch_id} is folded: the store belongs to another checkpoint")
        batch = batch.persist()
        once = first_of_each(batch.filter("dlq_reason is null").select(*TXN_NAMES),
                             ["transaction_id"], ["event_time", "customer_id"])
        rows = ids.new_rows(once, load).persist()
        try:
            scored = rule_score(rows, rules, stamp=True, past=history.past(rows, load))
            dead = batch.filter("dlq_reason is not null").select("value", "dlq_reason")
            super().__call__(scored.unionByName(dead, allowMissingColumns=True), batch_id)
            if not rows.isEmpty():
                ids.add(rows, load)
                history.add(rows, load)
            ids.fold_if_due()
            history.fold_if_due()
        finally:
            rows.unpersist()
            batch.unpersist()


def start(scored: DataFrame, fan_out: FanOut, name: str, sp: StreamParams = StreamParams(),
          available_now: bool = False, checkpoint: str | None = None):
    """Start the fan-out query (T3 append, T4 trigger, T5 checkpoint)."""
    spark = scored.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_root(spark), "streams", name)
    w = (scored.writeStream.queryName(name).outputMode("append")
         .option("checkpointLocation", ckpt).foreachBatch(fan_out))
    if not available_now:
        return w.trigger(processingTime=sp.scored_trigger).start()
    # A bounded run (availableNow) must stop when the input is drained; state operators in
    # processing-time mode would otherwise keep scheduling empty clean-up batches. The setting is
    # captured by the query at start, so it is restored right after.
    key = "spark.sql.streaming.noDataMicroBatches.enabled"
    old = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        return w.trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, old)


def start_pipeline(raw: DataFrame, root: str, rules: RuleParams | None = None,
                   sp: StreamParams = StreamParams(), available_now: bool = False,
                   outputs: tuple = ("scored", "alerts", "warehouse", "lookup", "alert_table",
                                     "daily_mart"),
                   checkpoint_base: str | None = None, kafka: dict | None = None,
                   topics: dict | None = None, history: str = "state") -> list:
    """Start the scoring job, one query that reads the source once; returns [query].

    With `kafka` (writer options) the scored, alert and dead-letter messages are published to
    `topics` (names by "scored", "alerts", "dlq"); else they go to folders below `root`.
    `rules=None` scores statelessly; else `history` says where the rule engine keeps its history
    ("state" or "store", see above)."""
    spark = raw.sparkSession
    base = checkpoint_base or os.path.join(checkpoint_root(spark), "streams")
    told = {"outputs": (*outputs, "dlq"), "kafka": kafka,
            "topics": {**TOPICS, **(topics or {})}, "bounded": available_now}
    if rules is None:
        stream, fan, name = stateless_stream(raw, sp), FanOut(root, **told), "stateless"
    elif history == "store":
        stream, name = tagged_stream(raw, sp), "rules_store"
        fan = StoreFanOut(root, rules=rules, **told)
    elif history == "state":
        stream, fan, name = rule_stream(raw, rules, sp, with_dead=True), FanOut(root, **told), "rules"
    else:
        raise ValueError(f"history {history!r}: 'state' or 'store'")
    return [start(stream, fan, name, sp, available_now, os.path.join(base, name))]


def start_console_alerts(scored: DataFrame, sp: StreamParams = StreamParams(),
                         checkpoint: str | None = None, available_now: bool = False):
    """K3: fraud rows to the console, untruncated, every 10 s (or once over the available input)."""
    spark = scored.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_root(spark), "streams", "console")
    w = (scored.filter(F.col("is_fraud")).writeStream.format("console")
         .option("truncate", "false").option("checkpointLocation", ckpt).outputMode("append"))
    if available_now:
        return w.trigger(availableNow=True).start()
    return w.trigger(processingTime=sp.console_trigger).start()


def dedup_replays(stream: DataFrame, sp: StreamParams = StreamParams()) -> DataFrame:
    """T10: drop replayed messages (same transaction_id) within the watermark."""
    return stream.withWatermark("event_time", sp.watermark).dropDuplicatesWithinWatermark(
        ["transaction_id"])
