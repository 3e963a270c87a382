"""Registered queries: one lazy DataFrame per operator of the inventory.

Every query reads the driver's tables (through `Pipeline`) over their whole extent. Output
columns are named and typed so that the SQL oracle (plans/oracle.py) produces the same schema:
timestamps as timestamp_ntz, decimals as double, counts as bigint.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.buckets import amount_bucket, risk_level
from txnguard.functions.rules import own_offset_hour, round4
from txnguard.operators import dashboard, lookup, marts, quality
from txnguard.operators.scoring import explode_triggered, triggered_names
from txnguard.operators.history import history_tables, with_history
from txnguard.operators.staging import first_of_each, to_lookup, to_warehouse
from txnguard.params import FIXTURE_PARAMS, MartParams
from txnguard.plans import loads
from txnguard.plans.pipeline import Pipeline, shared_pipeline
from txnguard.schemas import SCORED_SCHEMA
from txnguard.sources import ingest
from txnguard.sources.fixtures import iso_text, transactions_from_events
from txnguard.sources.tables import read_table

RULE_NAMES = ("high_amount", "velocity", "geo_anomaly", "card_testing", "time_anomaly")
MART = MartParams()
# Scored messages of the reference carry these nine fields only.
REFERENCE_SCORED_FIELDS = ("transaction_id", "customer_id", "amount", "merchant", "category",
                           "country", "fraud_score", "is_fraud", "scored_at")


def ntz(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("timestamp_ntz")


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return shared_pipeline(spark, sf_dir, FIXTURE_PARAMS, MART)


# -- scoring ---------------------------------------------------------------------------------

def q_rule_score(spark, sf_dir):
    s = triggered_names(_p(spark, sf_dir).scored())
    return s.select("transaction_id", "customer_id", ntz("event_time").alias("event_time"),
                    "amount", "country",
                    *[round4(F.col(f"{n}_score")).alias(f"{n}_score") for n in RULE_NAMES],
                    "fraud_score", "is_fraud", F.col("rules_fired").cast("long").alias("rules_fired"),
                    "rules_triggered")


def _rule_q(name: str, *inputs: str):
    def q(spark, sf_dir):
        s = _p(spark, sf_dir).scored()
        return s.select("transaction_id", *inputs, round4(F.col(f"{name}_score")).alias("score"))
    return q


def q_triggered_rules(spark, sf_dir):
    return explode_triggered(_p(spark, sf_dir).scored(), keep=("transaction_id",)).select(
        "transaction_id", F.col("rule_pos").cast("long").alias("rule_pos"), "rule", "rule_score")


def q_stateless_score(spark, sf_dir):
    s = _p(spark, sf_dir).stateless()
    return s.select("transaction_id", "customer_id", "amount", "country", "is_online",
                    "amount_score", "time_score", "geo_score", "online_score", "fraud_score",
                    "is_fraud")


# -- history ---------------------------------------------------------------------------------

def _hist(spark, sf_dir) -> DataFrame:
    return _p(spark, sf_dir).history()


def q_hist_recent_count(spark, sf_dir):
    return _hist(spark, sf_dir).select("transaction_id", "customer_id",
                                       ntz("event_time").alias("event_time"), "recent_count")


def q_hist_small_count(spark, sf_dir):
    return _hist(spark, sf_dir).select("transaction_id", "amount", "small_count")


def q_hist_avg_amount(spark, sf_dir):
    return _hist(spark, sf_dir).select("transaction_id", "prior_count", "avg_amount")


def q_hist_new_country(spark, sf_dir):
    return _hist(spark, sf_dir).select("transaction_id", "country", "has_history",
                                       "is_new_country")


def q_hist_two_loads(spark, sf_dir):
    """The transactions in two loads, the second seeded with the tables the first leaves behind."""
    txns = _p(spark, sf_dir).transactions()
    cut = F.to_date("event_time") <= F.lit(MART.first_load_until).cast("date")
    first, second = txns.filter(cut), txns.filter(~cut)
    past = history_tables(first, FIXTURE_PARAMS)
    both = with_history(first, FIXTURE_PARAMS).unionByName(
        with_history(second, FIXTURE_PARAMS, past=past))
    return both.select("transaction_id", "recent_count", "small_count", "prior_count",
                       "avg_amount", "has_history", "is_new_country")


def q_hist_loads(spark, sf_dir):
    return loads.history_over_loads(_p(spark, sf_dir))


def q_dedup_loads(spark, sf_dir):
    return loads.accepted_over_loads(_p(spark, sf_dir))


def q_fct_category_loads(spark, sf_dir):
    return loads.categories_over_loads(_p(spark, sf_dir))


def q_dim_customers_loads(spark, sf_dir):
    d = loads.customers_over_loads(_p(spark, sf_dir))
    return d.withColumns({"first_transaction": ntz("first_transaction"),
                          "last_transaction": ntz("last_transaction")})


def q_dim_customers_bucketed(spark, sf_dir):
    d = loads.customers_by_bucket(_p(spark, sf_dir))
    return d.withColumns({"first_transaction": ntz("first_transaction"),
                          "last_transaction": ntz("last_transaction")})


def q_dedup_replays(spark, sf_dir):
    """Every third transaction sent again, an hour later by its own clock: the first of each stays
    and nobody's history counts a replay."""
    txns = _p(spark, sf_dir).transactions()
    again = (txns.filter(F.substring("transaction_id", -8, 8).cast("int") % 3 == 0)
             .withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 1 HOUR")))
    once = first_of_each(txns.unionByName(again), ["transaction_id"], ["event_time"])
    return with_history(once, FIXTURE_PARAMS).select(
        "transaction_id", ntz("event_time").alias("event_time"), "recent_count", "prior_count")


# -- ingest ----------------------------------------------------------------------------------

def _decoded(spark, sf_dir) -> DataFrame:
    return ingest.decode(ingest.load_raw_messages(spark, sf_dir), keep=("offset",))


def q_json_decode(spark, sf_dir):
    d = _decoded(spark, sf_dir)
    return d.select("offset", "transaction_id", "customer_id", "amount", "currency", "merchant",
                    "category", "country", "card_type", "timestamp", "device_id", "is_online",
                    ntz("event_time").alias("event_time"),
                    F.col(ingest.CORRUPT).isNotNull().alias("is_corrupt"))


def ts_text_variants(events: DataFrame) -> DataFrame:
    """Transactions whose ISO text comes in four producer styles (by event_id); 'error' events
    carry unparsable text."""
    tx = transactions_from_events(events, keep=("event_id", "event_type"))
    et = F.col("event_time")
    style = F.col("event_id") % 4
    text = (F.when(F.col("event_type") == "error", F.lit("not-a-time"))
            .when(style == 0, iso_text(et))
            .when(style == 1, F.concat(F.date_format(et, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                       F.lit("Z")))
            .when(style == 2, F.concat(F.date_format(et + F.expr("INTERVAL '5:30' HOUR TO MINUTE"),
                                                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                       F.lit("+05:30")))
            .otherwise(F.concat(F.date_format(et, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))))
    return tx.select("transaction_id", text.alias("ts_text"))


def q_event_time_parse(spark, sf_dir):
    v = ts_text_variants(read_table(spark, sf_dir, "events"))
    parsed = F.try_to_timestamp(F.col("ts_text"))
    return v.select("transaction_id", "ts_text", ntz(parsed).alias("event_time"),
                    own_offset_hour(F.col("ts_text")).cast("long").alias("own_hour"),
                    F.hour(parsed).cast("long").alias("utc_hour"))


def q_dlq_split(spark, sf_dir):
    _, dead = ingest.split_dead_letters(_decoded(spark, sf_dir), keep=("offset",))
    return dead.select("offset", "value", "reason")


def q_dlq_counts(spark, sf_dir):
    _, dead = ingest.split_dead_letters(_decoded(spark, sf_dir))
    return marts.dlq_counts(dead)


def scored_messages(stateless: DataFrame) -> DataFrame:
    """The reference's 9-field scored message (P14): key = customer, JSON value."""
    return stateless.select(
        F.col("customer_id").alias("key"),
        F.to_json(F.struct(*REFERENCE_SCORED_FIELDS)).alias("value"))


def q_scored_json(spark, sf_dir):
    return scored_messages(_p(spark, sf_dir).stateless())


def q_sink_defaults(spark, sf_dir):
    """Reference-shaped scored messages decoded by the warehouse sink: the keys the message lacks
    (currency, card_type, rules_fired) take the sink's defaults."""
    msgs = scored_messages(_p(spark, sf_dir).stateless())
    dec = msgs.select(F.from_json("value", SCORED_SCHEMA).alias("m")).select("m.*")
    wh = to_warehouse(dec, loaded_at=F.lit(None).cast("timestamp"))
    return wh.select("transaction_id", "customer_id", F.col("amount").cast("double").alias("amount"),
                     "currency", "merchant", "category", "country", "card_type",
                     F.col("fraud_score").cast("double").alias("fraud_score"), "is_fraud",
                     F.col("rules_fired").cast("long").alias("rules_fired"))


# -- staging ---------------------------------------------------------------------------------

def _stg(spark, sf_dir):
    return _p(spark, sf_dir).staging()


def q_stg_scored(spark, sf_dir):
    s = _stg(spark, sf_dir)
    return s.select("transaction_id", "customer_id", F.col("amount").cast("double").alias("amount"),
                    "currency", "merchant", "category", "country", "card_type",
                    F.col("fraud_score").cast("double").alias("fraud_score"), "is_fraud",
                    F.col("rules_fired").cast("long").alias("rules_fired"),
                    ntz("event_time").alias("event_time"), "txn_date",
                    F.col("txn_hour").cast("long").alias("txn_hour"), "amount_bucket", "risk_level")


def q_amount_bucket(spark, sf_dir):
    t = _p(spark, sf_dir).transactions()
    return t.select("transaction_id", "amount", amount_bucket(F.col("amount")).alias("amount_bucket"))


def q_risk_level(spark, sf_dir):
    s = _p(spark, sf_dir).scored()
    return s.select("transaction_id", "fraud_score", risk_level(F.col("fraud_score")).alias("risk_level"))


def q_fraud_alerts(spark, sf_dir):
    s = _p(spark, sf_dir).scored().filter(F.col("is_fraud"))
    return s.select("transaction_id", "customer_id", "amount", "merchant", "country", "fraud_score")


# -- marts -----------------------------------------------------------------------------------

def q_fct_daily(spark, sf_dir):
    return _p(spark, sf_dir).daily()


def q_fct_category(spark, sf_dir):
    return _p(spark, sf_dir).category()


def q_dim_customers(spark, sf_dir):
    d = _p(spark, sf_dir).customers()
    return d.withColumns({"first_transaction": ntz("first_transaction"),
                          "last_transaction": ntz("last_transaction")})


def q_customer_window_stats(spark, sf_dir):
    w = marts.customer_window_stats(_p(spark, sf_dir).transactions())
    return w.withColumns({"window_start": ntz("window_start"), "window_end": ntz("window_end")})


def q_incremental_filter(spark, sf_dir):
    """Incremental daily model: rows from max(loaded date) - lookback are reprocessed."""
    from txnguard.plans.sinks import incremental_rows
    stg = _stg(spark, sf_dir)
    target = marts.fct_daily(stg.filter(F.col("txn_date") <= F.lit(MART.incremental_loaded_until)
                                        .cast("date")))
    return marts.fct_daily(incremental_rows(stg, target, MART.lookback_days, strict=False))


def q_rule_performance(spark, sf_dir):
    return marts.rule_performance(_p(spark, sf_dir).scored())


def q_scored_per_minute(spark, sf_dir):
    m = marts.scored_per_minute(_p(spark, sf_dir).scored())
    return m.withColumn("minute_start", ntz("minute_start"))


def q_headline_totals(spark, sf_dir):
    return marts.headline_totals(_p(spark, sf_dir).scored())


# -- lookup tables ---------------------------------------------------------------------------

def q_latest_n_per_customer(spark, sf_dir):
    lk = lookup.latest_n_per_customer(_p(spark, sf_dir).lookup(), MART.latest_per_customer)
    return lk.select("customer_id", "transaction_id", ntz("event_time").alias("event_time"),
                     "amount", "fraud_score", F.col("recency_rank").cast("long").alias("recency_rank"))


def q_alerts_by_day(spark, sf_dir):
    alerts = lookup.alerts_rows(_p(spark, sf_dir).lookup())
    a = lookup.alerts_by_day(alerts, MART.as_of_date)
    return a.withColumn("scored_at", ntz("scored_at"))


def q_lookup_upsert(spark, sf_dir):
    p = _p(spark, sf_dir)
    first = to_lookup(p.stateless()).withColumn("write_version", F.lit(1))
    second = to_lookup(p.scored()).withColumn("write_version", F.lit(2))
    table = lookup.upsert_last_write(first.unionByName(second))
    table = lookup.within_retention(table, MART.as_of_date)
    return table.select("customer_id", "transaction_id", ntz("event_time").alias("event_time"),
                        "amount", "merchant", "category", "country", "fraud_score", "is_fraud",
                        F.col("write_version").cast("long").alias("write_version"))


def q_lookup_expiry(spark, sf_dir):
    """Versions with unequal key sets (the second writer rescores online transactions), read on a
    day when the oldest rows are past the retention."""
    p = _p(spark, sf_dir)
    first = to_lookup(p.stateless()).withColumn("write_version", F.lit(1))
    online = p.scored().filter("is_online")
    second = to_lookup(online).withColumn("write_version", F.lit(2))
    table = lookup.upsert_last_write(first.unionByName(second))
    return lookup.within_retention(table, "2024-02-12").select(
        "customer_id", ntz("event_time").alias("event_time"), "transaction_id", "fraud_score",
        "is_fraud", F.col("write_version").cast("long").alias("write_version"))


def q_customer_stats(spark, sf_dir):
    s = lookup.customer_stats(_p(spark, sf_dir).scored())
    return s.select("customer_id", "total_transactions", "total_fraud",
                    ntz("last_transaction_time").alias("last_transaction_time"),
                    F.array_join("known_countries", ",").alias("known_countries"),
                    F.array_join("known_devices", ",").alias("known_devices"))


# -- data quality ----------------------------------------------------------------------------

def q_dq(kind: str):
    def q(spark, sf_dir):
        p = _p(spark, sf_dir)
        return quality.mart_check(kind, p.daily(), p.category(), p.customers())
    return q


def q_dq_violations(spark, sf_dir):
    """The checks on the raw messages, where every one of them finds something."""
    d = _decoded(spark, sf_dir)
    return quality.union_all([
        quality.not_null(d, "raw_messages", "customer_id"),
        quality.unique(d, "raw_messages", "customer_id"),
        quality.in_range(d, "raw_messages", "amount", 1, 1000),
        quality.accepted_values(d, "raw_messages", "country", ("US", "CA", "GB"))])


def q_dq_freshness(spark, sf_dir):
    wh = _p(spark, sf_dir).warehouse()
    return quality.freshness(wh, "scored_transactions", "loaded_at",
                             f"{MART.as_of_date} 23:59:59", MART.freshness_warn_minutes,
                             MART.freshness_error_minutes)


# -- dashboard -------------------------------------------------------------------------------

def q_dash_rate(spark, sf_dir):
    return dashboard.dash_rate(_p(spark, sf_dir).daily())


def q_dash_volume(spark, sf_dir):
    return dashboard.dash_volume(_p(spark, sf_dir).daily(), MART.as_of_date)


def q_dash_count(spark, sf_dir):
    return dashboard.dash_count(_p(spark, sf_dir).daily(), MART.as_of_date)


def q_dash_amount(spark, sf_dir):
    return dashboard.dash_amount(_p(spark, sf_dir).daily(), MART.as_of_date)


def q_dash_category(spark, sf_dir):
    return dashboard.dash_category(_p(spark, sf_dir).category())


def q_dash_high_risk(spark, sf_dir):
    return dashboard.dash_high_risk(_p(spark, sf_dir).customers(), MART.top_customers)


def q_dash_severity(spark, sf_dir):
    return dashboard.dash_severity(_p(spark, sf_dir).daily())


# Date columns of the registered outputs are handed over as midnight timestamps (same column
# names, same values): pandas turns a Spark DATE into datetime.date but a DuckDB DATE into a
# Timestamp, while timestamps convert alike through pandas and Arrow. The marts themselves keep
# DATE columns.
DATE_OUTPUTS = {
    "stg_scored": ("txn_date",),
    "fct_daily": ("txn_date",),
    "incremental_filter": ("txn_date",),
    "dash_rate": ("time",),
    "dash_severity": ("txn_date",),
    "alerts_by_day": ("alert_date",),
}


def _dates_as_timestamps(name: str, fn):
    cols = DATE_OUTPUTS[name]

    def q(spark, sf_dir):
        df = fn(spark, sf_dir)
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})
    q.__name__ = fn.__name__
    q.__doc__ = fn.__doc__
    return q


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_score": q_rule_score,
    "rule_high_amount": _rule_q("high_amount", "amount", "avg_amount"),
    "rule_velocity": _rule_q("velocity", "recent_count"),
    "rule_geo": _rule_q("geo_anomaly", "country", "has_history", "is_new_country"),
    "rule_card_testing": _rule_q("card_testing", "amount", "small_count"),
    "rule_time": _rule_q("time_anomaly", "timestamp"),
    "triggered_rules": q_triggered_rules,
    "stateless_score": q_stateless_score,
    "hist_recent_count": q_hist_recent_count,
    "hist_small_count": q_hist_small_count,
    "hist_avg_amount": q_hist_avg_amount,
    "hist_new_country": q_hist_new_country,
    "hist_two_loads": q_hist_two_loads,
    "hist_loads": q_hist_loads,
    "dedup_loads": q_dedup_loads,
    "fct_category_loads": q_fct_category_loads,
    "dim_customers_loads": q_dim_customers_loads,
    "dim_customers_bucketed": q_dim_customers_bucketed,
    "dedup_replays": q_dedup_replays,
    "json_decode": q_json_decode,
    "event_time_parse": q_event_time_parse,
    "dlq_split": q_dlq_split,
    "dlq_counts": q_dlq_counts,
    "scored_json": q_scored_json,
    "sink_defaults": q_sink_defaults,
    "stg_scored": q_stg_scored,
    "amount_bucket": q_amount_bucket,
    "risk_level": q_risk_level,
    "fraud_alerts": q_fraud_alerts,
    "fct_daily": q_fct_daily,
    "fct_category": q_fct_category,
    "dim_customers": q_dim_customers,
    "customer_window_stats": q_customer_window_stats,
    "incremental_filter": q_incremental_filter,
    "rule_performance": q_rule_performance,
    "scored_per_minute": q_scored_per_minute,
    "headline_totals": q_headline_totals,
    "latest_n_per_customer": q_latest_n_per_customer,
    "alerts_by_day": q_alerts_by_day,
    "lookup_upsert": q_lookup_upsert,
    "lookup_expiry": q_lookup_expiry,
    "customer_stats": q_customer_stats,
    "dq_not_null": q_dq("not_null"),
    "dq_unique": q_dq("unique"),
    "dq_range": q_dq("range"),
    "dq_accepted": q_dq("accepted"),
    "dq_violations": q_dq_violations,
    "dq_freshness": q_dq_freshness,
    "dash_rate": q_dash_rate,
    "dash_volume": q_dash_volume,
    "dash_count": q_dash_count,
    "dash_amount": q_dash_amount,
    "dash_category": q_dash_category,
    "dash_high_risk": q_dash_high_risk,
    "dash_severity": q_dash_severity,
}

for _name in DATE_OUTPUTS:
    QUERIES[_name] = _dates_as_timestamps(_name, QUERIES[_name])
