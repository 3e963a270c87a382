"""Aggregations: the three marts (A2-A4), windowed customer stats (A1) and the monitoring
measures (A5-A9).

All aggregates are algebraic (count, sum, min, max, exact-decimal mean) or count-distinct, so
Spark aggregates partially before the shuffle and a hot group collapses to one partial row per
task. Means go through an exact decimal sum so the result does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.buckets import exact_avg, pct, risk_status, round_half_up


def _fraud_int() -> F.Column:
    return F.when(F.col("is_fraud"), F.lit(1)).otherwise(F.lit(0))


def _money(c) -> F.Column:
    return F.sum(c).cast("double")


def fct_daily(stg: DataFrame) -> DataFrame:
    fraud_n = F.sum(_fraud_int())
    return stg.groupBy("txn_date").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        fraud_n.alias("fraud_count"),
        pct(fraud_n, F.count(F.lit(1)), 4).alias("fraud_rate_pct"),
        _money(F.col("amount")).alias("total_amount"),
        _money(F.when(F.col("is_fraud"), F.col("amount")).otherwise(F.lit(0))).alias("fraud_amount"),
        exact_avg(F.col("fraud_score"), 4).alias("avg_fraud_score"),
        exact_avg(F.when(F.col("is_fraud"), F.col("fraud_score")), 4)
        .alias("avg_fraud_score_flagged"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct(F.when(F.col("is_fraud"), F.col("customer_id"))).alias("fraud_customers"),
        F.count_distinct("country").alias("unique_countries"),
        exact_avg(F.col("rules_fired"), 2).alias("avg_rules_fired"),
    )


def fct_category(stg: DataFrame) -> DataFrame:
    fraud_n = F.sum(_fraud_int())
    return stg.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        fraud_n.alias("fraud_count"),
        pct(fraud_n, F.count(F.lit(1)), 2).alias("fraud_rate_pct"),
        _money(F.col("amount")).alias("total_amount"),
        _money(F.when(F.col("is_fraud"), F.col("amount")).otherwise(F.lit(0))).alias("fraud_amount"),
        exact_avg(F.col("amount"), 2).alias("avg_transaction_amount"),
        exact_avg(F.when(F.col("is_fraud"), F.col("amount")), 2).alias("avg_fraud_amount"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def dim_customers(stg: DataFrame) -> DataFrame:
    stats = stg.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(_fraud_int()).alias("fraud_count"),
        _money(F.col("amount")).alias("total_amount"),
        _money(F.when(F.col("is_fraud"), F.col("amount")).otherwise(F.lit(0))).alias("fraud_amount"),
        exact_avg(F.col("fraud_score"), 4).alias("avg_fraud_score"),
        F.max("fraud_score").cast("double").alias("max_fraud_score"),
        F.min("event_time").alias("first_transaction"),
        F.max("event_time").alias("last_transaction"),
        F.count_distinct("country").alias("unique_countries"),
        F.count_distinct("category").alias("unique_categories"),
        F.count_distinct("merchant").alias("unique_merchants"),
    )
    return stats.withColumns({
        "fraud_rate_pct": pct(F.col("fraud_count"), F.col("total_transactions"), 2),
        "risk_status": risk_status(F.col("fraud_count"), F.col("max_fraud_score"),
                                   F.col("avg_fraud_score")),
    })


def customer_window_stats(txns: DataFrame, length: str = "10 minutes",
                          slide: str = "1 minute", small_amount: float = 5.0) -> DataFrame:
    """Per customer and sliding event-time window: count, small count, mean and max amount.

    Batch or stream: on a stream, put `withWatermark` on event_time first (streaming/). Rows are
    aggregated by slide first (all rows of a slide are in the same windows), so that what is
    repeated for each window, and what a stream keeps as state, is one row per customer and slide
    and not every transaction. On a stream the two aggregations are chained: a slide is handed on
    when the watermark passes its end, and then counts in its windows by `window_time`."""
    small = F.when(F.col("amount") < F.lit(small_amount), 1).otherwise(0)
    slides = txns.groupBy("customer_id", F.window("event_time", slide).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(small).alias("k"),
        F.sum(F.col("amount").cast("decimal(18,4)")).alias("total"),
        F.count("amount").alias("known"), F.max("amount").alias("most"))
    at = F.window_time("s") if txns.isStreaming else F.col("s.start")
    g = slides.select("*", at.alias("at")).groupBy(
        "customer_id", F.window("at", length, slide).alias("w")).agg(
        F.sum("n").alias("txn_count_10min"), F.sum("k").alias("small_txn_count"),
        (F.sum("total").cast("double") / F.nullif(F.sum("known"), F.lit(0)))
        .alias("avg_amount_10min"),
        F.max("most").alias("max_amount_10min"))
    return g.select("customer_id", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "txn_count_10min", "small_txn_count",
                    "avg_amount_10min", "max_amount_10min")


def rule_performance(scored: DataFrame) -> DataFrame:
    """Times each rule fired: explode the fired-rule list, count per rule (5 groups, partial
    aggregation makes the shuffle tiny)."""
    return (scored.select(F.explode("triggered_rules").alias("r"))
            .groupBy(F.col("r.rule").alias("rule")).agg(F.count(F.lit(1)).alias("times_triggered")))


def scored_per_minute(scored: DataFrame, time_col: str = "event_time") -> DataFrame:
    g = scored.groupBy(F.window(time_col, "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("scored_count"),
        F.sum(_fraud_int()).alias("fraud_count"))
    return g.select(F.col("w.start").alias("minute_start"), "scored_count", "fraud_count")


def headline_totals(scored: DataFrame) -> DataFrame:
    fraud_n = F.sum(_fraud_int())
    return scored.agg(
        F.count(F.lit(1)).alias("total_scored"),
        fraud_n.alias("fraud_detected"),
        pct(fraud_n, F.count(F.lit(1)), 2).alias("fraud_rate_pct"),
    )


def mean_latency_ms(scored: DataFrame) -> DataFrame:
    """Mean of scored_at - event_time in milliseconds (clock dependent; not oracle-checked)."""
    lat = (F.unix_micros("scored_at") - F.unix_micros("event_time")) / F.lit(1000.0)
    return scored.agg(round_half_up(F.avg(lat), 1).alias("avg_latency_ms"))


def batch_metrics(scored: DataFrame, batch_id: int) -> DataFrame:
    """Monitoring row of one micro-batch: rows scored, fraud detected and rate (A7), mean
    scoring latency in ms (A8), and rule fires (A5), in one aggregate."""
    fraud_n = F.sum(_fraud_int())
    lat = (F.unix_micros("scored_at") - F.unix_micros("event_time")) / F.lit(1000.0)
    fires = {}
    if "triggered_rules" in scored.columns:
        def fired(name):
            return F.exists("triggered_rules", lambda r: r["rule"] == F.lit(name))
        for name in ("high_amount", "velocity", "geo_anomaly", "card_testing", "time_anomaly"):
            hit = fired(name)
            fires[f"{name}_fired"] = F.sum(F.when(hit, 1).otherwise(0)).cast("long")
    return scored.agg(
        F.lit(int(batch_id)).cast("long").alias("batch_id"),
        F.count(F.lit(1)).alias("scored"),
        fraud_n.alias("fraud_detected"),
        pct(fraud_n, F.count(F.lit(1)), 2).alias("fraud_rate_pct"),
        round_half_up(F.avg(lat), 1).alias("avg_latency_ms"),
        *[c.alias(k) for k, c in fires.items()],
    )


def dlq_counts(dlq: DataFrame) -> DataFrame:
    return dlq.groupBy("reason").agg(F.count(F.lit(1)).alias("dead_letters"))
