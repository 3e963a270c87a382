"""Scorers.

* `stateless_score`: the streaming job's four additive column rules (R1-R5). No state, no
  shuffle: a single projection, so it runs the same on a batch or a stream.
* `rule_score`: the five weighted rules over customer history (R6-R13). History is one exchange on
  (customer, segment) (operators/history.py); the rules themselves are one projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.functions.rules import (
    known_countries_text,
    rule_columns,
    round4,
    stateless_components,
    triggered_rules,
    weighted_score,
)
from txnguard.operators.history import Past, with_history
from txnguard.params import RuleParams


def stateless_score(df: DataFrame, threshold: float = 0.7, stamp: bool = True) -> DataFrame:
    comps = stateless_components()
    out = df.withColumns(comps)
    total = (F.col("amount_score") + F.col("time_score") + F.col("geo_score")
             + F.col("online_score"))
    out = out.withColumn("fraud_score", total).withColumn(
        "is_fraud", F.col("fraud_score") >= F.lit(float(threshold)))
    if stamp:
        out = out.withColumn("scored_at", F.current_timestamp())
    return out


def apply_rules(hist: DataFrame, p: RuleParams, rules=None, stamp: bool = True) -> DataFrame:
    """Rules + combination over a frame that already carries the history columns."""
    exprs = rule_columns(p, rules)
    if "known_countries" not in hist.columns:
        hist = hist.withColumn("known_countries", known_countries_text())
    cols = {}
    for e in exprs:
        cols[f"{e.name}_score"] = e.score
        cols[f"{e.name}_reason"] = e.reason
    out = hist.withColumns(cols)
    raw = weighted_score(exprs, p)
    out = out.withColumns({
        "_raw_score": raw,
    })
    out = out.withColumns({
        "fraud_score": round4(F.col("_raw_score")),
        "is_fraud": F.col("_raw_score") >= F.lit(float(p.score_threshold)),
        "triggered_rules": triggered_rules(exprs),
    }).withColumn("rules_fired", F.size("triggered_rules")).drop("_raw_score")
    if stamp:
        out = out.withColumn("scored_at", F.current_timestamp())
    return out


def rule_score(txns: DataFrame, p: RuleParams, rules=None, stamp: bool = True,
               past: Past | None = None) -> DataFrame:
    """History and rules over a batch; `past` is the history that earlier loads left behind."""
    return apply_rules(with_history(txns, p, past=past), p, rules, stamp)


def triggered_names(df: DataFrame) -> DataFrame:
    """Comma-joined names of the rules that fired, in rule order."""
    return df.withColumn("rules_triggered",
                         F.concat_ws(",", F.transform("triggered_rules", lambda x: x["rule"])))


def explode_triggered(scored: DataFrame, keep=("transaction_id", "customer_id")) -> DataFrame:
    """One row per fired rule (R12 as rows)."""
    return scored.select(*keep, F.posexplode("triggered_rules").alias("rule_pos", "r")).select(
        *keep, "rule_pos", F.col("r.rule").alias("rule"), F.col("r.score").alias("rule_score"),
        F.col("r.reason").alias("reason"))
