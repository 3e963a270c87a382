"""Rule expressions.

Every rule is a function `(RuleParams) -> RuleExpr`, a score column in [0, 1] and a reason
column, written over the columns of a transaction plus its history columns
(`recent_count`, `small_count`, `avg_amount`, `has_history`, `is_new_country`; see
operators/history.py). The rule list is ordered and open to more rules (`ALL_RULES`); the
combination reproduces the reference's weighted mean, clamp and rounding.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from txnguard.params import (
    DEFAULT_COUNTRY,
    GEO_HIGH_RISK_SCORE,
    GEO_OTHER_SCORE,
    REASON_CARD_TESTING,
    REASON_GEO,
    REASON_OVER_AVERAGE,
    REASON_OVER_THRESHOLD,
    REASON_TIME,
    REASON_VELOCITY,
    STATELESS_AMOUNT_TIERS,
    STATELESS_GEO_TIERS,
    STATELESS_ONLINE_MIN_AMOUNT,
    STATELESS_ONLINE_SCORE,
    STATELESS_TIME_HOURS,
    STATELESS_TIME_SCORE,
    TIME_ANOMALY_HOURS,
    TIME_ANOMALY_SCORE,
    RuleParams,
)


@dataclass(frozen=True)
class RuleExpr:
    name: str
    weight: float
    score: Column
    reason: Column


def round4(x: Column) -> Column:
    """Half-up rounding to 4 decimals, written so that Spark and SQL engines agree bit for bit."""
    return F.floor(x * F.lit(1e4) + F.lit(0.5)) / F.lit(1e4)


def country_or_default(c: Column | None = None) -> Column:
    return F.coalesce(c if c is not None else F.col("country"), F.lit(DEFAULT_COUNTRY))


def own_offset_hour(ts_text: Column) -> Column:
    """Hour as written in an ISO-8601 string, i.e. in the string's own offset; NULL when the text
    does not parse as a timestamp."""
    hour = F.regexp_extract(ts_text, r"^\s*\d{4}-\d{2}-\d{2}[T ](\d{2})", 1)
    parsed = F.try_to_timestamp(ts_text)
    return F.when(parsed.isNotNull() & (hour != ""), hour.cast("int"))


def _weight(params: RuleParams, name: str) -> float:
    return dict(params.weights)[name]


def rule_high_amount(p: RuleParams) -> RuleExpr:
    amount, avg = F.col("amount"), F.col("avg_amount")
    t = float(p.high_amount_threshold)
    over = amount > F.lit(t)
    vs_avg = (avg > 0) & (amount > avg * F.lit(3))
    score = (F.when(over, F.least(F.lit(1.0), amount / F.lit(t * 2)))
             .when(vs_avg, F.least(F.lit(1.0), (amount / avg - F.lit(1)) / F.lit(5)))
             .otherwise(F.lit(0.0)))
    reason = (F.when(over, F.format_string(REASON_OVER_THRESHOLD, amount, F.lit(t)))
              .when(vs_avg, F.format_string(REASON_OVER_AVERAGE, amount, amount / avg))
              .otherwise(F.lit("")))
    return RuleExpr("high_amount", _weight(p, "high_amount"), score, reason)


def rule_velocity(p: RuleParams) -> RuleExpr:
    n = F.col("recent_count")
    hit = n >= p.velocity_max_count
    score = F.when(hit, F.least(F.lit(1.0), n / F.lit(p.velocity_max_count * 2))).otherwise(0.0)
    text = REASON_VELOCITY.format(window=p.velocity_window_minutes, max_count=p.velocity_max_count)
    reason = F.when(hit, F.format_string(text, n)).otherwise(F.lit(""))
    return RuleExpr("velocity", _weight(p, "velocity"), score, reason)


def known_countries(first_seen: str = "country_first_seen", us: str = "us") -> Column:
    """Sorted countries seen strictly before this row, from the first-seen map."""
    return F.array_sort(F.map_keys(F.map_filter(F.col(first_seen), lambda k, v: v < F.col(us))))


def known_countries_text() -> Column:
    """`'CA', 'US'` style text of the known set (the rule reason's wording)."""
    return F.concat_ws(", ", F.transform(known_countries(),
                                         lambda x: F.concat(F.lit("'"), x, F.lit("'"))))


def rule_geo_anomaly(p: RuleParams) -> RuleExpr:
    country = country_or_default()
    hit = F.col("has_history") & F.col("is_new_country")
    score = (F.when(hit & country.isin(*p.geo_high_risk), F.lit(GEO_HIGH_RISK_SCORE))
             .when(hit, F.lit(GEO_OTHER_SCORE)).otherwise(F.lit(0.0)))
    reason = F.when(hit, F.format_string(REASON_GEO.format(), country, F.col("known_countries"))
                    ).otherwise(F.lit(""))
    return RuleExpr("geo_anomaly", _weight(p, "geo_anomaly"), score, reason)


def rule_card_testing(p: RuleParams) -> RuleExpr:
    amount, n = F.col("amount"), F.col("small_count")
    t = float(p.card_test_amount_threshold)
    hit = (amount < F.lit(t)) & (n >= p.card_test_min_count)
    score = F.when(hit, F.least(F.lit(1.0), n / F.lit(p.card_test_min_count * 2))).otherwise(0.0)
    text = REASON_CARD_TESTING.format(threshold=t, window=p.card_test_window_minutes)
    reason = F.when(hit, F.format_string(text, n)).otherwise(F.lit(""))
    return RuleExpr("card_testing", _weight(p, "card_testing"), score, reason)


def rule_time_anomaly(p: RuleParams) -> RuleExpr:
    hour = own_offset_hour(F.col("timestamp"))
    lo, hi = TIME_ANOMALY_HOURS
    hit = F.coalesce(hour.between(lo, hi), F.lit(False))
    score = F.when(hit, F.lit(TIME_ANOMALY_SCORE)).otherwise(F.lit(0.0))
    reason = F.when(hit, F.format_string(REASON_TIME, hour)
                    ).otherwise(F.lit(""))
    return RuleExpr("time_anomaly", _weight(p, "time_anomaly"), score, reason)


ALL_RULES: list[Callable[[RuleParams], RuleExpr]] = [
    rule_high_amount,
    rule_velocity,
    rule_geo_anomaly,
    rule_card_testing,
    rule_time_anomaly,
]


def rule_columns(p: RuleParams, rules=None) -> list[RuleExpr]:
    return [r(p) for r in (rules or ALL_RULES)]


def weighted_score(exprs: list[RuleExpr], p: RuleParams) -> Column:
    """sum(score*weight) / max(total weight, 0.01), clamped to [0, 1]; unrounded.

    Scores are read from the `<name>_score` columns so Catalyst evaluates each rule once.
    """
    total = None
    for e in exprs:
        term = F.col(f"{e.name}_score") * F.lit(float(e.weight))
        total = term if total is None else total + term
    tw = 0
    for e in exprs:
        tw += e.weight
    raw = total / F.lit(max(tw, 0.01))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))


def triggered_rules(exprs: list[RuleExpr]) -> Column:
    """Array of {rule, score (4 dp), reason} for rules with score > 0, in rule order."""
    arr = F.array(*[
        F.struct(F.lit(e.name).alias("rule"), F.col(f"{e.name}_score").alias("score"),
                 F.col(f"{e.name}_reason").alias("reason"))
        for e in exprs
    ])
    kept = F.filter(arr, lambda x: x["score"] > 0)
    return F.transform(kept, lambda x: F.struct(
        x["rule"].alias("rule"), round4(x["score"]).alias("score"), x["reason"].alias("reason")))


# ----------------------------------------------------------------------------------------------
# Stateless streaming scorer
# ----------------------------------------------------------------------------------------------

def stateless_components() -> dict[str, Column]:
    amount = F.col("amount")
    (t1, s1), (t2, s2) = STATELESS_AMOUNT_TIERS
    amount_score = (F.when(amount > F.lit(t1), F.lit(s1)).when(amount > F.lit(t2), F.lit(s2))
                    .otherwise(F.lit(0.0)))
    et = F.col("event_time")
    lo, hi = STATELESS_TIME_HOURS
    hour_frac = (F.unix_seconds(et) % 86400) / F.lit(3600)
    time_score = F.when(et.isNotNull() & hour_frac.between(lo, hi), F.lit(STATELESS_TIME_SCORE)
                        ).otherwise(F.lit(0.0))
    (c1, g1), (c2, g2) = STATELESS_GEO_TIERS
    country = F.col("country")
    geo_score = (F.when(country.isin(*c1), F.lit(g1)).when(country.isin(*c2), F.lit(g2))
                 .otherwise(F.lit(0.0)))
    online_score = F.when((F.col("is_online") == F.lit(True))
                          & (amount > F.lit(STATELESS_ONLINE_MIN_AMOUNT)),
                          F.lit(STATELESS_ONLINE_SCORE)).otherwise(F.lit(0.0))
    return {"amount_score": amount_score, "time_score": time_score, "geo_score": geo_score,
            "online_score": online_score}
