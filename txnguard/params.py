"""Rule, history, stream and mart parameters.

Everything tunable is a field of a frozen dataclass so that batch and streaming jobs share one
definition and a job can be re-run with exactly the same settings.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------------------------
# Fixed values. These must equal the reference's values for the scores and fixtures to match.
# ---------------------------------------------------------------------------------------------

# Rule names, in the order the rule engine evaluates them, with their weights.
RULE_WEIGHTS = (
    ("high_amount", 0.3),
    ("velocity", 0.25),
    ("geo_anomaly", 0.2),
    ("card_testing", 0.15),
    ("time_anomaly", 0.1),
)

# Countries that give the geo-anomaly rule its higher score (0.9 instead of 0.5).
GEO_HIGH_RISK_COUNTRIES = ("NG", "RU", "CN", "BR", "IN", "PH")
GEO_HIGH_RISK_SCORE = 0.9
GEO_OTHER_SCORE = 0.5
TIME_ANOMALY_SCORE = 0.6
TIME_ANOMALY_HOURS = (2, 5)
DEFAULT_COUNTRY = "US"

# Reason texts of the rules (printf style; {names} are filled from the rule parameters).
REASON_OVER_THRESHOLD = "Amount $%.2f exceeds threshold $%.2f"
REASON_OVER_AVERAGE = "Amount $%.2f is %.1fx customer average"
REASON_VELOCITY = "%d transactions in {window} minutes (max: {max_count})"
REASON_GEO = "Transaction from %s, known countries: {{%s}}"
REASON_CARD_TESTING = "%d small transactions (<${threshold}) in {window} minutes"
REASON_TIME = "Transaction at %d:00 UTC (unusual hours)"

# Stateless streaming scorer constants.
STATELESS_AMOUNT_TIERS = ((5000.0, 0.3), (2000.0, 0.15))
STATELESS_TIME_SCORE = 0.06
STATELESS_TIME_HOURS = (2, 5)
STATELESS_GEO_TIERS = ((("NG", "RU", "CN"), 0.18), (("BR", "IN", "PH"), 0.1))
STATELESS_ONLINE_SCORE = 0.05
STATELESS_ONLINE_MIN_AMOUNT = 1000.0

# Value lists of the transaction generator, used to derive transactions from `events`.
MERCHANTS = (
    "Amazon", "Walmart", "Target", "BestBuy", "Starbucks",
    "McDonalds", "Shell", "CVS", "Costco", "HomeDepot",
    "Apple Store", "Netflix", "Spotify", "Uber", "DoorDash",
)
CATEGORIES = (
    "retail", "groceries", "gas", "dining", "entertainment",
    "travel", "healthcare", "utilities", "subscription", "electronics",
)
CARD_TYPES = ("visa", "mastercard", "amex", "discover")

# Staging CASE boundaries (strict `>` for amounts, `>=` for scores).
AMOUNT_BUCKETS = ((5000, "very_high"), (1000, "high"), (100, "medium"), (10, "low"))
AMOUNT_BUCKET_ELSE = "micro"
RISK_LEVELS = ((0.9, "critical"), (0.7, "high"), (0.4, "medium"))
RISK_LEVEL_ELSE = "low"

# Customer risk status: first match wins; (status, minimum fraud count, score measure, minimum).
RISK_STATUS_STEPS = (
    ("blocked", 5, "max", 0.95),
    ("high_risk", 3, "avg", 0.6),
    ("watch", 1, "avg", 0.3),
)
RISK_STATUS_ELSE = "clean"
RISK_STATUS_VALUES = ("blocked", "high_risk", "watch", "clean")
# Statuses shown on the high-risk dashboard panel.
HIGH_RISK_STATUSES = ("blocked", "high_risk")

# Dashboard rate severity thresholds (percent).
SEVERITY_STEPS = ((5, "red"), (3, "yellow"))
SEVERITY_ELSE = "green"

# Warehouse defaults for keys missing from a scored message.
WAREHOUSE_DEFAULTS = {
    "amount": 0,
    "currency": "USD",
    "merchant": "",
    "category": "",
    "country": "US",
    "card_type": "",
    "fraud_score": 0,
    "is_fraud": False,
    "rules_fired": 0,
}
# Lookup-store defaults.
LOOKUP_DEFAULTS = {
    "merchant": "",
    "category": "",
    "country": "US",
    "fraud_score": 0.0,
    "is_fraud": False,
}
LOOKUP_RETENTION_DAYS = 30
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleParams:
    """Thresholds and windows of the weighted rule engine (defaults = the reference's)."""

    score_threshold: float = 0.7
    high_amount_threshold: float = 5000.0
    velocity_window_minutes: int = 10
    velocity_max_count: int = 5
    card_test_amount_threshold: float = 5.0
    card_test_window_minutes: int = 5
    card_test_min_count: int = 3
    weights: tuple = RULE_WEIGHTS
    geo_high_risk: tuple = GEO_HIGH_RISK_COUNTRIES
    # Width of the time segments that split every customer's history over tasks; any width gives
    # the same result (see operators/history.py).
    history_segment_minutes: int = 60

    def with_(self, **kw) -> "RuleParams":
        return replace(self, **kw)


# Parameters under which every rule fires on the `events` fixture (FIXTURES.md).
FIXTURE_PARAMS = RuleParams(
    velocity_window_minutes=1440,
    card_test_window_minutes=1440,
    score_threshold=0.3,
)


@dataclass(frozen=True)
class StreamParams:
    """Streaming settings (defaults = the reference's)."""

    watermark: str = "1 minute"
    # Rows up to this much older than the newest event of their customer still get an exact
    # history from the streaming state (the state keeps that much extra).
    allowed_lateness_minutes: int = 1
    scored_trigger: str = "5 seconds"
    console_trigger: str = "10 seconds"
    stateless_threshold: float = 0.7
    window_length: str = "10 minutes"
    window_slide: str = "1 minute"
    # Upper bound on one micro-batch (Kafka offsets or files): it also bounds the rows one
    # customer can bring into the stateful operator in a single batch.
    max_records_per_trigger: int | None = 5_000_000
    max_files_per_trigger: int | None = 100
    # A customer's state is cleared this long after the customer was last seen.
    state_ttl_days: float = LOOKUP_RETENTION_DAYS
    # Messages that repeat a transaction id within this much event time are replays.
    replay_minutes: int = 60
    # Dead letters pass the state operator under this many keys.
    dead_letter_keys: int = 256


@dataclass(frozen=True)
class MartParams:
    """Marts, dashboard and data-quality settings."""

    as_of_date: str = "2024-01-30"
    lookback_days: int = 1
    # In the incremental-model query the daily mart is taken as loaded up to this date.
    incremental_loaded_until: str = "2024-01-20"
    strict_incremental: bool = False
    # In the two-load query the first load ends with this date.
    first_load_until: str = "2024-01-12"
    # In the queries over three loads a load holds this many days from this one on.
    loads_from: str = "2024-01-01"
    load_days: int = 10
    top_customers: int = 20
    latest_per_customer: int = 10
    freshness_warn_minutes: int = 10
    freshness_error_minutes: int = 60
