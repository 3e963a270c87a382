"""Reference SQL for every registered query, written for DuckDB over the driver's tables.

These statements are the brute-force definitions: customer history is a plain window over each
customer's whole timeline, the fixtures are rebuilt from `events` with the same rules, and the
marts follow the model SQL. They share no code path and no constant with the Spark plans: the
values below are stated here a second time, so a wrong constant in either place shows as a
mismatch. Literals are written as DOUBLE casts so both engines do the same floating-point
arithmetic.
"""

from __future__ import annotations

from types import SimpleNamespace

# ---------------------------------------------------------------------------------------------
# What the definitions are checked against.
# ---------------------------------------------------------------------------------------------

RULES = SimpleNamespace(
    score_threshold=0.3,                     # the fixture's; 0.7 by default
    high_amount_threshold=5000.0,
    velocity_window_minutes=1440,            # the fixture's; 10 by default
    velocity_max_count=5,
    card_test_amount_threshold=5.0,
    card_test_window_minutes=1440,           # the fixture's; 5 by default
    card_test_min_count=3,
    weights=(("high_amount", 0.3), ("velocity", 0.25), ("geo_anomaly", 0.2),
             ("card_testing", 0.15), ("time_anomaly", 0.1)),
    geo_high_risk=("NG", "RU", "CN", "BR", "IN", "PH"),
)
STATELESS_AMOUNT_TIERS = ((5000.0, 0.3), (2000.0, 0.15))
STATELESS_TIME_SCORE = 0.06
STATELESS_TIME_HOURS = (2, 5)
STATELESS_GEO_TIERS = ((("NG", "RU", "CN"), 0.18), (("BR", "IN", "PH"), 0.1))
STATELESS_ONLINE_SCORE = 0.05
STATELESS_ONLINE_MIN_AMOUNT = 1000.0
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
COUNTRY_BY_K = ((82, "US"), (85, "CA"), (88, "GB"), (91, "DE"), (93, "BR"), (96, "NG"), (98, "RU"))
COUNTRY_BY_K_ELSE = "CN"
AMOUNT_BUCKETS = ((5000, "very_high"), (1000, "high"), (100, "medium"), (10, "low"))
AMOUNT_BUCKET_ELSE = "micro"
RISK_LEVELS = ((0.9, "critical"), (0.7, "high"), (0.4, "medium"))
RISK_LEVEL_ELSE = "low"
RISK_STATUS_STEPS = (
    ("blocked", 5, "max", 0.95),
    ("high_risk", 3, "avg", 0.6),
    ("watch", 1, "avg", 0.3),
)
RISK_STATUS_ELSE = "clean"
RISK_STATUS_VALUES = ("blocked", "high_risk", "watch", "clean")
HIGH_RISK_STATUSES = ("blocked", "high_risk")
SEVERITY_STEPS = ((5, "red"), (3, "yellow"))
SEVERITY_ELSE = "green"
MART = SimpleNamespace(
    as_of_date="2024-01-30", lookback_days=1, incremental_loaded_until="2024-01-20",
    top_customers=20, latest_per_customer=10, freshness_warn_minutes=10,
    freshness_error_minutes=60,
)


def d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(s(v) for v in values) + "]"


def r4(x: str) -> str:
    return f"(floor(({x}) * 1e4 + 0.5) / 1e4)"


def rnd(x: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(floor(({x}) * {scale!r} + 0.5) / {scale!r})"


def avg_exact(x: str, digits: int | None = None) -> str:
    e = f"(CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE) / nullif(count({x}), 0))"
    return e if digits is None else rnd(e, digits)


def pct(num: str, den: str, digits: int) -> str:
    return rnd(f"CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE) * 100.0", digits)


# ---------------------------------------------------------------------------------------------
# Fixture CTEs
# ---------------------------------------------------------------------------------------------

def _country_case(k: str) -> str:
    arms = " ".join(f"WHEN {k} < {b} THEN {s(c)}" for b, c in COUNTRY_BY_K)
    return f"CASE {arms} ELSE {s(COUNTRY_BY_K_ELSE)} END"


TS_FMT = "%Y-%m-%dT%H:%M:%S.%f"

EV_TXNS = f"""ev_txns AS (
  SELECT event_id, event_type,
    'txn-' || lpad(CAST(event_id AS VARCHAR), 8, '0') AS transaction_id,
    'cust-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS customer_id,
    CASE WHEN event_type = 'click' THEN greatest({d(0.01)}, floor(value * 5) / 100.0)
         WHEN event_type = 'purchase' THEN round(value * 60, 2)
         ELSE round(value * 10, 2) END AS amount,
    'USD' AS currency,
    {lst(MERCHANTS)}[event_id % {len(MERCHANTS)} + 1] AS merchant,
    {lst(CATEGORIES)}[event_id % {len(CATEGORIES)} + 1] AS category,
    {_country_case("CAST(json_extract_string(props, '$.k') AS INTEGER)")} AS country,
    {lst(CARD_TYPES)}[user_id % {len(CARD_TYPES)} + 1] AS card_type,
    'device_' || lpad(CAST(user_id AS VARCHAR), 4, '0') AS device_id,
    (event_id % 5) < 3 AS is_online,
    strftime(ts, '{TS_FMT}') || '+00:00' AS "timestamp",
    ts AS event_time,
    epoch_us(ts) AS us
  FROM events
)"""

TXNS = "txns AS (SELECT * EXCLUDE (event_id, event_type) FROM ev_txns)"


def hist_cte(p) -> str:
    wv = p.velocity_window_minutes * 60_000_000
    wc = p.card_test_window_minutes * 60_000_000
    part = "PARTITION BY customer_id ORDER BY us"
    return f"""hist0 AS (
  SELECT *,
    count(*) OVER ({part} RANGE BETWEEN {wv} PRECEDING AND 1 PRECEDING) AS recent_count,
    coalesce(sum(CASE WHEN amount < {d(p.card_test_amount_threshold)} THEN 1 ELSE 0 END)
      OVER ({part} RANGE BETWEEN {wc} PRECEDING AND 1 PRECEDING), 0) AS small_count,
    count(*) OVER ({part} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_count,
    sum(CAST(amount AS DECIMAL(18,2)))
      OVER ({part} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_sum,
    min(us) OVER (PARTITION BY customer_id, coalesce(country, 'US')) AS country_first_us
  FROM txns
),
hist AS (
  SELECT * EXCLUDE (prior_sum, country_first_us, recent_count, small_count, prior_count),
    CAST(recent_count AS BIGINT) AS recent_count,
    CAST(small_count AS BIGINT) AS small_count,
    CAST(prior_count AS BIGINT) AS prior_count,
    CASE WHEN prior_count > 0 THEN CAST(prior_sum AS DOUBLE) / prior_count ELSE {d(0)} END
      AS avg_amount,
    prior_count > 0 AS has_history,
    coalesce(country_first_us = us, false) AS is_new_country
  FROM hist0
)"""


def rules_cte(p) -> str:
    t = float(p.high_amount_threshold)
    hi_risk = ", ".join(s(c) for c in p.geo_high_risk)
    w = dict(p.weights)
    hour = r"""regexp_extract("timestamp", '^\s*\d{4}-\d{2}-\d{2}[T ](\d{2})', 1)"""
    terms = " + ".join(f"{n}_score * {d(w[n])}" for n, _ in p.weights)
    tw = 0
    for _, x in p.weights:
        tw += x
    names = [n for n, _ in p.weights]
    fired = ", ".join(f"CASE WHEN {n}_score > 0 THEN {s(n)} END" for n in names)
    nfired = " + ".join(f"(CASE WHEN {n}_score > 0 THEN 1 ELSE 0 END)" for n in names)
    return f"""rules0 AS (
  SELECT *,
    CASE WHEN amount > {d(t)} THEN least({d(1)}, amount / {d(t * 2)})
         WHEN avg_amount > 0 AND amount > avg_amount * 3
           THEN least({d(1)}, (amount / avg_amount - 1) / 5)
         ELSE {d(0)} END AS high_amount_score,
    CASE WHEN recent_count >= {p.velocity_max_count}
         THEN least({d(1)}, CAST(recent_count AS DOUBLE) / {p.velocity_max_count * 2})
         ELSE {d(0)} END AS velocity_score,
    CASE WHEN has_history AND is_new_country AND coalesce(country, 'US') IN ({hi_risk}) THEN {d(0.9)}
         WHEN has_history AND is_new_country THEN {d(0.5)}
         ELSE {d(0)} END AS geo_anomaly_score,
    CASE WHEN amount < {d(p.card_test_amount_threshold)} AND small_count >= {p.card_test_min_count}
         THEN least({d(1)}, CAST(small_count AS DOUBLE) / {p.card_test_min_count * 2})
         ELSE {d(0)} END AS card_testing_score,
    CASE WHEN {hour} <> '' AND CAST({hour} AS INTEGER) BETWEEN 2 AND 5 THEN {d(0.6)}
         ELSE {d(0)} END AS time_anomaly_score
  FROM hist
),
rules1 AS (
  SELECT *, greatest({d(0)}, least({d(1)}, ({terms}) / {d(max(tw, 0.01))})) AS raw_score
  FROM rules0
),
scored AS (
  SELECT * EXCLUDE (raw_score),
    {r4("raw_score")} AS fraud_score,
    raw_score >= {d(p.score_threshold)} AS is_fraud,
    CAST({nfired} AS BIGINT) AS rules_fired,
    concat_ws(',', {fired}) AS rules_triggered,
    event_time AS scored_at
  FROM rules1
)"""


def stateless_cte(threshold: float = 0.7) -> str:
    return f"""stateless0 AS (
  SELECT *,
    CASE {" ".join(f"WHEN amount > {d(t)} THEN {d(v)}" for t, v in STATELESS_AMOUNT_TIERS)}
         ELSE {d(0)} END AS amount_score,
    CASE WHEN event_time IS NOT NULL
          AND CAST((epoch_us(event_time) // 1000000) % 86400 AS DOUBLE) / 3600
              BETWEEN {STATELESS_TIME_HOURS[0]} AND {STATELESS_TIME_HOURS[1]}
         THEN {d(STATELESS_TIME_SCORE)} ELSE {d(0)} END AS time_score,
    CASE {" ".join(f"WHEN country IN ({', '.join(s(c) for c in cs)}) THEN {d(v)}"
                   for cs, v in STATELESS_GEO_TIERS)} ELSE {d(0)} END AS geo_score,
    CASE WHEN is_online = true AND amount > {d(STATELESS_ONLINE_MIN_AMOUNT)}
         THEN {d(STATELESS_ONLINE_SCORE)} ELSE {d(0)} END AS online_score
  FROM txns
),
stateless AS (
  SELECT *, amount_score + time_score + geo_score + online_score AS fraud_score,
    amount_score + time_score + geo_score + online_score >= {d(threshold)} AS is_fraud,
    event_time AS scored_at
  FROM stateless0
)"""


def case_sql(col: str, op: str, steps, default: str) -> str:
    arms = " ".join(f"WHEN {col} {op} {b} THEN {s(label)}" for b, label in steps)
    return f"CASE {arms} ELSE {s(default)} END"


AMOUNT_BUCKET_SQL = case_sql("amount", ">", AMOUNT_BUCKETS, AMOUNT_BUCKET_ELSE)
RISK_LEVEL_SQL = case_sql("fraud_score", ">=", RISK_LEVELS, RISK_LEVEL_ELSE)
SEVERITY_SQL = case_sql("fraud_rate_pct", ">=", SEVERITY_STEPS, SEVERITY_ELSE)
RISK_STATUS_SQL = "CASE " + " ".join(
    f"WHEN fraud_count >= {n} OR {m}_fraud_score >= {v} THEN {s(st)}"
    for st, n, m, v in RISK_STATUS_STEPS) + f" ELSE {s(RISK_STATUS_ELSE)} END"

STG = f"""wh AS (
  SELECT transaction_id, customer_id, CAST(amount AS DECIMAL(12,2)) AS amount, currency, merchant,
    category, country, card_type, CAST(fraud_score AS DECIMAL(6,4)) AS fraud_score, is_fraud,
    CAST(rules_fired AS INTEGER) AS rules_fired, event_time, scored_at, event_time AS loaded_at
  FROM scored
),
stg AS (
  SELECT transaction_id, customer_id, amount, currency, merchant, category, country, card_type,
    fraud_score, is_fraud, rules_fired, event_time, scored_at,
    CAST(event_time AS DATE) AS txn_date, hour(event_time) AS txn_hour,
    {AMOUNT_BUCKET_SQL} AS amount_bucket,
    {RISK_LEVEL_SQL} AS risk_level
  FROM wh
)"""


def daily_select(src: str = "stg") -> str:
    return f"""SELECT txn_date,
    count(*) AS total_transactions,
    CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
    {pct("sum(CASE WHEN is_fraud THEN 1 ELSE 0 END)", "count(*)", 4)} AS fraud_rate_pct,
    CAST(sum(amount) AS DOUBLE) AS total_amount,
    CAST(sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS DOUBLE) AS fraud_amount,
    {avg_exact("fraud_score", 4)} AS avg_fraud_score,
    {avg_exact("CASE WHEN is_fraud THEN fraud_score END", 4)} AS avg_fraud_score_flagged,
    count(DISTINCT customer_id) AS unique_customers,
    count(DISTINCT CASE WHEN is_fraud THEN customer_id END) AS fraud_customers,
    count(DISTINCT country) AS unique_countries,
    {avg_exact("rules_fired", 2)} AS avg_rules_fired
  FROM {src} GROUP BY txn_date"""


CATEGORY_SELECT = f"""SELECT category,
    count(*) AS total_transactions,
    CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
    {pct("sum(CASE WHEN is_fraud THEN 1 ELSE 0 END)", "count(*)", 2)} AS fraud_rate_pct,
    CAST(sum(amount) AS DOUBLE) AS total_amount,
    CAST(sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS DOUBLE) AS fraud_amount,
    {avg_exact("amount", 2)} AS avg_transaction_amount,
    {avg_exact("CASE WHEN is_fraud THEN amount END", 2)} AS avg_fraud_amount,
    count(DISTINCT customer_id) AS unique_customers
  FROM stg GROUP BY category"""

CUSTOMERS_SELECT = f"""SELECT *,
    {pct("fraud_count", "total_transactions", 2)} AS fraud_rate_pct,
    {RISK_STATUS_SQL} AS risk_status
  FROM (
    SELECT customer_id,
      count(*) AS total_transactions,
      CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
      CAST(sum(amount) AS DOUBLE) AS total_amount,
      CAST(sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS DOUBLE) AS fraud_amount,
      {avg_exact("fraud_score", 4)} AS avg_fraud_score,
      CAST(max(fraud_score) AS DOUBLE) AS max_fraud_score,
      min(event_time) AS first_transaction,
      max(event_time) AS last_transaction,
      count(DISTINCT country) AS unique_countries,
      count(DISTINCT category) AS unique_categories,
      count(DISTINCT merchant) AS unique_merchants
    FROM stg GROUP BY customer_id) c"""


def marts_ctes() -> str:
    return (f"daily AS ({daily_select()}),\ncategory_m AS ({CATEGORY_SELECT}),\n"
            f"customers AS ({CUSTOMERS_SELECT})")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def scoring_prefix(p=RULES) -> str:
    return with_(EV_TXNS, TXNS, hist_cte(p), rules_cte(p))


def staging_prefix(p=RULES) -> str:
    return with_(EV_TXNS, TXNS, hist_cte(p), rules_cte(p), STG)


def marts_prefix(p=RULES) -> str:
    return with_(EV_TXNS, TXNS, hist_cte(p), rules_cte(p), STG, marts_ctes())


# ---------------------------------------------------------------------------------------------
# Raw messages
# ---------------------------------------------------------------------------------------------

def _json(amount_text: str, ts_text: str, with_amount: bool = True, with_customer: bool = True):
    q = lambda x: f"""'"' || {x} || '"'"""
    parts = [f"""'{{"transaction_id":' || {q("transaction_id")}"""]
    if with_customer:
        parts.append(f"""',"customer_id":' || {q("customer_id")}""")
    if with_amount:
        parts.append(f"""',"amount":' || {amount_text}""")
    for c in ("currency", "merchant", "category", "country", "card_type"):
        parts.append(f"""',"{c}":' || {q(c)}""")
    parts.append(f"""',"timestamp":' || {q(ts_text)}""")
    parts.append(f"""',"device_id":' || {q("device_id")}""")
    parts.append("""',"is_online":' || CASE WHEN is_online THEN 'true' ELSE 'false' END""")
    parts.append("'}'")
    return "(" + " || ".join(parts) + ")"


AMT_TXT = "printf('%.2f', amount)"
RAW = f"""raw AS (
  SELECT *, CASE WHEN event_type = 'error' THEN event_id % 7 END AS kind,
    CASE
      WHEN event_type <> 'error' THEN {_json(AMT_TXT, '"timestamp"')}
      WHEN event_id % 7 = 0 THEN substring({_json(AMT_TXT, '"timestamp"')}, 1, 40)
      WHEN event_id % 7 = 1 THEN {_json(AMT_TXT, '"timestamp"', with_amount=False)}
      WHEN event_id % 7 = 2 THEN {_json(f"""'"' || {AMT_TXT} || '"'""", '"timestamp"')}
      WHEN event_id % 7 = 3 THEN {_json(AMT_TXT, "'not-a-time'")}
      WHEN event_id % 7 = 4 THEN {_json(AMT_TXT, '"timestamp"', with_customer=False)}
      WHEN event_id % 7 = 5 THEN 'garbage:' || transaction_id
      ELSE NULL END AS value
  FROM ev_txns
),
decoded AS (
  SELECT event_id AS "offset", value, kind,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE transaction_id END AS transaction_id,
    CASE WHEN kind IN (0, 4, 5, 6) THEN NULL ELSE customer_id END AS customer_id,
    CASE WHEN kind IN (0, 1, 2, 5, 6) THEN NULL ELSE amount END AS amount,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE currency END AS currency,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE merchant END AS merchant,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE category END AS category,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE country END AS country,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE card_type END AS card_type,
    CASE WHEN kind IN (0, 5, 6) THEN NULL WHEN kind = 3 THEN 'not-a-time' ELSE "timestamp" END
      AS "timestamp",
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE device_id END AS device_id,
    CASE WHEN kind IN (0, 5, 6) THEN NULL ELSE is_online END AS is_online,
    CASE WHEN kind IN (0, 3, 5, 6) THEN NULL ELSE event_time END AS event_time,
    coalesce(kind IN (0, 2, 5), false) AS is_corrupt
  FROM raw
),
dead AS (
  SELECT *, CASE WHEN value IS NULL OR trim(value) = '' THEN 'null_message'
    WHEN is_corrupt THEN 'malformed_json'
    WHEN transaction_id IS NULL THEN 'missing_transaction_id'
    WHEN customer_id IS NULL THEN 'missing_customer_id'
    WHEN amount IS NULL THEN 'missing_amount'
    WHEN event_time IS NULL THEN 'bad_timestamp'
    WHEN NOT (abs(amount) < 1e14) THEN 'amount_out_of_range' END AS reason
  FROM decoded
)"""


# ---------------------------------------------------------------------------------------------
# Statements
# ---------------------------------------------------------------------------------------------

RULE_NAMES = ("high_amount", "velocity", "geo_anomaly", "card_testing", "time_anomaly")


def _sql() -> dict[str, str]:
    sp, st, mp = scoring_prefix(), staging_prefix(), marts_prefix()
    hp = with_(EV_TXNS, TXNS, hist_cte(RULES))
    slp = with_(EV_TXNS, TXNS, stateless_cte())
    rawp = with_(EV_TXNS, RAW)
    score_cols = ", ".join(f"{r4(n + '_score')} AS {n}_score" for n in RULE_NAMES)
    trig = []
    for i, n in enumerate(RULE_NAMES):
        before = " + ".join(f"(CASE WHEN {m}_score > 0 THEN 1 ELSE 0 END)"
                            for m in RULE_NAMES[:i]) or "0"
        trig.append(f"SELECT transaction_id, CAST({before} AS BIGINT) AS rule_pos, {s(n)} AS rule,"
                    f" {r4(n + '_score')} AS rule_score FROM scored WHERE {n}_score > 0")
    as_of = s(MART.as_of_date)
    q = {
        "rule_score": sp + f"""SELECT transaction_id, customer_id, event_time, amount, country,
            {score_cols}, fraud_score, is_fraud, rules_fired, rules_triggered FROM scored""",
        "rule_high_amount": sp + f"SELECT transaction_id, amount, avg_amount, {r4('high_amount_score')} AS score FROM scored",
        "rule_velocity": sp + f"SELECT transaction_id, recent_count, {r4('velocity_score')} AS score FROM scored",
        "rule_geo": sp + f"SELECT transaction_id, country, has_history, is_new_country, {r4('geo_anomaly_score')} AS score FROM scored",
        "rule_card_testing": sp + f"SELECT transaction_id, amount, small_count, {r4('card_testing_score')} AS score FROM scored",
        "rule_time": sp + f"""SELECT transaction_id, "timestamp", {r4('time_anomaly_score')} AS score FROM scored""",
        "triggered_rules": sp + "\nUNION ALL\n".join(trig),
        "stateless_score": slp + """SELECT transaction_id, customer_id, amount, country, is_online,
            amount_score, time_score, geo_score, online_score, fraud_score, is_fraud FROM stateless""",
        "hist_recent_count": hp + "SELECT transaction_id, customer_id, event_time, recent_count FROM hist",
        "hist_small_count": hp + "SELECT transaction_id, amount, small_count FROM hist",
        "hist_avg_amount": hp + "SELECT transaction_id, prior_count, avg_amount FROM hist",
        "hist_new_country": hp + "SELECT transaction_id, country, has_history, is_new_country FROM hist",
        "hist_two_loads": hp + "SELECT transaction_id, recent_count, small_count, prior_count, "
                               "avg_amount, has_history, is_new_country FROM hist",
        "hist_loads": hp + "SELECT transaction_id, recent_count, small_count, prior_count, "
                           "avg_amount, has_history, is_new_country FROM hist",
        "dedup_loads": with_(EV_TXNS, TXNS) + """SELECT transaction_id,
            greatest(0, least(2, date_diff('day', DATE '2024-01-01', CAST(event_time AS DATE))
                                 // 10))::BIGINT AS load FROM txns""",
        "fct_category_loads": mp + "SELECT * FROM category_m",
        "dim_customers_loads": mp + "SELECT * FROM customers",
        "dim_customers_bucketed": mp + "SELECT * FROM customers",
        "dedup_replays": hp + "SELECT transaction_id, event_time, recent_count, prior_count FROM hist",
        "json_decode": rawp + """SELECT "offset", transaction_id, customer_id, amount, currency,
            merchant, category, country, card_type, "timestamp", device_id, is_online, event_time,
            is_corrupt FROM decoded""",
        "event_time_parse": with_(EV_TXNS) + f"""SELECT transaction_id,
            CASE WHEN event_type = 'error' THEN 'not-a-time'
                 WHEN event_id % 4 = 0 THEN strftime(event_time, '{TS_FMT}') || '+00:00'
                 WHEN event_id % 4 = 1 THEN strftime(event_time, '{TS_FMT}') || 'Z'
                 WHEN event_id % 4 = 2 THEN strftime(event_time + INTERVAL 330 MINUTE, '{TS_FMT}') || '+05:30'
                 ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S') || 'Z' END AS ts_text,
            CASE WHEN event_type = 'error' THEN NULL
                 WHEN event_id % 4 = 3 THEN date_trunc('second', event_time)
                 ELSE event_time END AS event_time,
            CASE WHEN event_type = 'error' THEN NULL
                 WHEN event_id % 4 = 2 THEN hour(event_time + INTERVAL 330 MINUTE)
                 ELSE hour(event_time) END AS own_hour,
            CASE WHEN event_type = 'error' THEN NULL ELSE hour(event_time) END AS utc_hour
            FROM ev_txns""",
        "sink_defaults": slp + """SELECT transaction_id, customer_id,
            CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, 'USD' AS currency, merchant,
            category, country, '' AS card_type,
            CAST(CAST(fraud_score AS DECIMAL(6,4)) AS DOUBLE) AS fraud_score, is_fraud,
            CAST(0 AS BIGINT) AS rules_fired FROM stateless""",
        "stg_scored": st + """SELECT transaction_id, customer_id, CAST(amount AS DOUBLE) AS amount,
            currency, merchant, category, country, card_type,
            CAST(fraud_score AS DOUBLE) AS fraud_score, is_fraud,
            CAST(rules_fired AS BIGINT) AS rules_fired, event_time, txn_date,
            CAST(txn_hour AS BIGINT) AS txn_hour, amount_bucket, risk_level FROM stg""",
        "amount_bucket": with_(EV_TXNS, TXNS) + f"SELECT transaction_id, amount, {AMOUNT_BUCKET_SQL} AS amount_bucket FROM txns",
        "risk_level": sp + f"SELECT transaction_id, fraud_score, {RISK_LEVEL_SQL} AS risk_level FROM scored",
        "fraud_alerts": sp + "SELECT transaction_id, customer_id, amount, merchant, country, fraud_score FROM scored WHERE is_fraud",
        "fct_daily": mp + "SELECT * FROM daily",
        "fct_category": mp + "SELECT * FROM category_m",
        "dim_customers": mp + "SELECT * FROM customers",
        "customer_window_stats": with_(EV_TXNS, TXNS) + f"""SELECT customer_id,
              ws AS window_start, ws + INTERVAL 10 MINUTE AS window_end,
              count(*) AS txn_count_10min,
              CAST(sum(CASE WHEN amount < {d(5)} THEN 1 ELSE 0 END) AS BIGINT) AS small_txn_count,
              {avg_exact("amount")} AS avg_amount_10min,
              max(amount) AS max_amount_10min
            FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, event_time) - k * INTERVAL 1 MINUTE AS ws
                  FROM txns, range(0, 10) r(k))
            GROUP BY customer_id, ws""",
        "incremental_filter": st + f""", target AS ({daily_select(
            "(SELECT * FROM stg WHERE txn_date <= DATE '" + MART.incremental_loaded_until + "')")}),
            inc AS (SELECT * FROM stg WHERE txn_date >=
                    (SELECT max(txn_date) FROM target) - INTERVAL {MART.lookback_days} DAY)
            {daily_select("inc")}""",
        "rule_performance": sp + "\nUNION ALL\n".join(
            f"SELECT {s(n)} AS rule, count(*) AS times_triggered FROM scored WHERE {n}_score > 0 "
            f"HAVING count(*) > 0" for n in RULE_NAMES),
        "scored_per_minute": sp + """SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS minute_start,
            count(*) AS scored_count,
            CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count
            FROM scored GROUP BY 1""",
        "headline_totals": sp + f"""SELECT count(*) AS total_scored,
            CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_detected,
            {pct("sum(CASE WHEN is_fraud THEN 1 ELSE 0 END)", "count(*)", 2)} AS fraud_rate_pct
            FROM scored""",
        "latest_n_per_customer": sp + f"""SELECT * FROM (
            SELECT customer_id, transaction_id, event_time, amount, fraud_score,
              row_number() OVER (PARTITION BY customer_id ORDER BY event_time DESC,
                                 transaction_id DESC) AS recency_rank
            FROM scored) t WHERE recency_rank <= {MART.latest_per_customer}""",
        "alerts_by_day": sp + f"""SELECT CAST(scored_at AS DATE) AS alert_date, scored_at,
            transaction_id, customer_id, amount, fraud_score, country, merchant
            FROM scored WHERE is_fraud AND CAST(scored_at AS DATE) = DATE {as_of}""",
        "lookup_upsert": sp + f"""SELECT customer_id, transaction_id, event_time, amount, merchant,
            category, country, fraud_score, is_fraud, CAST(2 AS BIGINT) AS write_version
            FROM scored WHERE event_time > CAST(DATE {as_of} AS TIMESTAMP) - INTERVAL 30 DAY""",
        "customer_stats": sp + """SELECT customer_id, count(*) AS total_transactions,
            CAST(sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS BIGINT) AS total_fraud,
            max(event_time) AS last_transaction_time,
            string_agg(DISTINCT country, ',' ORDER BY country) AS known_countries,
            string_agg(DISTINCT device_id, ',' ORDER BY device_id) AS known_devices
            FROM scored GROUP BY customer_id""",
    }
    q["scored_json"] = slp + """SELECT customer_id AS key,
        '{"transaction_id":"' || transaction_id || '","customer_id":"' || customer_id
        || '","amount":' || CAST(amount AS VARCHAR) || ',"merchant":"' || merchant
        || '","category":"' || category || '","country":"' || country
        || '","fraud_score":' || CAST(fraud_score AS VARCHAR)
        || ',"is_fraud":' || CASE WHEN is_fraud THEN 'true' ELSE 'false' END
        || ',"scored_at":"' || strftime(scored_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}' AS value
        FROM stateless"""
    q["dlq_split"] = rawp + """SELECT "offset", value, reason FROM dead WHERE reason IS NOT NULL"""
    q["dlq_counts"] = rawp + """SELECT reason, count(*) AS dead_letters FROM dead
        WHERE reason IS NOT NULL GROUP BY reason"""

    def chk(table, check, column, viol_sql):
        return (f"SELECT {s(table)} AS table_name, {s(check)} AS check_name, {s(column)} AS column_name, "
                f"CAST(coalesce(({viol_sql}), 0) AS BIGINT) AS violations, "
                f"CASE WHEN coalesce(({viol_sql}), 0) = 0 THEN 'pass' ELSE 'fail' END AS status")

    nn = lambda t, c: f"SELECT sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM {t}"  # noqa
    un = lambda t, c: (f"SELECT sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) FROM (SELECT {c}, count(*) AS n "  # noqa
                       f"FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})")
    q["dq_not_null"] = mp + "\nUNION ALL\n".join([
        chk("fct_fraud_daily", "not_null", "txn_date", nn("daily", "txn_date")),
        chk("fct_fraud_by_category", "not_null", "category", nn("category_m", "category")),
        chk("dim_fraud_customers", "not_null", "customer_id", nn("customers", "customer_id"))])
    q["dq_unique"] = mp + "\nUNION ALL\n".join([
        chk("fct_fraud_daily", "unique", "txn_date", un("daily", "txn_date")),
        chk("fct_fraud_by_category", "unique", "category", un("category_m", "category")),
        chk("dim_fraud_customers", "unique", "customer_id", un("customers", "customer_id"))])
    q["dq_range"] = mp + chk("fct_fraud_daily", "between", "fraud_rate_pct",
                             "SELECT sum(CASE WHEN fraud_rate_pct IS NOT NULL AND (fraud_rate_pct < 0 "
                             "OR fraud_rate_pct > 100) THEN 1 ELSE 0 END) FROM daily")
    q["dq_accepted"] = mp + chk("dim_fraud_customers", "accepted_values", "risk_status",
                                "SELECT sum(CASE WHEN risk_status IS NOT NULL AND risk_status NOT IN "
                                f"({', '.join(s(x) for x in RISK_STATUS_VALUES)}) THEN 1 ELSE 0 END) FROM customers")
    q["dq_violations"] = rawp + "\nUNION ALL\n".join([
        chk("raw_messages", "not_null", "customer_id", nn("decoded", "customer_id")),
        chk("raw_messages", "unique", "customer_id", un("decoded", "customer_id")),
        chk("raw_messages", "between", "amount",
            "SELECT sum(CASE WHEN amount < 1 OR amount > 1000 THEN 1 ELSE 0 END) FROM decoded"),
        chk("raw_messages", "accepted_values", "country",
            "SELECT sum(CASE WHEN country NOT IN ('US', 'CA', 'GB') THEN 1 ELSE 0 END) "
            "FROM decoded")])
    q["lookup_expiry"] = with_(EV_TXNS, TXNS, hist_cte(RULES), rules_cte(RULES),
                               stateless_cte()) + """, writes AS (
        SELECT customer_id, event_time, transaction_id, fraud_score, is_fraud, 1 AS v FROM stateless
        UNION ALL
        SELECT customer_id, event_time, transaction_id, fraud_score, is_fraud, 2 AS v FROM scored
        WHERE is_online
      ), latest AS (
        SELECT *, row_number() OVER (PARTITION BY customer_id, event_time, transaction_id
                                     ORDER BY v DESC) AS n FROM writes)
      SELECT customer_id, event_time, transaction_id, fraud_score, is_fraud,
        CAST(v AS BIGINT) AS write_version
      FROM latest WHERE n = 1 AND event_time > TIMESTAMP '2024-02-12 00:00:00' - INTERVAL 30 DAY"""
    as_of_ts = f"TIMESTAMP '{MART.as_of_date} 23:59:59'"
    age = f"(CAST(epoch_us({as_of_ts}) - epoch_us(newest) AS DOUBLE) / 60000000.0)"
    q["dq_freshness"] = st + f"""SELECT 'scored_transactions' AS table_name,
        'freshness' AS check_name, 'loaded_at' AS column_name, newest,
        {rnd(age, 2)} AS age_minutes,
        CASE WHEN newest IS NULL OR {age} >= {d(MART.freshness_error_minutes)} THEN 'error'
             WHEN {age} >= {d(MART.freshness_warn_minutes)} THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT max(loaded_at) AS newest FROM wh)"""
    q["dash_rate"] = mp + "SELECT txn_date AS time, fraud_rate_pct FROM daily ORDER BY txn_date"
    q["dash_volume"] = mp + f"SELECT CAST(sum(total_transactions) AS BIGINT) AS value FROM daily WHERE txn_date = DATE {as_of}"
    q["dash_count"] = mp + f"SELECT CAST(sum(fraud_count) AS BIGINT) AS value FROM daily WHERE txn_date = DATE {as_of}"
    q["dash_amount"] = mp + f"SELECT sum(fraud_amount) AS value FROM daily WHERE txn_date = DATE {as_of}"
    q["dash_category"] = mp + "SELECT category, fraud_rate_pct, fraud_count FROM category_m ORDER BY fraud_rate_pct DESC, category"
    q["dash_high_risk"] = mp + f"""SELECT customer_id, risk_status, fraud_count, fraud_amount,
        avg_fraud_score FROM customers WHERE risk_status IN ({", ".join(s(x) for x in HIGH_RISK_STATUSES)})
        ORDER BY fraud_count DESC, customer_id LIMIT {MART.top_customers}"""
    q["dash_severity"] = mp + f"SELECT txn_date, fraud_rate_pct, {SEVERITY_SQL} AS severity FROM daily"
    return q


def _dates_as_timestamps(q: dict[str, str]) -> dict[str, str]:
    """Same hand-over as the Spark side (plans/catalog.py DATE_OUTPUTS): DATE columns of these
    outputs as midnight timestamps."""
    from txnguard.plans.catalog import DATE_OUTPUTS
    out = dict(q)
    for name, cols in DATE_OUTPUTS.items():
        repl = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
        out[name] = f"SELECT * REPLACE ({repl}) FROM ({q[name]})"
    return out


ORACLE_SQL: dict[str, str] = _dates_as_timestamps(_sql())
