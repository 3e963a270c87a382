"""Rule expressions against the reference's unit tests, with exact expected values.

History values are given as columns next to the transaction (the reference's mock history)."""

import pytest
from pyspark.sql import functions as F

from txnguard.operators.scoring import apply_rules
from txnguard.params import RuleParams

P = RuleParams()
HIST = "recent_count long, small_count long, avg_amount double, has_history boolean, " \
       "is_new_country boolean, known_countries string, us long"


def score(spark, p=P, **kw):
    base = dict(transaction_id="txn-001", customer_id="cust-001", amount=50.0, country="US",
                timestamp="2024-06-15T14:00:00+00:00", recent_count=0, small_count=0,
                avg_amount=100.0, known={"US"})
    base.update(kw)
    known = base.pop("known")
    country = base["country"] if base["country"] is not None else "US"
    row = dict(base, has_history=bool(known), is_new_country=country not in known,
               known_countries=", ".join(f"'{c}'" for c in sorted(known)), us=0)
    schema = ("transaction_id string, customer_id string, amount double, country string, "
              "timestamp string, " + HIST)
    cols = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(row[c] for c in cols)], schema)
    return apply_rules(df, p, stamp=False).collect()[0]


class TestHighAmount:
    def test_normal_amount(self, spark):
        assert score(spark, amount=50.0).high_amount_score == 0.0

    def test_above_threshold(self, spark):
        assert score(spark, amount=6000.0).high_amount_score == pytest.approx(0.6)

    def test_above_customer_avg(self, spark):
        r = score(spark, amount=400.0, avg_amount=100.0)
        assert r.high_amount_score == pytest.approx(0.6)
        assert r.high_amount_reason == "Amount $400.00 is 4.0x customer average"

    def test_threshold_is_strict(self, spark):
        assert score(spark, amount=5000.0, avg_amount=0.0).high_amount_score == 0.0

    def test_caps_at_one(self, spark):
        assert score(spark, amount=50000.0).high_amount_score == 1.0


class TestVelocity:
    def test_normal(self, spark):
        assert score(spark, recent_count=2).velocity_score == 0.0

    def test_high(self, spark):
        assert score(spark, recent_count=8).velocity_score == pytest.approx(0.8)

    def test_boundary_fires_at_max(self, spark):
        assert score(spark, recent_count=5).velocity_score == pytest.approx(0.5)


class TestGeo:
    def test_known_country(self, spark):
        assert score(spark, country="US").geo_anomaly_score == 0.0

    def test_unknown_high_risk(self, spark):
        r = score(spark, country="NG")
        assert r.geo_anomaly_score == 0.9
        assert r.geo_anomaly_reason == "Transaction from NG, known countries: {'US'}"

    def test_unknown_normal(self, spark):
        assert score(spark, country="FR").geo_anomaly_score == 0.5

    def test_no_history_never_fires(self, spark):
        assert score(spark, country="NG", known=set()).geo_anomaly_score == 0.0

    def test_missing_country_is_us(self, spark):
        assert score(spark, country=None).geo_anomaly_score == 0.0


class TestCardTesting:
    def test_normal_amount(self, spark):
        assert score(spark, amount=50.0, small_count=5).card_testing_score == 0.0

    def test_pattern(self, spark):
        assert score(spark, amount=2.99, small_count=5).card_testing_score == pytest.approx(5 / 6)

    def test_below_min_count(self, spark):
        assert score(spark, amount=2.99, small_count=2).card_testing_score == 0.0


class TestTimeAnomaly:
    def test_normal_hours(self, spark):
        assert score(spark, timestamp="2024-06-15T14:00:00+00:00").time_anomaly_score == 0.0

    def test_suspicious_hours(self, spark):
        assert score(spark, timestamp="2024-06-15T03:00:00+00:00").time_anomaly_score == 0.6

    @pytest.mark.parametrize("ts,expected", [
        ("2024-06-15T03:00:00+05:00", 0.6),   # hour in the string's own offset
        ("2024-06-15T05:59:59Z", 0.6),
        ("2024-06-15T06:00:00Z", 0.0),
        ("2024-06-15T01:59:59.999999+00:00", 0.0),
        ("not-a-time", 0.0),
        (None, 0.0),
    ])
    def test_boundaries(self, spark, ts, expected):
        assert score(spark, timestamp=ts).time_anomaly_score == expected


class TestScoreTransaction:
    def test_clean(self, spark):
        r = score(spark)
        assert r.fraud_score == 0.0 and r.is_fraud is False and r.rules_fired == 0

    def test_fraudulent_exact(self, spark):
        r = score(spark, recent_count=10, small_count=5, avg_amount=50.0, amount=3.0,
                  country="NG", timestamp="2024-06-15T03:00:00+00:00")
        # 0.25*1 + 0.2*0.9 + 0.15*5/6 + 0.1*0.6
        assert r.fraud_score == 0.615
        assert r.is_fraud is False
        assert r.rules_fired == 4
        assert [t.rule for t in r.triggered_rules] == [
            "velocity", "geo_anomaly", "card_testing", "time_anomaly"]
        assert [t.score for t in r.triggered_rules] == [1.0, 0.9, 0.8333, 0.6]

    def test_threshold_is_a_parameter(self, spark):
        r = score(spark, P.with_(score_threshold=0.6), recent_count=10, small_count=5,
                  avg_amount=50.0, amount=3.0, country="NG",
                  timestamp="2024-06-15T03:00:00+00:00")
        assert r.is_fraud is True

    def test_score_bounds_and_fired_count(self, spark):
        from txnguard.operators.scoring import rule_score
        from txnguard.params import FIXTURE_PARAMS
        from txnguard.sources.fixtures import load_transactions
        s = rule_score(load_transactions(spark, "/root/testdata/sf0.001"), FIXTURE_PARAMS)
        bad = s.filter((F.col("fraud_score") < 0) | (F.col("fraud_score") > 1)
                       | (F.col("rules_fired") != F.size("triggered_rules"))).count()
        assert bad == 0


def test_reason_texts(spark):
    r = score(spark, amount=6000.0)
    assert r.high_amount_reason == "Amount $6000.00 exceeds threshold $5000.00"
    assert score(spark, recent_count=8).velocity_reason == "8 transactions in 10 minutes (max: 5)"
    assert score(spark, amount=2.99, small_count=5).card_testing_reason == \
        "5 small transactions (<$5.0) in 5 minutes"
    assert score(spark, timestamp="2024-06-15T03:00:00+00:00").time_anomaly_reason == \
        "Transaction at 3:00 UTC (unusual hours)"
    assert score(spark).velocity_reason == ""
