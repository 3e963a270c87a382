"""Checks counted while tables are written equal the same checks by reading them."""

import pytest

from txnguard.operators import quality
from txnguard.operators.watch import Newest
from txnguard.plans.batch_job import BatchJob
from txnguard.plans.published import Published
from txnguard.plans.sinks import overwrite_partitions
from txnguard.sources.ingest import load_raw_messages

CHECKS = (("not_null", "k"), ("unique", "k"), ("between", "rate", 0, 100),
          ("accepted_values", "status", ["good", "bad"]))
ROWS = "day int, k string, rate double, status string"


def by_reading(table):
    rows = quality.checked(table.read(), "t", CHECKS).collect()
    got = {(r.check_name, r.column_name): r.violations for r in rows}
    return [got[k, c] for k, c, *_ in CHECKS]


def test_counted_while_written(spark, scratch, monkeypatch):
    table = Published(spark, f"{scratch}/t", "day")
    assert not table.exists()
    bad = [(1, "a", 5.0, "good"), (1, "a", 101.0, "bad"), (1, "a", -1.0, None), (2, None, 1.0, "odd"),
           (2, None, None, "good"), (3, "b", 2.0, "good"), (3, "b", 2.0, "good")]
    df = spark.createDataFrame(bad, ROWS)
    table.publish(df, checks=CHECKS)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, df.select(
        *table.read().columns).collect()))
    want = [2, 2, 2, 1]
    assert by_reading(table) == want
    with monkeypatch.context() as m:               # the table isn't read
        m.setattr(Published, "read", lambda self: pytest.fail("read"))
        assert table.violations("t", CHECKS) == want
    # some of the violations are replaced: which ones is told by reading
    table.publish(spark.createDataFrame([(2, "c", 1.0, "good")], ROWS), [2], CHECKS)
    assert table.violations("t", CHECKS) == by_reading(table) == [0, 2, 2, 0]
    # all of it replaced, then a part, then a part by nothing
    good = spark.createDataFrame([(1, "a", 5.0, "good"), (2, "b", 1.0, "bad")], ROWS)
    table.publish(good, checks=CHECKS)
    table.publish(spark.createDataFrame([(2, "b", 200.0, "bad")], ROWS), [2], CHECKS)
    with monkeypatch.context() as m:
        m.setattr(Published, "read", lambda self: pytest.fail("read"))
        assert table.violations("t", CHECKS) == [0, 0, 1, 0]
    table.publish(good.limit(0), [2], CHECKS)
    assert table.violations("t", CHECKS) == by_reading(table) == [0, 0, 0, 0]


def test_newest_of_a_write(spark, scratch):
    df = spark.sql("select 1 as d, timestamp'2024-01-01 10:00:00' as at union all "
                   "select 2, timestamp'2024-01-02 11:30:00' union all select 3, null")
    newest = Newest("at")
    overwrite_partitions(df, f"{scratch}/w", ["d"], watch=newest)
    row = spark.sql("select timestamp_ntz'2024-01-03 00:00:00' as newest")
    as_text = lambda f: f.selectExpr("string(at)").first()[0]
    assert as_text(newest.frame(spark)) == "2024-01-02 11:30:00"
    assert as_text(newest.frame(spark, row)) == "2024-01-03 00:00:00"


def test_job_reports_without_reading_marts(spark, scratch, monkeypatch):
    """Two loads: the report equals the checks by reading, and no check reads a table."""
    raw = load_raw_messages(spark, "/root/testdata/sf0.001").filter("value is not null")
    monkeypatch.setattr(quality, "checked", lambda *a: pytest.fail("a check read a table"))
    for i, part in enumerate((raw.filter("dayofmonth(publish_time) <= 12"),
                              raw.filter("dayofmonth(publish_time) > 12"))):
        job = BatchJob(spark, scratch, run_id=f"r{i}")
        job.run(part)
    report = job.read("quality_report")
    plain = quality.union_all(list(quality.mart_checks(
        job.read("fct_fraud_daily"), job.read("fct_fraud_by_category"),
        job.read("dim_fraud_customers")).values()))
    assert report.columns == plain.columns and report.dtypes == plain.dtypes
    assert sorted(map(str, report.collect())) == sorted(map(str, plain.collect()))
    newest = job.read("scored_transactions").selectExpr(
        "cast(max(loaded_at) as timestamp_ntz)").first()[0]
    assert job.read("freshness_report").first().newest == newest
