"""History store and id index over many loads: equal to one load, and a bounded part is read."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.operators.history import with_history
from txnguard.params import FIXTURE_PARAMS
from txnguard.plans import loads
from txnguard.plans.day_store import DayStore, LoadLog, Table
from txnguard.plans.group_store import CUSTOMERS, GroupStore
from txnguard.plans.history_store import HistoryStore
from txnguard.plans.id_index import IdIndex
from txnguard.plans.pipeline import Pipeline
from txnguard.sources.fixtures import load_transactions

OUT = ["transaction_id", "recent_count", "small_count", "prior_count", "avg_amount",
       "has_history", "is_new_country"]


def size_of(*frames):
    return sum(os.path.getsize(f.removeprefix("file://")) for df in frames for f in df.inputFiles())


def test_load_log(spark, scratch):
    log = LoadLog(spark, scratch)
    assert [log.claim(x) for x in ("01", "1", "007", "2024-01-30", "01")] == [1, 2, 3, 4, 1]
    for bad in ("", "a/b", "a b", "..", "x" * 200, 7, "ä", "a=b"):
        with pytest.raises(ValueError):
            log.claim(bad)


def test_history_over_loads_equals_one(spark, scratch):
    """Six loads; every third customer's rows come a load late, so loads reach behind the base
    day. Scores of a customer are in order, so they equal those of one load."""
    txns = load_transactions(spark, "/root/testdata/sf0.001").select(
        "transaction_id", "customer_id", "amount", "country", "event_time")
    day = F.dayofmonth("event_time") - 1
    n = F.floor(day / 6) + (F.substring("customer_id", -1, 1).cast("int") % 3 == 0).cast("int")
    txns = txns.withColumn("load", n).cache()
    store = HistoryStore(spark, f"{scratch}/h", FIXTURE_PARAMS, fold_every=1, keep=1)
    got = []
    for i in range(7):
        rows = txns.filter(F.col("load") == i).drop("load")
        load = i + 1
        past = store.past(rows, load)
        got += [tuple(r) for r in with_history(rows, FIXTURE_PARAMS, past=past).select(*OUT)
                .collect()]
        store.add(rows, load)
        if i == 2:                       # a rerun of a load that isn't folded changes nothing
            again = store.past(rows, load)
            assert sorted(map(tuple, with_history(rows, FIXTURE_PARAMS, past=again).select(*OUT)
                              .collect())) == sorted(got[-rows.count():])
            store.add(rows, load)
        store.fold_if_due()
    want = [tuple(r) for r in with_history(txns, FIXTURE_PARAMS).select(*OUT).collect()]
    assert sorted(got) == sorted(want)
    assert store.store.generation().number > 2
    with pytest.raises(ValueError):
        store.add(rows, 1)
    txns.unpersist()


def test_history_reads_a_bounded_part(spark, scratch):
    """Loads of one day each: the bytes that a load reads do not grow with their number."""
    store = HistoryStore(spark, f"{scratch}/h", FIXTURE_PARAMS, fold_every=2, keep=1)
    read = {}
    for load in range(1, 10):
        rows = spark.range(300).select(
            F.concat(F.lit("c"), (F.col("id") % 40).cast("string")).alias("customer_id"),
            F.concat(F.lit(f"t{load}-"), F.col("id").cast("string")).alias("transaction_id"),
            (F.col("id") % 50).cast("double").alias("amount"), F.lit("US").alias("country"),
            (F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(
                F.lit(load), F.lit(0), F.col("id").cast("int"))).alias("event_time"))
        past = store.past(rows, load)
        read[load] = size_of(past.totals, past.changes, past.firsts) if past else 0
        store.add(rows, load)
        store.fold_if_due()
    early = max(read[n] for n in (4, 5))
    assert early > 0 and max(read[n] for n in (8, 9)) < 1.3 * early
    # a load of one day does not see the days that lie behind the base day
    past = store.past(rows, 10)
    days = {f.split("day=")[1][:10] for f in past.changes.inputFiles()}
    assert len(days) <= 1


def ids_of(spark, ids, day="2024-03-01"):
    return spark.createDataFrame([(i, f"{day} 10:00:00") for i in ids],
                                 "transaction_id string, t string").select(
        "transaction_id", F.to_timestamp("t").alias("event_time"))


def test_index_drops_exactly_the_known(spark, scratch):
    rng = random.Random(4)
    index = IdIndex(spark, f"{scratch}/i", fold_every=3, keep=1)
    seen = {}
    for load in range(1, 7):
        day = f"2024-03-{1 + load // 3:02d}"
        batch = {f"id{rng.randrange(600)}" for _ in range(200)}
        rows = ids_of(spark, sorted(batch), day)
        new = {r.transaction_id for r in index.new_rows(rows, load).collect()}
        near = {i for i, d in seen.items() if abs(int(d[-2:]) - int(day[-2:])) <= 1}
        assert new == batch - near
        index.add(index.new_rows(rows, load), load)
        seen |= {i: day for i in new}
        index.fold_if_due()
    odd = spark.createDataFrame([(None, None), ("x", None)], "transaction_id string, t string") \
        .select("transaction_id", F.to_timestamp("t").alias("event_time"))
    assert index.new_rows(odd, 99).count() == 2
    assert index.new_rows(odd.limit(0), 99).count() == 0


def test_false_hits_drop_nothing(spark, scratch, monkeypatch):
    """Filters of one word say yes to everything; the exact keys decide."""
    from txnguard.plans import id_index
    monkeypatch.setattr(id_index, "WORDS", 1)
    index = IdIndex(spark, f"{scratch}/i")
    index.add(ids_of(spark, [f"a{i}" for i in range(300)]), 1)
    rows = ids_of(spark, [f"a{i}" for i in range(0, 600, 2)])
    assert {r.transaction_id for r in index.new_rows(rows, 2).collect()} == {
        f"a{i}" for i in range(300, 600, 2)}


def test_fifty_loads_read_a_bounded_part(spark, scratch):
    """Loads of one day each. What the index holds of a load's day stays the same, and of other
    days nothing is read."""
    index = IdIndex(spark, f"{scratch}/i", replay_days=0, fold_every=4, keep=1)
    sizes = []
    for load in range(1, 51):
        index.add(ids_of(spark, [f"{load}-{i}" for i in range(20)], f"2024-{3 + load // 28:02d}-"
                         f"{1 + load % 28:02d}"), load)
        index.fold_if_due()
        if load % 10 == 0:
            gen = index.store.generation()
            loads = index.store.loads(gen)
            today = {f"2024-{3 + load // 28:02d}-{1 + load % 28:02d}"}
            frames = [index.store.stored(t, gen, loads, today) for t in ("filters", "keys")]
            sizes.append(size_of(*frames))
            assert len(loads) <= 6
    assert max(sizes) < 1.5 * min(sizes)


def test_a_fold_that_fails_changes_nothing(spark, scratch):
    store = DayStore(spark, f"{scratch}/s", {"t": Table("k long, n long", lambda df: df.groupBy(
        "day", "k").agg(F.sum("n").alias("n")))}, fold_every=1, keep=0)

    def rows(k):
        return spark.createDataFrame([(k, 1)], "k long, n long").withColumn(
            "day", F.lit("2024-01-01").cast("date"))

    def total():
        gen = store.generation()
        both = store.folded("t", gen).unionByName(store.fresh("t", store.loads(gen)))
        return both.agg(F.sum("n")).first()[0]
    store.add(1, "t", rows(1))
    store.fold([1], {})
    store.add(2, "t", rows(1))

    def fail(*_):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        store.fold([2], {}, fail)
    assert total() == 2 and store.generation().number == 1
    store.fold([2], {})
    assert total() == 2 and store.folded("t", store.generation()).count() == 1
    store.add(3, "t", rows(2))
    store.fold([3], {})
    assert total() == 3


def test_group_store_runs_a_loads_rows_twice(spark, scratch):
    """Once for its pairs and once for its measures, whatever is written and sorted later."""
    seen = spark.sparkContext.accumulator(0)
    store = GroupStore(spark, f"{scratch}/store", "customer_id", CUSTOMERS, ("country", "merchant"),
                       buckets=4, fold_every=1, keep=1)

    def rows(load):
        made = spark.range(600).selectExpr(
            "concat('c', id % 40) as customer_id", f"concat('l', id % {3 + load}) as country",
            "concat('m', id % 7) as merchant", "id % 5 = 0 as is_fraud",
            "cast(id as decimal(12,2)) as amount", "cast(0.5 as decimal(6,4)) as fraud_score",
            f"timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, {load}) as event_time")

        def run(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return made, made.mapInArrow(run, made.schema)

    every = []
    for load in (1, 2, 3):
        seen.value = 0
        plain, counted = rows(load)
        store.add(counted, load)
        assert 600 <= seen.value <= 1200
        store.fold_if_due()
        every.append(plain)
    assert not any(n.startswith("_work") for n in os.listdir(f"{scratch}/store"))
    both = every[0].unionByName(every[1]).unionByName(every[2])
    want = both.groupBy("customer_id").agg(
        F.count("*"), F.countDistinct("country"), F.countDistinct("merchant"), F.sum("amount"))
    got = store.groups().select("grp", "n", "new_country", "new_merchant", "amount")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_loads_write_the_columns_that_the_store_reads(spark, monkeypatch):
    written = []
    plain = loads._written
    monkeypatch.setattr(loads, "_written", lambda df, path: written.append(df.columns)
                        or plain(df, path))
    loads.customers_over_loads(Pipeline(spark, SF_SMALL))
    assert [set(c) for c in written] == [{
        "customer_id", "country", "category", "merchant", "is_fraud", "amount", "fraud_score",
        "event_time", "load"}]
