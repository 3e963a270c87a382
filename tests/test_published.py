"""Publication: a reader sees one version, a killed job changes nothing, versions are kept apart."""

import pytest
from pyspark.sql import functions as F

from txnguard.plans import published, sinks
from txnguard.plans.published import Published


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table_and_killed_job(spark, scratch, monkeypatch):
    t = Published(spark, f"{scratch}/t")
    with pytest.raises(FileNotFoundError):
        t.read()
    t.publish(rows(spark, (1, "a"), (2, "b")))
    reader = t.read()                            # started before the rebuild
    t.publish(rows(spark, (3, "c")))
    assert content(reader) == [(1, "a"), (2, "b")] and content(t.read()) == [(3, "c")]

    def killed(*_):
        raise RuntimeError("killed")
    with monkeypatch.context() as m:             # all rows are written, the last step is not done
        m.setattr(published, "write_small", killed)
        with pytest.raises(RuntimeError):
            t.publish(rows(spark, (4, "d")))
    assert content(t.read()) == [(3, "c")]
    t.publish(rows(spark, (5, "e")))
    assert content(t.read()) == [(5, "e")]
    t.publish(rows(spark))
    assert t.read().columns == ["k", "v"] and t.read().count() == 0


def test_partitions_are_replaced_one_by_one(spark, scratch):
    t = Published(spark, f"{scratch}/t", "k")
    t.publish(rows(spark, (1, "a"), (2, "b"), (3, "c")))
    kept = {f for f in t.read().inputFiles() if "/k=3/" in f}
    t.publish(rows(spark, (1, "z")), touched=[1, 2])
    assert content(t.read().select("k", "v")) == [(1, "z"), (3, "c")]
    assert kept <= set(t.read().inputFiles())
    with pytest.raises(ValueError):
        t.publish(rows(spark, (9, "x")), touched=[1])
    assert content(t.read().select("k", "v")) == [(1, "z"), (3, "c")]
    for i in range(4):
        t.publish(rows(spark, (1, str(i))), touched=[1])
    assert content(t.read().select("k", "v")) == [(1, "3"), (3, "c")]


def test_compact_leaves_a_version_that_lands_meanwhile(spark, scratch, monkeypatch):
    path = f"{scratch}/t"

    def version(n):
        df = spark.createDataFrame([(f"k{n}", f"v{n}"), ("same", f"v{n}")], "id string, v string")
        sinks.append_version(df.withColumn("d", F.lit("2024-01-01").cast("date")), path, "d", n)
    version(1)
    version(2)
    materialize = sinks._materialize

    def meanwhile(df):
        out = materialize(df)
        version(3)
        return out
    monkeypatch.setattr(sinks, "_materialize", meanwhile)
    sinks.compact(spark, path, ("id",), "d", ["2024-01-01"])
    got = {r.id: r.v for r in sinks.read_latest(spark, path, ("id",)).collect()}
    assert got == {"k1": "v1", "k2": "v2", "k3": "v3", "same": "v3"}
