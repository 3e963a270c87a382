"""The customer history that earlier loads leave to later ones (H1-H4 across loads).

Days are those of the history's segments. Two tables lie in a `DayStore`: segment totals (who, seg,
the four sums) and timed changes (who, t, seg, the sums). Each generation also holds, per customer,

* `balances`: the sums of all folded changes before the generation's base day,
* `firsts`: when each country was first seen.

A load touches some days. What came before a segment is the customer's balance at the base day plus
the segment totals since then, or minus those between a late segment and the base day. So a load
reads

* balances and first-seen times, whose size is that of the customers, not of the loads,
* folded totals from the earlier of base day and first touched day up to the last touched day,
* folded changes of the touched days only,
* the few loads that are not folded yet,

by partition, and nothing else of what is stored. Folding moves the base day up to `open_days`
before the newest folded day. The result is the same whenever loads are folded (tested).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators.history import (AMOUNT_DECIMAL, SUMS, Past, history_tables,
                                        segment_micros)
from txnguard.params import RuleParams
from txnguard.plans.day_store import DayStore, Generation, Table

_SUMS_DDL = f"dn long, ds {AMOUNT_DECIMAL}, dv long, dk long"
_FIRSTS_DDL = "who string, cty string, first long"


def _summed(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.sum(c).cast(AMOUNT_DECIMAL if c == "ds" else "long").alias(c) for c in SUMS])


def _day(micros) -> F.Column:
    return F.to_date(F.timestamp_micros(micros))


def _earliest(df: DataFrame) -> DataFrame:
    return df.groupBy("who", "cty").agg(F.min("first").alias("first"))


TABLES = {
    "totals": Table(f"who string, seg long, {_SUMS_DDL}",
                    lambda df: _summed(df, "who", "seg", "day")),
    "changes": Table(f"who string, t long, seg long, {_SUMS_DDL}",
                     lambda df: _summed(df, "who", "t", "seg", "day")),
    # by the day a country was first seen in a load
    "firsts": Table(_FIRSTS_DDL, lambda df: df),
}
SORTED = {"totals": ("who", "seg"), "changes": ("who", "t")}


class HistoryStore:
    def __init__(self, spark: SparkSession, root: str, rules: RuleParams, fold_every: int = 8,
                 keep: int = 2, open_days: int = 1):
        self.spark, self.rules, self.open_days = spark, rules, open_days
        # first-seen times are folded into one table per generation, not by day
        self.store = DayStore(spark, root, {k: TABLES[k] for k in ("totals", "changes")},
                              fold_every, keep)
        self.loose = DayStore(spark, root, TABLES, fold_every, keep)

    def _kept(self, gen: Generation, name: str, ddl: str) -> DataFrame:
        """A table of a generation that is not partitioned by day."""
        if not gen.number:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(self.store._gen(gen.number, name))

    def _balances(self, gen: Generation) -> DataFrame:
        return self._kept(gen, "balances", f"who string, {_SUMS_DDL}")

    def past(self, txns: DataFrame, load: int) -> Past | None:
        """What load number `load`, with these transactions, needs of the loads before it."""
        rows = txns.select(F.to_date("event_time").alias("d")).filter("d is not null").distinct()
        days = sorted(str(r.d) for r in rows.collect())       # bounded by the days of the load
        gen = self.store.generation()
        loads = self.store.loads(gen, before=load)
        if not days or not (gen.number or loads):
            return None
        changes = self.store.stored("changes", gen, loads, set(days))
        totals = self.store.fresh("totals", loads).select("who", "seg", *SUMS)
        firsts = self.loose.fresh("firsts", loads).select("who", "cty", "first")
        if gen.number:
            base = gen.extra["base_day"]
            begin = min(base, days[0])
            span = self.store.folded("totals", gen, first=begin, last=days[-1])
            # the balance at `begin`: what lies between it and the base day taken out again
            late = (self.store.folded("totals", gen, first=begin,
                                      last=str(date.fromisoformat(base) - timedelta(days=1)))
                    .select("who", *[(-F.col(c)).alias(c) for c in SUMS]))
            opening = _summed(self._balances(gen).unionByName(late), "who")
            at = F.unix_micros(F.lit(begin).cast("timestamp")) - segment_micros(self.rules)
            totals = totals.unionByName(opening.select("who", at.alias("seg"), *SUMS)) \
                .unionByName(span.select("who", "seg", *SUMS))
            firsts = firsts.unionByName(self._kept(gen, "firsts", _FIRSTS_DDL))
        return Past(_summed(totals, "who", "seg"), changes.select("who", "t", "seg", *SUMS),
                    _earliest(firsts))

    def add(self, txns: DataFrame, load: int) -> None:
        """Store what load number `load` leaves behind; a rerun replaces it."""
        left = history_tables(txns, self.rules)
        self.loose.add(load, "totals", left.totals.withColumn("day", _day("seg")), SORTED["totals"])
        self.loose.add(load, "changes", left.changes.withColumn("day", _day("seg")),
                       SORTED["changes"])
        self.loose.add(load, "firsts", left.firsts.withColumn("day", _day("first")))

    def fold_if_due(self) -> Generation | None:
        due = self.store.due()
        return self.fold(due) if due else None

    def fold(self, loads: list[int]) -> Generation:
        """Merge these loads, the oldest ones that are not folded, into a new generation."""
        return self.store.fold(loads, SORTED, self._fold_more)

    def _fold_more(self, old: Generation, number: int, loads: list[int]) -> dict:
        days = sorted({*old.places("totals"), *[
            d for n in loads for d in self.store.parts_of(n, "totals")]})
        before = (old.extra or {}).get("base_day")
        base = str(date.fromisoformat(days[-1]) - timedelta(days=self.open_days)) if days else (
            before or "1970-01-01")
        base = max(base, before or base)
        fresh = self.store.fresh("totals", loads).filter(F.col("day") < F.lit(base).cast("date"))
        moved = self.store.folded("totals", old, first=before,
                                  last=str(date.fromisoformat(base) - timedelta(days=1)))
        balances = _summed(self._balances(old).unionByName(fresh.select("who", *SUMS))
                           .unionByName(moved.select("who", *SUMS)), "who")
        balances.write.parquet(self.store._gen(number, "balances"))
        firsts = _earliest(self._kept(old, "firsts", _FIRSTS_DDL).unionByName(
            self.loose.fresh("firsts", loads).select("who", "cty", "first")))
        firsts.write.parquet(self.store._gen(number, "firsts"))
        return {"base_day": base}
