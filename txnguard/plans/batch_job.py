"""End-to-end batch loads: raw messages -> dead letters + scored warehouse -> marts, lookup tables,
customer stats and a data-quality report. Any number of loads add up.

A load parses its messages once and lands them. Messages whose transaction id an earlier row of
the load or an earlier load has are replays and are left out before history: an index of Bloom
filters and keys per day (`id_index`) tells them, at a cost that depends on the days of the load.
History continues from the store that earlier loads left behind (`history_store`: balances per
customer, segment totals and changes by day), so a load reads the stored history of its own days
and not that of all loads.
The daily mart is rebuilt for the days that the load touches, however old. The category and customer
marts and the customer stats grow by the load's own rows (`group_store`: counters and new pairs per
group), and only the buckets of groups that the load touches are read and written again. Marts and
reports are published (`published`): a reader sees the version before or after a load. `read` gives
any table of the job.

Scores are those at the time of the load: a late row sees every stored earlier row, but does not
change scores given before it came (the reference scores each transaction once, on arrival).

A run id is any text of letters, digits, '.', '_' and '-'; the log of loads gives it a number, under
which every table of the load is overwritten. A rerun takes the same number and sees the loads
before it only, so it leaves the same tables. Loads that have been folded into the stores (all but
the newest few) are final: running them again is refused before anything is written.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators import lookup, marts, quality, watch
from txnguard.operators.scoring import rule_score
from txnguard.operators.staging import (first_of_each, split_unfit, stg_scored, to_lookup,
                                         to_warehouse)
from txnguard.params import FIXTURE_PARAMS, MartParams, RuleParams
from txnguard.plans import group_store, sinks
from txnguard.plans.day_store import LoadLog
from txnguard.plans.group_store import GroupStore
from txnguard.plans.history_store import HistoryStore
from txnguard.plans.id_index import IdIndex
from txnguard.plans.published import Published
from txnguard.sources import ingest

TABLES = ("landed", "accepted", "scored", "warehouse_unfit", "dead_letters", "scored_transactions",
          "transactions", "fraud_alerts", "fct_fraud_daily", "fct_fraud_by_category",
          "dim_fraud_customers", "customer_stats", "quality_report", "freshness_report")
# published tables with their partition column and sort columns
PUBLISHED = {"fct_fraud_daily": ("txn_date", ()), "fct_fraud_by_category": (None, ("fraud_rate_pct",)),
             "dim_fraud_customers": ("bucket", ("customer_id",)),
             "customer_stats": ("bucket", ("customer_id",)),
             "quality_report": (None, ()), "freshness_report": (None, ())}


@dataclass
class BatchJob:
    spark: SparkSession
    out_root: str
    rules: RuleParams = FIXTURE_PARAMS
    mart: MartParams = field(default_factory=MartParams)
    run_id: str = "0"

    fold_every: int = 8          # loads between two folds of the stores
    keep: int = 2                # newest loads that stay unfolded and can be run again
    buckets: int = 32            # of the customer and category stores

    def path(self, name: str) -> str:
        return os.path.join(self.out_root, name)

    def _published(self, name: str) -> Published:
        return Published(self.spark, self.path(name), *PUBLISHED[name])

    def read(self, name: str) -> DataFrame:
        """A table of the job, as its last complete load left it."""
        if name in PUBLISHED:
            return self._published(name).read().drop("bucket")
        return self.spark.read.parquet(self.path(name))

    def _groups(self, name: str, group: str, measures: dict, distinct: tuple) -> GroupStore:
        return GroupStore(self.spark, self.path(f"_groups/{name}"), group, measures, distinct,
                          self.buckets, self.fold_every, self.keep)

    def stores(self) -> dict:
        """Every store that loads are folded into."""
        return {
            "ids": IdIndex(self.spark, self.path("_ids"), fold_every=self.fold_every,
                           keep=self.keep),
            "history": HistoryStore(self.spark, self.path("_history"), self.rules,
                                    self.fold_every, self.keep),
            "customers": self._groups("customers", "customer_id", group_store.CUSTOMERS,
                                      ("country", "category", "merchant")),
            "categories": self._groups("categories", "category", group_store.CATEGORIES,
                                       ("customer_id",)),
            "stats": self._groups("stats", "customer_id", group_store.STATS,
                                  ("country", "device_id")),
        }

    def customer_sets(self, stats: DataFrame) -> DataFrame:
        """K7 with its sets of countries and devices, for the customers of `stats`."""
        return group_store.with_sets(stats, self.stores()["stats"].pairs())

    def _write_load(self, df: DataFrame, name: str, load: int) -> DataFrame:
        """Write this load's part of a table; returns it."""
        part = os.path.join(self.path(name), f"load={load}")
        df.write.mode("overwrite").parquet(part)
        return self.spark.read.schema(df.schema).parquet(part)

    def run(self, raw: DataFrame) -> dict[str, str]:
        load = LoadLog(self.spark, self.out_root).claim(self.run_id)      # refuses unusable ids
        stores = self.stores()
        if any(x.store.is_final(load) for x in stores.values()):
            raise ValueError(f"load {self.run_id!r} is folded into later loads and final")
        ids, history = stores["ids"], stores["history"]

        # the messages are parsed once
        tagged = ingest.decode(raw).withColumn("dlq_reason", ingest.dlq_reason())
        landed = self._write_load(tagged, "landed", load)
        good, dead = ingest.split_dead_letters(landed.drop("dlq_reason"))

        # K8: dead letters of this load
        dead.write.mode("overwrite").parquet(os.path.join(self.path("dead_letters"),
                                                          f"run={load}"))

        # T10, K4: one row per transaction, before history
        once = first_of_each(good, ["transaction_id"], ["event_time", "customer_id"])
        rows = self._write_load(ids.new_rows(once, load), "accepted", load)

        # K4: scores, once, into the warehouse, seeded with the history of earlier loads
        scored = self._write_load(
            rule_score(rows, self.rules, stamp=True, past=history.past(rows, load)).drop(
                "country_first_seen", "triggered_rules"), "scored", load)
        fit, unfit = split_unfit(scored)
        newest = watch.Newest("loaded_at")
        sinks.append_warehouse(to_warehouse(fit), self.path("scored_transactions"),
                               load_id=load, dedup=False, watch=newest)
        self._write_load(unfit, "warehouse_unfit", load)
        ids.add(rows, load)
        history.add(rows, load)

        # models: the days and the groups that the load touches
        wh = self.spark.read.parquet(self.path("scored_transactions"))
        own = stg_scored(wh.filter(F.col(sinks.LOAD_COL).cast("string") == str(load)))
        sinks.register_view(stg_scored(wh), "stg_scored_transactions")                # M1
        days = [r[0] for r in own.select("txn_date").distinct().collect()]   # bounded by days
        self._published("fct_fraud_daily").publish(
            marts.fct_daily(stg_scored(wh.filter(F.col("txn_date").isin(days)))), days,
            quality.MART_CHECKS["fct_fraud_daily"])                                       # M3
        stores["categories"].add(own, load)
        stores["customers"].add(own, load)
        self._published("fct_fraud_by_category").publish(
            group_store.category_rows(stores["categories"].groups()),
            checks=quality.MART_CHECKS["fct_fraud_by_category"])                          # M2
        self._refresh("dim_fraud_customers", stores["customers"], group_store.customer_rows, load)

        # K5, K6: lookup tables, one version per load, this load's rows only
        lk = to_lookup(scored)
        sinks.append_version(lk.withColumn("event_date", F.to_date("event_time")),
                             self.path("transactions"), "event_date", load,
                             sort_cols=lookup.LOOKUP_KEY)
        sinks.append_version(lookup.alerts_rows(lk), self.path("fraud_alerts"), "alert_date",
                             load, sort_cols=lookup.ALERT_KEY)

        # K7: counters and new (customer, country) and (customer, device) pairs
        stores["stats"].add(scored, load)
        self._refresh("customer_stats", stores["stats"], group_store.stats_rows, load)

        # Q1-Q5, counted while the models were written
        self._published("quality_report").publish(watch.report(self.spark, {
            name: (checks, self._published(name).violations(name, checks))
            for name, checks in quality.MART_CHECKS.items()}))
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        fresh = self._published("freshness_report")
        earlier = fresh.read() if fresh.exists() else None        # one row
        fresh.publish(quality.freshness(
            newest.frame(self.spark, earlier), "scored_transactions", "loaded_at", now,
            self.mart.freshness_warn_minutes, self.mart.freshness_error_minutes))
        for store in stores.values():
            store.fold_if_due()
        return {t: self.path(t) for t in TABLES}

    def _refresh(self, name: str, store: GroupStore, rows, load: int) -> None:
        """Publish the buckets of groups that the load touches."""
        buckets = store.store.parts_of(load, "partials")
        self._published(name).publish(rows(store.groups(touched_by=load)), buckets,
                                      quality.MART_CHECKS.get(name, ()))


def run_batch(spark: SparkSession, sf_dir: str, out_root: str, run_id: str = "0",
              rules: RuleParams = FIXTURE_PARAMS) -> dict[str, str]:
    """Run the whole pipeline on the raw-message fixture derived from `sf_dir`."""
    return BatchJob(spark, out_root, rules, run_id=run_id).run(
        ingest.load_raw_messages(spark, sf_dir))
