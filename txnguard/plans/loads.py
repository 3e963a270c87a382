"""Queries that take the transactions in several loads, through the stores that loads leave behind, or
from a bucketed table.

Each of them gives what one plain query gives, so its SQL is that of the plain query.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators.history import with_history
from txnguard.operators.staging import STAGING_COLUMNS
from txnguard.params import FIXTURE_PARAMS, MartParams
from txnguard.plans import group_store
from txnguard.plans.bucketed import dim_customers_by_bucket, write_bucketed
from txnguard.plans.group_store import GroupStore
from txnguard.plans.history_store import HistoryStore
from txnguard.plans.id_index import IdIndex
from txnguard.plans.pipeline import Pipeline
from txnguard.session import checkpoint_root

MART = MartParams()
MEASURED = ("is_fraud", "amount", "fraud_score", "event_time")     # read by a GroupStore's measures


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_number(time: str = "event_time") -> Column:
    """0, 1 or 2 by the event's date."""
    days = F.date_diff(F.to_date(time), F.lit(MART.loads_from).cast("date"))
    return F.greatest(F.lit(0), F.least(F.lit(2), F.floor(days / MART.load_days))).cast("int")


def history_over_loads(p: Pipeline) -> DataFrame:
    """Three loads of ten days, folded in between. Every third customer's rows come a load late, so
    loads reach behind the base day of the store."""
    root = _scratch(p.spark, "history-loads")
    late = (F.substring("customer_id", -1, 1).cast("int") % 3 == 0).cast("int")
    txns = _written(p.transactions().withColumn("load", load_number() + late), f"{root}/rows")
    store = HistoryStore(p.spark, f"{root}/store", FIXTURE_PARAMS, fold_every=1, keep=1)
    parts = []
    for load in range(1, 5):
        rows = txns.filter(F.col("load") == load - 1).drop("load")
        parts.append(_written(with_history(rows, FIXTURE_PARAMS, past=store.past(rows, load))
                              .select("transaction_id", "recent_count", "small_count",
                                      "prior_count", "avg_amount", "has_history",
                                      "is_new_country"), f"{root}/out-{load}"))
        if load < 4:
            store.add(rows, load)
            store.fold_if_due()
    return reduce(DataFrame.unionByName, parts)


def accepted_over_loads(p: Pipeline) -> DataFrame:
    """(transaction_id, load): each load also brings every third transaction of the load before it
    again; the index accepts a transaction once, in its first load."""
    root = _scratch(p.spark, "id-loads")
    txns = _written(p.transactions().select("transaction_id", "event_time",
                                            load_number().alias("load")), f"{root}/rows")
    again = F.substring("transaction_id", -8, 8).cast("int") % 3 == 0
    index = IdIndex(p.spark, f"{root}/store", fold_every=1, keep=1)
    parts = []
    for load in range(1, 4):
        brought = txns.filter((F.col("load") == load - 1) | ((F.col("load") == load - 2) & again))
        new = _written(index.new_rows(brought.drop("load"), load), f"{root}/out-{load}")
        index.add(new, load)
        index.fold_if_due()
        parts.append(new.select("transaction_id", F.lit(load - 1).cast("long").alias("load")))
    return reduce(DataFrame.unionByName, parts)


def _groups_over_loads(p: Pipeline, group: str, measures: dict, distinct: tuple) -> DataFrame:
    root = _scratch(p.spark, f"{group}-loads")
    # the columns that the store reads; a written table has no later step that prunes the others
    used = [c for c in STAGING_COLUMNS if c in (group, *distinct, *MEASURED)]
    rows = _written(p.staging().withColumn("load", load_number()).select(*used, "load"),
                    f"{root}/rows")
    store = GroupStore(p.spark, f"{root}/store", group, measures, distinct, buckets=4,
                       fold_every=1, keep=1)
    for load in range(1, 4):
        store.add(rows.filter(F.col("load") == load - 1).drop("load"), load)
        store.fold_if_due()
    return store.groups()


def customers_by_bucket(p: Pipeline) -> DataFrame:
    """The customer mart of a table bucketed by customer."""
    name = f"stg_by_customer_{uuid.uuid4().hex}"
    table = write_bucketed(p.staging(), name, 8, path=_scratch(p.spark, name))
    return dim_customers_by_bucket(table)


def categories_over_loads(p: Pipeline) -> DataFrame:
    return group_store.category_rows(_groups_over_loads(
        p, "category", group_store.CATEGORIES, ("customer_id",)))


def customers_over_loads(p: Pipeline) -> DataFrame:
    return group_store.customer_rows(_groups_over_loads(
        p, "customer_id", group_store.CUSTOMERS, ("country", "category", "merchant"))
    ).drop("bucket")
