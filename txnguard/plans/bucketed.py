"""Bucketed tables (M4): the warehouse laid out by customer, as the reference's distribution key asks.

Rows of a customer lie in one bucket, sorted by the sort columns. Spark knows that from the catalog,
so per-customer aggregates, windows and joins of such tables run without an exchange: the customer
mart (A4), the customer stats (K7) and the newest rows per customer (O4) read their bucket and
nothing else moves (tested on the plans). The price is that a customer is one task, so this layout
is for tables whose largest customer fits a task; the other plans of the library do not need it.

A bucketed table needs a catalog (`saveAsTable`); its files lie at `path` or in the warehouse folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.plans.group_store import CUSTOMERS, customer_rows


def write_bucketed(df: DataFrame, table: str, buckets: int, by: str = "customer_id",
                   sort_cols: tuple[str, ...] = ("customer_id", "event_time"),
                   path: str | None = None) -> DataFrame:
    """Write `df` as the bucketed, sorted table `table` and return it. One file per bucket: rows are
    dealt by the same hash that the buckets use."""
    out = (df.repartition(buckets, by).write.mode("overwrite").format("parquet")
           .bucketBy(buckets, by).sortBy(*sort_cols))
    if path:
        out = out.option("path", path)
    out.saveAsTable(table)
    return df.sparkSession.table(table)


def dim_customers_by_bucket(stg: DataFrame) -> DataFrame:
    """A4 over a table bucketed by customer. Each distinct count is an aggregate of its own, of two
    columns, joined on the customer: several of them in one aggregate would expand the rows, and
    Spark doesn't know the buckets of expanded rows."""
    out = stg.groupBy(F.col("customer_id").alias("grp")).agg(
        *[m.of_rows().cast(m.kind).alias(k) for k, m in CUSTOMERS.items()])
    for c in ("country", "category", "merchant"):
        n = (stg.filter(F.col(c).isNotNull()).groupBy("customer_id", c).agg(F.count(F.lit(1)))
             .groupBy(F.col("customer_id").alias("grp")).agg(F.count(F.lit(1)).alias(f"new_{c}")))
        out = out.join(n, "grp", "left").withColumn(f"new_{c}", F.coalesce(f"new_{c}", F.lit(0)))
    return customer_rows(out.withColumn("bucket", F.lit(0))).drop("bucket")


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan of `df`."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
