"""Table writers: idempotent warehouse append (K4), versioned keyed tables (K5, K6), mart
models (M1-M4).

Plain Parquet has no MERGE, and rewriting the partitions a micro-batch touches would cost a
whole day of I/O every few seconds. So every write touches only partitions that belong to the
load that produces them:

* Warehouse: rows land in (`txn_date`, `load_id`) partitions that only this load overwrites; a
  replayed load rewrites exactly its own files. Keys already stored under the touched dates by
  other loads are skipped with an anti-join that reads only the key column.
* Keyed lookup tables: each load appends a version (`write_version` partition). Readers take
  the last write per key (`read_latest`, merge on read); `compact` folds old versions together.

Writes use dynamic partition overwrite as a write option (the session setting is untouched), so a
retried task or batch leaves the same files, and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.operators.lookup import upsert_last_write, within_retention
from txnguard.operators.staging import first_of_each
from txnguard.params import LOOKUP_RETENTION_DAYS
from txnguard.session import checkpoint_root

LOAD_COL = "load_id"


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of a path in any store that Spark reads."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop(spark, path)
    return fs.exists(hpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)


def _touched(batch: DataFrame, part_col: str) -> list:
    """Distinct partition values of a batch: bounded by the days a batch spans, not its rows."""
    return [r[0] for r in batch.select(part_col).distinct().collect()]


def overwrite_partitions(df: DataFrame, path: str, part_cols, cluster_cols=(),
                         watch=None) -> None:
    """Replace exactly the partitions present in `df`. `watch` (`operators.watch`) observes the
    rows as they are written.

    Rows are range-partitioned on (partitions, cluster columns): a day, or one customer's day,
    that holds a large share of the rows is split over many tasks (the range bounds come from a
    sample), and each file covers a narrow sorted range that Parquet min/max statistics prune
    on. Hash-partitioning on the date alone would send a whole day to one task."""
    cols = [*part_cols, *[c for c in cluster_cols if c not in part_cols]]
    out = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    if watch is not None:
        out = watch.observed(out)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*part_cols).parquet(path))


def _materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


# -- K4 ---------------------------------------------------------------------------------------

def append_warehouse(batch: DataFrame, path: str, load_id: str | int = "0",
                     key: str = "transaction_id", part_col: str = "txn_date",
                     sort_cols=("customer_id", "event_time"), dedup: bool = True,
                     watch=None) -> None:
    """Append scored rows (warehouse shape, staging.to_warehouse) as load `load_id`.

    The table's key is (date, transaction id): keys repeated inside the load keep the row of the
    earliest event time (and smallest customer), and with `dedup` keys stored for the same dates
    by other loads are skipped. An id that comes back on another date is another row here;
    `operators.staging.first_of_each` drops such repeats before scoring. Files are sorted by
    customer and event time inside each date (the layout of the reference's table)."""
    spark = batch.sparkSession
    out = (batch.withColumn(part_col, F.to_date("event_time"))
           .withColumn(LOAD_COL, F.lit(str(load_id))))
    out = first_of_each(out, [part_col, key], ["event_time", "customer_id"])
    if dedup and path_exists(spark, path):
        dates = _touched(batch.select(F.to_date("event_time").alias(part_col)), part_col)
        stored = (spark.read.parquet(path)
                  .filter(F.col(part_col).isin(dates) & (F.col(LOAD_COL) != F.lit(str(load_id))))
                  .select(part_col, key))
        out = out.join(stored, [part_col, key], "left_anti")
    overwrite_partitions(out, path, [part_col, LOAD_COL], sort_cols, watch)


# -- K5, K6 -----------------------------------------------------------------------------------

def append_version(batch: DataFrame, path: str, part_col: str, version: int,
                   version_col: str = "write_version", sort_cols=()) -> None:
    """Write `batch` as one version of a keyed table (replaying a version rewrites it)."""
    out = batch.withColumn(version_col, F.lit(int(version)).cast("long"))
    overwrite_partitions(out, path, [part_col, version_col], sort_cols)


def read_latest(spark: SparkSession, path: str, key, version_col: str = "write_version",
                where=None, as_of: str | None = None,
                retention_days: int = LOOKUP_RETENTION_DAYS, part_col: str = "event_date",
                time_col: str = "event_time") -> DataFrame:
    """The table as of its last writes: per key, the row with the highest version.

    `as_of` (a timestamp text) hides rows older than `retention_days` before it; whole expired day
    partitions are pruned from the scan.
    `where` (a Column) is applied before the merge, so partition filters prune the scan. The
    merge is a keyed aggregate with partial aggregation; keys here include transaction_id, so it
    is not skewed."""
    t = spark.read.parquet(path)
    if as_of is not None:
        t = within_retention(t.filter(F.col(part_col) >= _oldest_day(as_of, retention_days)),
                             as_of, retention_days, time_col)
    if where is not None:
        t = t.filter(where)
    return upsert_last_write(t, key, version_col)


def _oldest_day(as_of: str, retention_days: int):
    """The first day that can hold rows within the retention."""
    return F.lit((datetime.fromisoformat(as_of) - timedelta(days=retention_days)).date())


def expire(spark: SparkSession, path: str, part_col: str, as_of: str,
           retention_days: int = LOOKUP_RETENTION_DAYS) -> list:
    """Drop the day partitions that lie wholly before the retention; returns their days."""
    fs, folder = _hadoop(spark, path)
    if not fs.exists(folder):
        return []
    first = (datetime.fromisoformat(as_of) - timedelta(days=retention_days)).date().isoformat()
    days = sorted(d for d in (st.getPath().getName().partition("=")[2] for st in
                              fs.listStatus(folder)
                              if st.getPath().getName().startswith(f"{part_col}="))
                  if d < first)
    for day in days:
        delete_path(spark, f"{path}/{part_col}={day}")
    return days


def compact(spark: SparkSession, path: str, key, part_col: str, values: list,
            version_col: str = "write_version", sort_cols=(), as_of: str | None = None,
            retention_days: int = LOOKUP_RETENTION_DAYS) -> None:
    """Fold all versions of the given partitions into their latest rows, written once under the
    highest version present, then drop the older version folders. Readers see the same rows
    before and after, and a version that a stream writes meanwhile stays. With `as_of`, day partitions past the retention are dropped first."""
    if as_of is not None:
        gone = set(expire(spark, path, part_col, as_of, retention_days))
        values = [v for v in values if str(v) not in gone]
    if not values:
        return
    # only versions that exist now are folded and dropped: a later one may be written meanwhile
    mark = f"{version_col}="
    listed = {}
    for v in values:
        fs, folder = _hadoop(spark, f"{path}/{part_col}={v}")
        if fs.exists(folder):
            listed[v] = [int(st.getPath().getName()[len(mark):]) for st in fs.listStatus(folder)
                         if st.getPath().getName().startswith(mark)]
    versions = sorted({n for found in listed.values() for n in found})
    if not versions:
        return
    t = spark.read.parquet(path).filter(F.col(part_col).isin(values)
                                        & F.col(version_col).isin(versions))
    latest = _materialize(upsert_last_write(t, key, version_col)
                          .withColumn(version_col, F.lit(versions[-1]).cast("long")))
    overwrite_partitions(latest, path, [part_col, version_col], sort_cols or key)
    for v, found in listed.items():
        for n in found:
            if n != versions[-1]:
                delete_path(spark, f"{path}/{part_col}={v}/{mark}{n}")


# -- M1-M4 ------------------------------------------------------------------------------------

def write_table(df: DataFrame, path: str, sort_cols=(), partition_col: str | None = None) -> None:
    """M2: full rebuild of a table model."""
    out = df.sortWithinPartitions(*sort_cols) if sort_cols else df
    w = out.write.mode("overwrite")
    if partition_col:
        w = w.partitionBy(partition_col)
    w.parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """M1: a view model."""
    df.createOrReplaceTempView(name)
    return df


def incremental_rows(stg: DataFrame, target: DataFrame | None, lookback_days: int = 1,
                     strict: bool = False, date_col: str = "txn_date") -> DataFrame:
    """J1: rows to (re)process for an incremental daily model.

    The bound `max(date)` of the target is a scalar subquery: it runs with the query, not while
    the query is built. An empty target loads everything, and so does a missing one. `strict=True`
    keeps the reference's `date > max(date)`; the default also redoes the last `lookback_days` days
    so the newest day is completed and late rows land."""
    if target is None:
        return stg
    bound = target.agg(F.max(date_col).alias("bound")).scalar()
    day = F.col(date_col)
    later = day > bound if strict else day >= F.date_sub(bound, lookback_days)
    return stg.filter(F.coalesce(later, F.lit(True)))


def refresh_daily_for_dates(warehouse_path: str, mart_path: str, dates: list, build) -> None:
    """Rebuild the daily mart for the given dates from the stored warehouse rows of those dates
    (partition filter on txn_date), replacing exactly those mart partitions. Used after each
    streaming warehouse append; late rows for an older day refresh that day as well."""
    if not dates:
        return
    spark = SparkSession.getActiveSession()
    wh = spark.read.parquet(warehouse_path).filter(F.col("txn_date").isin(dates))
    overwrite_partitions(build(wh), mart_path, ["txn_date"])


def write_incremental_daily(stg: DataFrame, path: str, build, lookback_days: int = 1,
                            strict: bool = False) -> None:
    """M3: rebuild only the dates the incremental filter selects (dynamic partition overwrite
    replaces exactly those dates, which is the `unique_key = txn_date` contract)."""
    spark = stg.sparkSession
    target = spark.read.parquet(path) if path_exists(spark, path) else None
    rows = incremental_rows(stg, target, lookback_days, strict)
    overwrite_partitions(build(rows), path, ["txn_date"])
