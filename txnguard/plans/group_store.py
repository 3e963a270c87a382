"""Marts that grow by loads (A3, A4, K7): counters and exact distinct counts per group.

Counts of distinct values do not add up over loads; counts of *new* (group, value) pairs do. A
`GroupStore` keeps, in buckets of a `DayStore`,

* `pairs`: every (group, column, value) once, in the load that brought it first,
* `partials`: per group and load, the algebraic measures of its rows and the number of its new pairs
  per column.

A load reads the stored pairs of the buckets that its own pairs fall into (an anti-join) and adds its
partials. A group's row is the merge of its partials: sums, minima, maxima. Only the partial
buckets that a load touches are read to refresh a mart, and nothing reads transactions again.

Pairs are dealt to buckets by group, column and value, so neither a group with very many values (a
category's customers) nor a customer with many devices makes a large bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.functions.buckets import pct, risk_status, round_half_up
from txnguard.plans.day_store import DayStore, Generation, Table
from txnguard.plans.sinks import delete_path

MONEY, SCORE = "decimal(38,2)", "decimal(38,4)"


@dataclass(frozen=True)
class Measure:
    """A column of the partials: its type, its aggregate over rows and its merge over partials."""

    kind: str
    of_rows: Callable[[], Column]
    merge: Callable[[Column], Column] = F.sum


def _fraud() -> Column:
    return F.when(F.col("is_fraud"), F.lit(1)).otherwise(F.lit(0))


def _if_fraud(c: str) -> Column:
    return F.when(F.col("is_fraud"), F.col(c))


COUNT = Measure("long", lambda: F.count(F.lit(1)))
FRAUDS = Measure("long", lambda: F.sum(_fraud()))

CUSTOMERS = {
    "n": COUNT, "frauds": FRAUDS,
    "amount": Measure(MONEY, lambda: F.sum("amount")),
    "fraud_amount": Measure(MONEY, lambda: F.coalesce(F.sum(_if_fraud("amount")), F.lit(0))),
    "score": Measure(SCORE, lambda: F.sum("fraud_score")),
    "scores": Measure("long", lambda: F.count("fraud_score")),
    "top_score": Measure("double", lambda: F.max("fraud_score").cast("double"), F.max),
    "first_time": Measure("timestamp", lambda: F.min("event_time"), F.min),
    "last_time": Measure("timestamp", lambda: F.max("event_time"), F.max),
}
CATEGORIES = {
    "n": COUNT, "frauds": FRAUDS,
    "amount": Measure(MONEY, lambda: F.sum("amount")),
    "amounts": Measure("long", lambda: F.count("amount")),
    "fraud_amount": Measure(MONEY, lambda: F.coalesce(F.sum(_if_fraud("amount")), F.lit(0))),
    "fraud_amounts": Measure("long", lambda: F.count(_if_fraud("amount"))),
}
STATS = {"n": COUNT, "frauds": FRAUDS,
         "last_time": Measure("timestamp", lambda: F.max("event_time"), F.max)}


class GroupStore:
    def __init__(self, spark: SparkSession, root: str, group: str, measures: dict[str, Measure],
                 distinct: tuple[str, ...], buckets: int = 32, fold_every: int = 8, keep: int = 2):
        self.group, self.measures, self.distinct = group, measures, distinct
        self.buckets = buckets
        self.columns = [*measures, *[f"new_{c}" for c in distinct]]
        kinds = ", ".join([*[f"{k} {m.kind}" for k, m in measures.items()],
                           *[f"new_{c} long" for c in distinct]])
        tables = {
            "partials": Table(f"grp string, {kinds}", lambda df: self._merged(df, "bucket")),
            "pairs": Table("grp string, kind string, value string", lambda df: df),
        }
        self.store = DayStore(spark, root, tables, fold_every, keep, "bucket", "int")

    def _merged(self, partials: DataFrame, *more: str) -> DataFrame:
        out = [self.measures[c].merge(F.col(c)).cast(self.measures[c].kind).alias(c)
               for c in self.measures]
        new = [F.sum(f"new_{c}").alias(f"new_{c}") for c in self.distinct]
        return partials.groupBy("grp", *more).agg(*out, *new)

    def _bucket(self, *columns) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def _touched(self, df: DataFrame) -> set[str]:
        """Numbers of buckets: bounded by the number of buckets."""
        return {str(r.bucket) for r in df.select("bucket").distinct().collect()}

    def _once(self, df: DataFrame, load: int, name: str) -> DataFrame:
        """`df` written beside the loads, for several readers: range partitioning alone runs its
        input twice. `add` deletes it."""
        path = f"{self._work(load)}/{name}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _work(self, load: int) -> str:
        return f"{self.store.root}/_work-{load}"

    def add(self, rows: DataFrame, load: int) -> None:
        """Store what load number `load` adds; a rerun replaces it."""
        grp = F.col(self.group).alias("grp")
        values = F.explode(F.array(*[
            F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value"))
            for c in self.distinct])).alias("p")
        pairs = (rows.select(grp, values).select("grp", "p.*").filter("value is not null")
                 .distinct().withColumn("bucket", self._bucket("grp", "kind", "value")))
        new = pairs = self._once(pairs, load, "pairs")
        gen = self.store.generation()
        loads = self.store.loads(gen, before=load)
        if gen.number or loads:
            known = self.store.stored("pairs", gen, loads, self._touched(pairs))
            same = ((F.col("a.bucket") == F.col("b.bucket"))
                    & F.col("a.grp").eqNullSafe(F.col("b.grp"))
                    & (F.col("a.kind") == F.col("b.kind")) & (F.col("a.value") == F.col("b.value")))
            new = self._once(pairs.alias("a").join(known.alias("b"), same, "left_anti"), load, "new")
        self.store.add(load, "pairs", new, ("grp", "kind", "value"))
        new = self.store.fresh("pairs", [load])          # written: read once more, cheaply
        counts = [F.sum(F.when(F.col("kind") == c, 1).otherwise(0)).alias(f"new_{c}")
                  for c in self.distinct]
        none = [F.lit(None).cast(m.kind).alias(k) for k, m in self.measures.items()]
        measured = rows.groupBy(grp).agg(*[m.of_rows().cast(m.kind).alias(k)
                                           for k, m in self.measures.items()],
                                         *[F.lit(0).alias(f"new_{c}") for c in self.distinct])
        brought = new.groupBy("grp").agg(*counts).select("grp", *none,
                                                         *[f"new_{c}" for c in self.distinct])
        partials = self._once(self._merged(measured.unionByName(brought))
                              .withColumn("bucket", self._bucket("grp")), load, "partials")
        self.store.add(load, "partials", partials, ("grp",))
        delete_path(self.store.spark, self._work(load))

    def groups(self, touched_by: int | None = None) -> DataFrame:
        """The merged partials: of all groups, or of the buckets that a load touches."""
        gen = self.store.generation()
        buckets = None
        if touched_by is not None:
            buckets = set(self.store.parts_of(touched_by, "partials"))
        return self._merged(self.store.stored("partials", gen, self.store.loads(gen), buckets),
                            "bucket")

    def pairs(self) -> DataFrame:
        """(grp, kind, value), each once."""
        gen = self.store.generation()
        return self.store.stored("pairs", gen, self.store.loads(gen)).select("grp", "kind",
                                                                              "value")

    def fold_if_due(self) -> Generation | None:
        due = self.store.due()
        return self.store.fold(due, {"partials": ("grp",), "pairs": ("grp", "kind", "value")}) \
            if due else None


def _money(c: str) -> Column:
    return F.col(c).cast("double")


def _mean(total: str, n: str, digits: int) -> Column:
    return round_half_up(F.col(total).cast("double") / F.nullif(F.col(n), F.lit(0)), digits)


def customer_rows(groups: DataFrame) -> DataFrame:
    """A4 from partials with `CUSTOMERS` measures (and `bucket`)."""
    out = groups.select(
        F.col("grp").alias("customer_id"), F.col("n").alias("total_transactions"),
        F.col("frauds").alias("fraud_count"), _money("amount").alias("total_amount"),
        _money("fraud_amount").alias("fraud_amount"),
        _mean("score", "scores", 4).alias("avg_fraud_score"),
        F.col("top_score").alias("max_fraud_score"), F.col("first_time").alias("first_transaction"),
        F.col("last_time").alias("last_transaction"), F.col("new_country").alias("unique_countries"),
        F.col("new_category").alias("unique_categories"),
        F.col("new_merchant").alias("unique_merchants"), "bucket")
    return out.withColumns({
        "fraud_rate_pct": pct(F.col("fraud_count"), F.col("total_transactions"), 2),
        "risk_status": risk_status(F.col("fraud_count"), F.col("max_fraud_score"),
                                   F.col("avg_fraud_score"))})


def category_rows(groups: DataFrame) -> DataFrame:
    """A3 from partials with `CATEGORIES` measures."""
    return groups.select(
        F.col("grp").alias("category"), F.col("n").alias("total_transactions"),
        F.col("frauds").alias("fraud_count"), pct(F.col("frauds"), F.col("n"), 2)
        .alias("fraud_rate_pct"), _money("amount").alias("total_amount"),
        _money("fraud_amount").alias("fraud_amount"),
        _mean("amount", "amounts", 2).alias("avg_transaction_amount"),
        _mean("fraud_amount", "fraud_amounts", 2).alias("avg_fraud_amount"),
        F.col("new_customer_id").alias("unique_customers"))


def stats_rows(groups: DataFrame) -> DataFrame:
    """K7 counters from partials with `STATS` measures; the sets themselves are pairs."""
    return groups.select(
        F.col("grp").alias("customer_id"), F.col("n").alias("total_transactions"),
        F.col("frauds").alias("total_fraud"), F.col("last_time").alias("last_transaction_time"),
        F.col("new_country").alias("n_countries"), F.col("new_device_id").alias("n_devices"),
        "bucket")


def with_sets(stats: DataFrame, pairs: DataFrame) -> DataFrame:
    """K7 rows in the reference's shape, with sorted arrays of countries and devices, for the
    customers of `stats` (one customer, or those of a report)."""
    def of(kind):
        return F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col("value"))))
    sets = pairs.groupBy(F.col("grp").alias("customer_id")).agg(
        of("country").alias("known_countries"), of("device_id").alias("known_devices"))
    return stats.join(sets, "customer_id", "left").select(
        "customer_id", "total_transactions", "total_fraud", "last_transaction_time",
        F.coalesce("known_countries", F.array().cast("array<string>")).alias("known_countries"),
        F.coalesce("known_devices", F.array().cast("array<string>")).alias("known_devices"))
