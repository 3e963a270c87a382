"""Which transaction ids earlier loads have (K4): Bloom filters first, exact keys only on hits.

An id belongs to the day of its event. Per day the index holds

* `filters`: (word, bits), a Bloom filter of 64-bit words. An id sets `BITS` bits of one word, so
  filters of loads merge by `bit_or` and only words with a bit are stored, at most `WORDS` a day,
* `keys`: (word, transaction_id), sorted by word.

A load's ids are joined to the filters of their days by (day, word). Only ids whose bits are all
set are looked up among the exact keys, and only in the days that have such ids; the exact result
decides, so a false hit never drops a row. Filters and keys are a `DayStore`: the bytes read depend
on the days a load touches and not on the number of loads (tested).

A repeat is the same id with an event time up to `replay_days` days away. An id that comes back with a
time further off is another transaction; the warehouse keeps both under (date, id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.plans.day_store import DayStore, Generation, Table

WORDS = 1 << 24              # words per day: 128 MB when full, at about 100 million ids a day
BITS = 5

TABLES = {
    "filters": Table("word long, bits long", lambda df: _merged(df)),
    "keys": Table("word long, transaction_id string", lambda df: df),
}
SORTED = {"filters": ("word",), "keys": ("word",)}


def _merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy("day", "word").agg(F.expr("bit_or(bits)").alias("bits"))


def _word(key) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(WORDS))


def _bits(key) -> F.Column:
    """`BITS` bits of a 64-bit word, chosen by six bits each of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    out = F.lit(0).cast("long")
    for i in range(BITS):
        at = F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return out


class IdIndex:
    def __init__(self, spark: SparkSession, root: str, replay_days: int = 1, fold_every: int = 8,
                 keep: int = 2):
        self.store = DayStore(spark, root, TABLES, fold_every, keep)
        self.replay_days = replay_days

    def new_rows(self, rows: DataFrame, load: int) -> DataFrame:
        """`rows` (transaction_id, event_time and more; each id once) without those whose id a load
        before number `load` has. Rows without id or time are kept."""
        gen = self.store.generation()
        loads = self.store.loads(gen, before=load)
        if not (gen.number or loads):
            return rows
        span = F.sequence(F.date_sub("d", self.replay_days), F.date_add("d", self.replay_days))
        asked = (rows.select("transaction_id", F.to_date("event_time").alias("d"))
                 .filter("transaction_id is not null and d is not null")
                 .select("transaction_id", F.explode(span).alias("day"),
                         _word(F.col("transaction_id")).alias("word"),
                         _bits(F.col("transaction_id")).alias("need")))
        days = {str(r.day) for r in asked.select("day").distinct().collect()}   # bounded by days
        filters = _merged(self.store.stored("filters", gen, loads, days))
        hits = (asked.join(filters, ["day", "word"])
                .filter(F.col("bits").bitwiseAND(F.col("need")) == F.col("need"))
                .select("day", "word", "transaction_id"))
        hit_days = {str(r.day) for r in hits.select("day").distinct().collect()}
        if not hit_days:
            return rows
        known = (hits.join(self.store.stored("keys", gen, loads, hit_days),
                           ["day", "word", "transaction_id"], "left_semi")
                 .select("transaction_id").distinct())
        return rows.join(known, "transaction_id", "left_anti").select(*rows.columns)

    def add(self, rows: DataFrame, load: int) -> None:
        """Store the ids of load number `load`; a rerun replaces them."""
        keys = (rows.select("transaction_id", F.to_date("event_time").alias("day"))
                .filter("transaction_id is not null and day is not null")
                .withColumn("word", _word(F.col("transaction_id"))))
        self.store.add(load, "keys", keys, SORTED["keys"])
        bits = keys.select("day", "word", _bits(F.col("transaction_id")).alias("bits"))
        self.store.add(load, "filters", _merged(bits), SORTED["filters"])

    def fold_if_due(self) -> Generation | None:
        due = self.store.due()
        return self.store.fold(due, SORTED) if due else None
