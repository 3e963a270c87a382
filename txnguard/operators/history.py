"""Customer history (H1-H4) as one batch plan for every customer.

Definition: for a row at `us = unix_micros(event_time)`, its history is every row of the same
customer with a strictly earlier `us` (ties do not see each other, so batch and stream agree).

    recent_count      rows in [us - W_velocity, us - 1]                      (H1)
    small_count       rows with amount < card threshold in [us - W_card, us - 1]   (H2)
    avg_amount        mean amount of all earlier rows, 0 when none            (H3)
    has_history       at least one earlier row
    is_new_country    no earlier row has this row's country                   (H4)
    country_first_seen  map country -> first `us`; gives the known set at any time

Plan:

1. Rows are reduced to points: one per (customer, us) with count, amount and small count. This is
   a partial aggregate, so ties and bursts shrink before they move.
2. A point becomes timed changes: +n when it happens and -n when it leaves a rule window (at
   `us + W`). "Rows in [u - W, u - 1]" is then the running sum of changes strictly before `u`, so
   every count and sum is a running sum and no window frame ever moves.
3. Time is cut into fixed segments (an hour by default). Running sums are taken inside (customer,
   segment); what came before a segment is a running sum over the customer's segment totals,
   which are bounded by the time span whatever the number of rows. A customer with a third of all
   rows thus spreads over as many tasks as it has segments, by the same plan as any other.
4. First-seen times per (customer, country) are another partial aggregate; the per-customer map is
   bounded by the number of distinct countries.
5. The history of a point joins back to its rows on (customer, us): wide rows move once.

`past` continues the history of earlier loads (`HistoryStore`): their segment totals, their
changes inside the segments that this load touches, and their first-seen times.

No row is dropped or sampled and nothing runs while the plan is built; the result equals a plain
`partitionBy(customer)` window, which is what the SQL oracle computes. Rows without an event time
get an empty history. Rows without a customer are each other's history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.functions.rules import country_or_default
from txnguard.params import RuleParams

MICROS_PER_MINUTE = 60_000_000
# Amounts are exact to four decimals (no currency has more); the stream uses the same units.
AMOUNT_DECIMAL = "decimal(24,4)"
SUMS = ("dn", "ds", "dv", "dk")       # changes in rows, amount, velocity count, small count


def exact_amount(amount: str | Column = "amount") -> Column:
    c = F.col(amount) if isinstance(amount, str) else amount
    return c.cast(AMOUNT_DECIMAL)


def segment_micros(p: RuleParams) -> int:
    return p.history_segment_minutes * MICROS_PER_MINUTE


def _changes(points: DataFrame, p: RuleParams) -> DataFrame:
    """One row per point and one per window it leaves: who, t, seg, the four sums, home."""
    w_vel = p.velocity_window_minutes * MICROS_PER_MINUTE
    w_card = p.card_test_window_minutes * MICROS_PER_MINUTE
    zero, no_amount = F.lit(0).cast("long"), F.lit(0).cast(AMOUNT_DECIMAL)

    def change(t, dn, ds, dv, dk, home):
        return F.struct(t.alias("t"), dn.alias("dn"), ds.alias("ds"), dv.alias("dv"),
                        dk.alias("dk"), F.lit(home).alias("home"))

    us, n, k = F.col("us"), F.col("n"), F.col("k")
    born = change(us, n, F.col("s"), n, k, True)
    if w_vel == w_card:
        both = change(us + w_vel, zero, no_amount, -n, -k, False)
        moves = F.array(born, both)
    else:
        leaves = change(us + w_vel, zero, no_amount, -n, zero, False)
        small = change(us + w_card, zero, no_amount, zero, -k, False)
        moves = F.when(k > 0, F.array(born, leaves, small)).otherwise(F.array(born, leaves))
    out = points.select("who", F.explode(moves).alias("m")).select("who", "m.*")
    width = F.lit(segment_micros(p))
    return out.withColumn("seg", F.col("t") - F.pmod(F.col("t"), width))


@dataclass
class Past:
    """What earlier loads left behind: segment totals (who, seg and sums), changes (who, t, seg,
    sums) and first-seen times (who, cty, first)."""

    totals: DataFrame
    changes: DataFrame
    firsts: DataFrame


def history_tables(txns: DataFrame, p: RuleParams, customer: str = "customer_id") -> Past:
    """The tables that a later load needs of these rows."""
    rows = txns.select(
        F.col(customer).alias("who"), F.unix_micros("event_time").alias("us"),
        exact_amount().alias("amt"), country_or_default().alias("cty"),
        (F.col("amount") < F.lit(float(p.card_test_amount_threshold))).cast("long").alias("small"),
    ).filter("us is not null")
    points = rows.groupBy("who", "us").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amt").cast(AMOUNT_DECIMAL).alias("s"),
        F.coalesce(F.sum("small"), F.lit(0)).alias("k"))
    changes = _changes(points, p)
    totals = changes.groupBy("who", "seg").agg(
        *[F.sum(c).cast(AMOUNT_DECIMAL if c == "ds" else "long").alias(c) for c in SUMS])
    firsts = rows.groupBy("who", "cty").agg(F.min("us").alias("first"))
    return Past(totals, changes, firsts)


def with_history(txns: DataFrame, p: RuleParams, customer: str = "customer_id",
                 carry: list[str] | None = None, past: Past | None = None) -> DataFrame:
    """Add the history columns to every row of `txns` (needs customer, event_time, amount,
    country). `carry` limits which input columns travel through the shuffle (default: all);
    `past` is the history of earlier loads."""
    carry = list(carry) if carry is not None else list(txns.columns)
    new = history_tables(txns, p, customer)
    totals, changes, firsts = new.totals, new.changes, new.firsts
    if past is not None:
        same = (F.col("x.who").eqNullSafe(F.col("y.who"))) & (F.col("x.seg") == F.col("y.seg"))
        here = totals.select("who", "seg")
        earlier = (past.changes.select("who", "t", *SUMS, F.lit(False).alias("home"), "seg")
                   .alias("x").join(here.alias("y"), same, "left_semi"))
        changes = changes.unionByName(earlier)
        customers = firsts.select("who").distinct()
        both = (past.totals.select("who", "seg", *SUMS).alias("x").join(
            customers.alias("y"), F.col("x.who").eqNullSafe(F.col("y.who")), "left_semi")
            .unionByName(totals))
        totals = both.groupBy("who", "seg").agg(*[F.sum(c).alias(c) for c in SUMS])
        firsts = firsts.unionByName(past.firsts.select("who", "cty", "first")).groupBy(
            "who", "cty").agg(F.min("first").alias("first"))

    # before each segment: a running sum over the customer's segments
    before = Window.partitionBy("who").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    prior = totals.select("who", "seg", *[F.sum(c).over(before).alias(f"p{c}") for c in SUMS])
    # the map of first-seen times rides on the segment table: one row per segment, not per row
    seen = firsts.groupBy("who").agg(
        F.map_from_entries(F.collect_list(F.struct("cty", "first"))).alias("country_first_seen"))
    # and what of it falls into the segment: all that `is_new_country` needs, so that the whole map
    # moves only where it is asked for
    ends = F.col("seg") + F.lit(segment_micros(p))
    prior = (prior.alias("x").join(seen.alias("y"), F.col("x.who").eqNullSafe(F.col("y.who")))
             .select("x.*", "country_first_seen", F.map_filter(
                 "country_first_seen", lambda _, first: (first >= F.col("seg")) & (first < ends))
                 .alias("_firsts_here")))

    # inside each segment: running sums strictly before the point
    inside = (Window.partitionBy("who", "seg").orderBy("t")
              .rangeBetween(Window.unboundedPreceding, -1))
    points = (changes.select("who", "seg", "t", "home",
                             *[F.sum(c).over(inside).alias(f"i{c}") for c in SUMS])
              .filter("home"))
    z = F.lit(0)

    def total(c):
        return F.coalesce(F.col(f"p{c}"), z) + F.coalesce(F.col(f"i{c}"), z)

    known = (points.alias("x").join(
        prior.alias("y"), F.col("x.who").eqNullSafe(F.col("y.who"))
        & (F.col("x.seg") == F.col("y.seg")))
        .select(F.col("x.who").alias("who"), F.col("x.t").alias("t"), total("dv").alias("_recent"),
                total("dk").alias("_small"), total("dn").alias("_n"), total("ds").alias("_s"),
                "country_first_seen", "_firsts_here"))

    rows = txns.select(*carry, F.col(customer).alias("_who"),
                       F.unix_micros("event_time").alias("us"), country_or_default().alias("_cty"))
    joined = rows.join(known, F.col("_who").eqNullSafe(F.col("who")) & (F.col("us") == F.col("t")),
                       "left")
    n = F.coalesce(F.col("_n"), z)
    return joined.select(
        *carry,
        "us",
        F.coalesce("_recent", z).cast("long").alias("recent_count"),
        F.coalesce("_small", z).cast("long").alias("small_count"),
        n.cast("long").alias("prior_count"),
        F.when(n > 0, F.col("_s").cast("double") / n).otherwise(F.lit(0.0)).alias("avg_amount"),
        (n > 0).alias("has_history"),
        F.coalesce(F.try_element_at("_firsts_here", F.col("_cty")) == F.col("us"),
                   F.lit(False)).alias("is_new_country"),
        "country_first_seen",
    )
