"""Per-customer history as streaming state (T7), for the rule engine on a stream.

`transformWithStateInPandas` keyed by customer keeps, per customer:

* `recent`: (us, small, units, id) of the events inside the longest rule window, the lateness
  margin and the replay margin; new events are appended and the list is compacted when half of it
  has expired;
* `totals`: running count and amount (exact, in units of 1/10,000), newest event time, first-seen
  time per country, and when the customer was last seen by the clock.

Rows see only events with a strictly earlier `us`, whether those are in state or in the same
micro-batch, so a stream gives the same history as the batch operator (operators/history.py).
That holds for late rows too, as long as they are at most `allowed_lateness_minutes` older than
the customer's newest event: the recent list keeps that margin, and events at or after a late
row's time are taken back out of the running totals. Rows older than that are flagged `is_late`
and scored against the state as it is.

A message that repeats the transaction id of an event in the recent list, or of an earlier row of
the same micro-batch, is a replay: it gives no row and changes no history.

Rows with a dead-letter reason pass through under keys that begin with `DEAD`: they read and change
no state and come out with their text and reason, so that one query writes scores and dead letters.

An idle customer expires as a whole: one timer per customer, set `ttl_days` after the customer was
last seen, clears both states. While a customer stays active nothing expires. A customer who comes
back after that starts with an empty history, so scores then differ from the batch operator, which
keeps everything.
"""

from __future__ import annotations

import json
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from txnguard.params import DEFAULT_COUNTRY, RuleParams

MICROS_PER_MINUTE = 60_000_000

HISTORY_FIELDS = [
    StructField("us", LongType()),
    StructField("recent_count", LongType()),
    StructField("small_count", LongType()),
    StructField("prior_count", LongType()),
    StructField("avg_amount", DoubleType()),
    StructField("has_history", BooleanType()),
    StructField("is_new_country", BooleanType()),
    StructField("known_countries", StringType()),
    StructField("is_late", BooleanType()),
]

# Columns of the input that travel through the state operator.
STREAM_TXN_FIELDS = [
    StructField("transaction_id", StringType()),
    StructField("customer_id", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("merchant", StringType()),
    StructField("category", StringType()),
    StructField("country", StringType()),
    StructField("card_type", StringType()),
    StructField("device_id", StringType()),
    StructField("is_online", BooleanType()),
    StructField("timestamp", StringType()),
    StructField("event_time", TimestampType()),
]

OUTPUT_SCHEMA = StructType(STREAM_TXN_FIELDS + HISTORY_FIELDS)
# with dead letters: their text and reason, NULL for good rows
DEAD_FIELDS = [StructField("value", StringType()), StructField("dlq_reason", StringType())]
FULL_SCHEMA = StructType(STREAM_TXN_FIELDS + HISTORY_FIELDS + DEAD_FIELDS)
DEAD, GOOD = "!", "="
TXN_NAMES = [f.name for f in STREAM_TXN_FIELDS]
# the exact amount, computed by the same expression as in the batch operator
UNITS_PER_ONE = 10_000
UNITS = "amount_units"


class CustomerHistoryProcessor(StatefulProcessor):
    def __init__(self, params: RuleParams, ttl_days: float = 30, lateness_minutes: int = 1,
                 replay_minutes: int = 60, with_dead: bool = False):
        self.p, self.with_dead = params, with_dead
        self.lateness = int(lateness_minutes) * MICROS_PER_MINUTE
        self.ttl_ms = int(ttl_days * 24 * 3600 * 1000)
        self.w_vel = params.velocity_window_minutes * MICROS_PER_MINUTE
        self.w_card = params.card_test_window_minutes * MICROS_PER_MINUTE
        self.keep = max(self.w_vel, self.w_card, int(replay_minutes) * MICROS_PER_MINUTE)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "us long, small int, units long, id string")
        self.totals = handle.getValueState(
            "totals", "n long, units string, max_us long, countries string, seen_ms long")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Clear a customer not seen for `ttl_days`; else wait for the rest of that time."""
        if self.totals.exists():
            due = self.totals.get()[4] + self.ttl_ms
            if due > timerValues.getCurrentProcessingTimeInMs():
                self.handle.registerTimer(due)
            else:
                self.totals.clear()
                self.recent.clear()
        return iter([])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if not self.with_dead:
            yield from self.scored_rows(rows, timerValues)
        elif key[0].startswith(DEAD):
            for pdf in rows:
                none = dict.fromkeys([f.name for f in HISTORY_FIELDS])
                yield pdf[[*TXN_NAMES, *[f.name for f in DEAD_FIELDS]]].assign(**none)[
                    FULL_SCHEMA.fieldNames()]
        else:
            for pdf in self.scored_rows(rows, timerValues):
                yield pdf.assign(value=None, dlq_reason=None)

    def scored_rows(self, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        ts = pd.to_datetime(pdf["event_time"])
        if ts.dt.tz is not None:
            ts = ts.dt.tz_convert("UTC").dt.tz_localize(None)
        pdf["us"] = ts.astype("datetime64[us]").astype("int64")
        pdf = pdf.sort_values(["us", "transaction_id"], kind="mergesort").reset_index(drop=True)

        # -- state as it was before this batch -------------------------------------------------
        rec = list(self.recent.get()) if self.recent.exists() else []
        replayed = pdf["transaction_id"].isin({r[3] for r in rec}) | pdf["transaction_id"].duplicated()
        pdf = pdf[~replayed].reset_index(drop=True)
        if pdf.empty:
            return
        r_us = np.fromiter((r[0] for r in rec), dtype=np.int64, count=len(rec))
        r_small = np.fromiter((r[1] for r in rec), dtype=np.int64, count=len(rec))
        r_units = np.fromiter((r[2] for r in rec), dtype=np.int64, count=len(rec))
        r_id = np.array([r[3] for r in rec], dtype=object)
        # the list is appended to between compactions, so it may be out of order
        r_order = np.argsort(r_us, kind="mergesort")
        r_us, r_small, r_units, r_id = (x[r_order] for x in (r_us, r_small, r_units, r_id))
        now_ms = timerValues.getCurrentProcessingTimeInMs()
        if self.totals.exists():
            n0, units0, max0, seen0, _ = self.totals.get()
            units0, first = int(units0), json.loads(seen0)
        else:
            n0, units0, max0, first = 0, 0, None, {}
            self.handle.registerTimer(now_ms + self.ttl_ms)

        # -- batch rows, vectorised: O(n log n) in the batch plus the recent window ------------
        b_us = pdf["us"].to_numpy(dtype=np.int64)
        amt = pdf["amount"].to_numpy(dtype=float)
        b_small = (amt < float(self.p.card_test_amount_threshold)).astype(np.int64)
        cty = pdf["country"].where(pdf["country"].notna(), DEFAULT_COUNTRY).astype(object)

        all_us = np.concatenate([r_us, b_us])
        all_small = np.concatenate([r_small, b_small])
        order = np.argsort(all_us, kind="mergesort")
        s_us, s_small = all_us[order], all_small[order]
        units = pdf[UNITS].to_numpy(dtype=np.int64)
        s_units = np.concatenate([r_units, units])[order]
        s_id = np.concatenate([r_id, pdf["transaction_id"].to_numpy(dtype=object)])[order]
        cum_small = np.concatenate([[0], np.cumsum(s_small)])
        before = np.searchsorted(s_us, b_us, side="left")            # events strictly earlier
        recent = before - np.searchsorted(s_us, b_us - self.w_vel, side="left")
        small = cum_small[before] - cum_small[np.searchsorted(s_us, b_us - self.w_card, side="left")]

        b_before = np.searchsorted(b_us, b_us, side="left")          # batch rows strictly earlier
        cum_units = np.concatenate([[0], np.cumsum(units)])
        # state events at or after a row's time (ties, or later events for a late row) are not
        # its history: take them back out of the running totals (the recent list is sorted)
        r_from = np.searchsorted(r_us, b_us, side="left")
        r_cum = np.concatenate([[0], np.cumsum(r_units)])
        not_before_n = len(r_us) - r_from
        not_before_units = r_cum[-1] - r_cum[r_from]
        prior_n = n0 - not_before_n + b_before
        # Python integers: a customer's total has no bound
        prior_units = [units0 + int(d) for d in cum_units[b_before] - not_before_units]
        avg = np.array([u / UNITS_PER_ONE / n if n > 0 else 0.0
                        for u, n in zip(prior_units, prior_n.tolist())])

        batch_first = pdf.groupby(cty)["us"].transform("min").to_numpy(dtype=np.int64)
        state_first = cty.map(lambda c: first.get(c, np.iinfo(np.int64).max)).to_numpy(np.int64)
        is_new = (batch_first == b_us) & (state_first >= b_us)
        has_hist = prior_n > 0
        late = (np.zeros(len(pdf), dtype=bool) if max0 is None
                else b_us < max0 - self.lateness)

        # first-seen map after this batch
        merged = dict(first)
        for c, f in pd.Series(b_us).groupby(cty.to_numpy()).min().items():
            if c not in merged or f < merged[c]:
                merged[c] = int(f)
        # reason text only where the geo rule fires (new country with history)
        known = np.full(len(pdf), "", dtype=object)
        for i in np.flatnonzero(is_new & has_hist):
            u = b_us[i]
            known[i] = ", ".join(f"'{c}'" for c in sorted(c for c, f in merged.items() if f < u))

        # -- write state back ------------------------------------------------------------------
        max_us = int(b_us.max()) if max0 is None else max(int(max0), int(b_us.max()))
        # Append this batch's events (O(batch)); rewrite the list only when more than half of it
        # has left the window and lateness margin. Stale events never fall inside a window.
        bound = max_us - self.keep - self.lateness
        keep = s_us >= bound
        if len(s_us) - int(keep.sum()) > len(s_us) // 2:
            self.recent.put(list(zip(s_us[keep].tolist(), s_small[keep].tolist(),
                                     s_units[keep].tolist(), s_id[keep].tolist())))
        else:
            self.recent.appendList(list(zip(b_us.tolist(), b_small.tolist(), units.tolist(),
                                            pdf["transaction_id"].tolist())))
        self.totals.update((int(n0 + len(pdf)), str(units0 + sum(units.tolist())), max_us,
                            json.dumps(merged), int(now_ms)))

        res = pdf[TXN_NAMES].copy()
        res["us"] = b_us
        res["recent_count"] = recent.astype(np.int64)
        res["small_count"] = small.astype(np.int64)
        res["prior_count"] = prior_n.astype(np.int64)
        res["avg_amount"] = avg
        res["has_history"] = has_hist
        res["is_new_country"] = is_new
        res["known_countries"] = known
        res["is_late"] = late
        yield res

    def close(self) -> None:
        pass
