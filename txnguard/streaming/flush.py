"""Flush policy of a sink (K9): hand rows on when enough have come or enough time has passed.

Rows wait in the state of their lane (`lanes` keys, dealt by a hash, so no key of the data is hot).
A lane hands on a flush of exactly `max_rows` rows whenever that many wait, and what is left when
`max_wait_ms` of processing time have passed since its oldest row came: one timer per lane, set when
a row enters an empty buffer. The reference's sinks flush at 100 rows or after 30 seconds
(warehouse) and at 50 rows or after one second (lookup).

Every row leaves in exactly one flush; a flush has a lane, a number within the lane and a reason
("rows" or "time"). After a failure the state of the last finished micro-batch is used again, so
flush numbers repeat and a sink that writes by (lane, flush) stays the same.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

FLUSHED = "lane int, flush long, reason string, pos int, row string"
# fixed values: rows and milliseconds
WAREHOUSE_FLUSH = (100, 30_000)
LOOKUP_FLUSH = (50, 1_000)


class FlushBuffer(StatefulProcessor):
    def __init__(self, max_rows: int, max_wait_ms: int):
        self.max_rows, self.max_wait_ms = max_rows, max_wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "row string")
        # rows that wait, flushes so far, when the timer is due (0: none)
        self.told = handle.getValueState("told", "n int, flushes long, due long")

    def _state(self):
        return self.told.get() if self.told.exists() else (0, 0, 0)

    def _frame(self, lane: int, flush: int, reason: str, rows: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"lane": lane, "flush": flush, "reason": reason,
                             "pos": range(len(rows)), "row": rows})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, flushes, due = self._state()
        new = [r for pdf in rows for r in pdf["row"].tolist()]
        if n + len(new) < self.max_rows:
            self.waiting.appendList([(r,) for r in new])       # most calls: append only
            n += len(new)
        else:
            held = [r[0] for r in self.waiting.get()] if n else []
            held += new
            full = len(held) // self.max_rows
            for i in range(full):
                yield self._frame(int(key[0]), flushes + i, "rows",
                                  held[i * self.max_rows:(i + 1) * self.max_rows])
            flushes += full
            rest = held[full * self.max_rows:]
            self.waiting.clear()
            if rest:
                self.waiting.put([(r,) for r in rest])
            n = len(rest)
            if due:                                            # the timer's oldest row is gone
                self.handle.deleteTimer(due)
                due = 0
        if n and not due:
            due = timerValues.getCurrentProcessingTimeInMs() + self.max_wait_ms
            self.handle.registerTimer(due)
        self.told.update((n, flushes, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        n, flushes, due = self._state()
        if n:
            yield self._frame(int(key[0]), flushes, "time", [r[0] for r in self.waiting.get()])
            flushes += 1
        self.waiting.clear()
        self.told.update((0, flushes, 0))

    def close(self) -> None:
        pass


def flushes(stream: DataFrame, max_rows: int, max_wait_ms: int, lanes: int = 16,
            columns: list[str] | None = None) -> DataFrame:
    """Rows of `stream` as JSON text in flushes: lane, flush, reason, pos (in the flush), row."""
    row = F.to_json(F.struct(*(columns or stream.columns)))
    keyed = stream.select(row.alias("row")).withColumn(
        "lane", F.pmod(F.xxhash64("row"), F.lit(lanes)).cast("int"))
    return keyed.groupBy("lane").transformWithStateInPandas(
        FlushBuffer(max_rows, max_wait_ms), FLUSHED, "Append", "ProcessingTime")
