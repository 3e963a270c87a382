"""Data-quality checks taken while a table is written (Q1-Q5, `DataFrame.observe`).

The write that makes a table also counts its violations, so a report reads no table again. Metrics
are taken behind the last shuffle, in the tasks that write the files: a sampling job of a range
exchange or a repeated shuffle stage doesn't count twice. Values that occur more than once are told
by their second row under their own value, in a window that uses the partitioning which the group-by
by that value left, before the write's own exchange.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from txnguard.operators.quality import violates

REPORT = "table_name string, check_name string, column_name string, violations long, status string"


@dataclass
class Watch:
    """Checks (kind, column, arguments) of one table, counted by one write. Use an instance once."""
    checks: tuple
    observation: Observation = field(default_factory=Observation)

    def _again(self) -> dict[str, str]:
        return {c: f"_again_{i}" for i, (k, c, *_) in enumerate(self.checks) if k == "unique"}

    def marked(self, df: DataFrame) -> DataFrame:
        """The rows to be written, with the marks that the counts need."""
        for column, mark in self._again().items():
            nth = F.row_number().over(Window.partitionBy(column).orderBy(column))
            df = df.withColumn(mark, F.col(column).isNotNull() & (nth == 2))
        return df

    def observed(self, df: DataFrame) -> DataFrame:
        """The marked rows as they go to the files, counted, without the marks."""
        again = self._again()
        bad = [F.col(again[c]) if k == "unique" else violates(k, c, *args)
               for k, c, *args in self.checks]
        counts = [F.sum(F.when(b, 1).otherwise(0)).alias(f"v{i}") for i, b in enumerate(bad)]
        return df.observe(self.observation, *counts).drop(*again.values())

    def violations(self) -> list[int]:
        """Violations of each check, once the rows have been written."""
        got = self.observation.get
        return [int(got.get(f"v{i}") or 0) for i in range(len(self.checks))]


class Newest:
    """The newest value of a timestamp column among the rows that a write writes."""

    def __init__(self, column: str):
        self.column, self.observation = column, Observation()

    def observed(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, F.max(F.unix_micros(self.column)).alias("us"))

    def frame(self, spark: SparkSession, earlier: DataFrame | None = None) -> DataFrame:
        """One row: the newest value of this write and of `earlier`, the newest of earlier ones."""
        own = self.observation.get.get("us")
        rows = spark.createDataFrame([(own,)], "us long")
        if earlier is not None:
            rows = rows.unionByName(earlier.select(F.unix_micros(
                F.col("newest").cast("timestamp")).alias("us")))
        return rows.agg(F.timestamp_micros(F.max("us")).alias(self.column))


def report(spark: SparkSession, tables: dict[str, tuple[tuple, list[int]]]) -> DataFrame:
    """The rows of a quality report from {table: (checks, violations of each)}."""
    rows = [(table, check[0], check[1], n, "fail" if n else "pass")
            for table, (checks, found) in tables.items() for check, n in zip(checks, found)]
    return spark.createDataFrame(rows, REPORT)
