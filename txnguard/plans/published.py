"""Published tables (M2, and the marts of M3): readers see the last complete version, always.

A publication writes only the partitions it replaces, below a new generation folder, and then the
generation file, which says for every partition in which generation's folder it lies. Until that file
exists readers go on with the generation before; a job that is killed leaves a folder that nobody
reads and that a later publication removes. The generation before the current one is kept for
readers that have started on it.

    gen=<g>/rows/<part>=<value>        gen=<g>/_meta.json
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnguard.operators import quality
from txnguard.operators.watch import Watch
from txnguard.plans.day_store import DayStore, Table, children, write_small

WHOLE = "part"


def _named(checks: tuple) -> str:
    return json.dumps(checks)


class Published:
    """A published table, partitioned by column `part`; without one it is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, part: str | None = None,
                 sort_cols: tuple[str, ...] = ()):
        self.spark, self.part, self.sort_cols = spark, part, sort_cols
        self.path = path

    def _store(self, fields: StructType) -> DayStore:
        part = self.part or WHOLE
        ddl = StructType([f for f in fields if f.name != part]).toDDL()
        kind = fields[part].dataType.simpleString() if part in fields.names else "int"
        return DayStore(self.spark, self.path, {"rows": Table(ddl, lambda df: df)}, part=part,
                        part_type=kind)

    def _bare(self) -> DayStore:
        return DayStore(self.spark, self.path, {"rows": Table("", lambda df: df)},
                        part=self.part or WHOLE)

    def publish(self, df: DataFrame, touched: list | None = None, checks: tuple = ()) -> None:
        """Replace the partitions `touched` (or all of them) by the rows of `df`. A touched partition
        without rows is dropped.

        The violations of `checks` are counted while the rows are written and kept with the
        generation. Partitions that stay keep their share: none, if the generation before had no
        violations of the same checks. If it had some, which of them were replaced isn't known, and
        `violations` says so by None."""
        rows = df if self.part else df.withColumn(WHOLE, F.lit(0))
        store = self._store(rows.schema)
        old = store.generation()
        number = max([old.number, *[int(n[4:]) for n in children(self.spark, self.path)
                                    if n.startswith("gen=")]]) + 1
        by = [store.part, *self.sort_cols]
        place = store._gen(number, "rows")
        watch = Watch(checks)
        rows_schema = rows.schema
        if checks:
            rows = watch.marked(rows)
        rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
        if checks:
            rows = watch.observed(rows)
        rows.write.partitionBy(store.part).parquet(place)
        held = {} if touched is None else {d: g for d, g in old.places("rows").items()
                                           if d not in {str(x) for x in touched}}
        written = store._parts(place)
        if touched is not None and not set(written) <= {str(x) for x in touched}:
            raise ValueError("rows outside the partitions to replace")
        told = old.extra.get("checks") if old.number else None
        clean = not held or (told is not None and told["of"] == _named(checks)
                             and told["found"] is not None and not any(told["found"]))
        found = watch.violations() if checks and clean else None
        held.update({d: number for d in written})
        write_small(self.spark, store._gen(number, "_meta.json"), json.dumps(
            {"upto": 0, "days": {"rows": held}, "extra": {
                "schema": rows_schema.json(),
                "checks": {"of": _named(checks), "found": found}}}))
        store._vacuum()

    def violations(self, table: str, checks: tuple) -> list[int]:
        """Violations of each check in the current rows: those counted while writing, or, if they
        weren't or can't be told apart, by reading the table."""
        told = self._bare().generation().extra.get("checks")
        if told and told["of"] == _named(checks) and told["found"] is not None:
            return told["found"]
        got = {(r.check_name, r.column_name): r.violations
               for r in quality.checked(self.read(), table, checks).collect()}  # a row per check
        return [got[k, c] for k, c, *_ in checks]

    def exists(self) -> bool:
        return self._bare().generation().number > 0

    def read(self) -> DataFrame:
        """The current rows."""
        gen = self._bare().generation()
        if not gen.number:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        fields = StructType.fromJson(json.loads(gen.extra["schema"]))
        rows = self._store(fields).folded("rows", gen).select(*[f"`{c}`" for c in fields.names])
        return rows if self.part else rows.drop(WHOLE)
