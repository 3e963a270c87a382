"""Tables of a job that runs in loads: the log of its loads, and partitioned tables whose cost per
load does not grow with the number of loads.

`LoadLog` gives every run id a number, in the order of first use. A rerun gets its number again.

`DayStore` keeps tables with a partition column (a day, or a number of a bucket) as a base and
deltas:

    load=<n>/<table>/day=<d>           what load n added (rewritten as a whole by a rerun)
    gen=<g>/<table>/day=<d>            folded loads, merged by the table's key
    gen=<g>/_meta.json                 written last: the generation exists when this file does

A generation says which loads it holds and, for each table and day, in which generation's folder
the day lies, so a fold rewrites the days that the folded loads touched and no others. Readers name
the days they need: they list and scan those folders, and the loads that are not folded yet, of
which there are at most `fold_every` plus `keep`. The newest `keep` loads are never folded, so that
they can be run again; older ones are final. One writer at a time; readers may run beside it, as
nothing that the current generation or the one before it names is deleted.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.plans.sinks import _hadoop, delete_path, path_exists

RUN_ID = re.compile(r"[A-Za-z0-9._-]{1,128}")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none where it does not exist."""
    fs, folder = _hadoop(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(folder))


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A new small ASCII file; fails where it exists."""
    fs, target = _hadoop(spark, path)
    out = fs.create(target, False)
    out.writeBytes(text)
    out.close()


def read_small(spark: SparkSession, path: str) -> str:
    fs, source = _hadoop(spark, path)
    stream = fs.open(source)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class LoadLog:
    """Numbers of loads, one empty file `<number>=<run id>` each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, f"{root}/_loads"

    def numbers(self) -> dict[str, int]:
        found = {}
        for name in children(self.spark, self.root):
            n, eq, run_id = name.partition("=")
            if eq:
                found[run_id] = int(n)
        return found

    def claim(self, run_id: str) -> int:
        """The number of `run_id`, a new one for a new id. Ids are text: "01" is not "1"."""
        if not isinstance(run_id, str) or not RUN_ID.fullmatch(run_id) or set(run_id) <= {"."}:
            raise ValueError(f"run id {run_id!r}: use 1 to 128 letters, digits, '.', '_' or '-'")
        known = self.numbers()
        if run_id not in known:
            known[run_id] = max(known.values(), default=0) + 1
            write_small(self.spark, f"{self.root}/{known[run_id]:08d}={run_id}", "")
        return known[run_id]


@dataclass(frozen=True)
class Table:
    """Columns (DDL, without the partition column) and how rows of several loads become one per key."""

    ddl: str
    merge: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Generation:
    number: int = 0
    upto: int = 0                         # the last folded load
    days: dict | None = None              # table -> day -> generation that holds it
    extra: dict | None = None

    def places(self, table: str) -> dict[str, int]:
        return (self.days or {}).get(table, {})


class DayStore:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table],
                 fold_every: int = 8, keep: int = 2, part: str = "day", part_type: str = "date"):
        self.spark, self.root, self.tables = spark, root, tables
        self.fold_every, self.keep = fold_every, keep
        self.part, self.part_type = part, part_type

    # -- reading ------------------------------------------------------------------------------

    def generations(self) -> list[int]:
        """Complete generations, oldest first."""
        numbers = [int(n[4:]) for n in children(self.spark, self.root) if n.startswith("gen=")]
        return [g for g in sorted(numbers) if path_exists(self.spark, self._gen(g, "_meta.json"))]

    def generation(self, number: int | None = None) -> Generation:
        number = number if number is not None else max(self.generations(), default=0)
        if not number:
            return Generation()
        told = json.loads(read_small(self.spark, self._gen(number, "_meta.json")))
        return Generation(number, told["upto"], told["days"], told["extra"])

    def _gen(self, number: int, name: str) -> str:
        return f"{self.root}/gen={number}/{name}"

    def loads(self, gen: Generation, before: int | None = None) -> list[int]:
        """Loads that `gen` does not hold, below number `before`."""
        found = [int(n[5:]) for n in children(self.spark, self.root) if n.startswith("load=")]
        return [n for n in sorted(found) if n > gen.upto and (before is None or n < before)]

    def _schema(self, table: str) -> str:
        return f"{self.tables[table].ddl}, {self.part} {self.part_type}"

    def _read(self, table: str, base: str, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self._schema(table)).option("basePath", base).parquet(*folders)

    def folded(self, table: str, gen: Generation, first: str | None = None,
               last: str | None = None, days=None) -> DataFrame:
        """Folded rows of the given days, or of those from `first` to `last`."""
        return self._union(table, self._folded(table, gen, first, last, days))

    def _folded(self, table: str, gen: Generation, first=None, last=None, days=None) -> list:
        wanted = [(d, g) for d, g in sorted(gen.places(table).items())
                  if (days is None or d in days) and (first is None or d >= first)
                  and (last is None or d <= last)]
        return [self._read(table, self._gen(g, table),
                           [f"{self._gen(g, table)}/{self.part}={d}" for d, x in wanted if x == g])
                for g in sorted({g for _, g in wanted})]

    def _union(self, table: str, parts: list[DataFrame]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self._schema(table))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def fresh(self, table: str, loads: list[int], days=None) -> DataFrame:
        """Rows of the given loads, of all or of the given days."""
        return self._union(table, self._fresh(table, loads, days))

    def stored(self, table: str, gen: Generation, loads: list[int], days=None) -> DataFrame:
        """Folded rows and those of the given loads."""
        return self._union(table, [*self._folded(table, gen, days=days),
                                   *self._fresh(table, loads, days)])

    def _fresh(self, table: str, loads: list[int], days=None) -> list:
        out = []
        for n in loads:
            base = f"{self.root}/load={n}/{table}"
            folders = [f"{base}/{self.part}={d}" for d in self.parts_of(n, table)
                       if days is None or d in days]
            if folders:
                out.append(self._read(table, base, folders))
        return out

    def _parts(self, path: str) -> list[str]:
        mark = f"{self.part}="
        return [n[len(mark):] for n in children(self.spark, path) if n.startswith(mark)]

    def parts_of(self, load: int, table: str) -> list[str]:
        """The days (or buckets) that a load has rows of."""
        return self._parts(f"{self.root}/load={load}/{table}")

    # -- writing ------------------------------------------------------------------------------

    def is_final(self, load: int) -> bool:
        return load <= self.generation().upto

    def add(self, load: int, name: str, rows: DataFrame, sort_cols=()) -> None:
        """The rows of one table that load `load` adds, with their partition column."""
        if self.is_final(load):
            raise ValueError(f"load {load} is folded and final")
        fields = self._schema(name)
        typed = self.spark.createDataFrame([], fields).schema
        out = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed.fields])
        by = [self.part, *sort_cols]
        (out.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite")
         .partitionBy(self.part).parquet(f"{self.root}/load={load}/{name}"))

    def due(self) -> list[int]:
        """Loads to fold now, or none."""
        waiting = self.loads(self.generation())
        return waiting[:-self.keep] if len(waiting) >= self.fold_every + self.keep else []

    def fold(self, loads: list[int], sort_cols: dict[str, tuple],
             extra: Callable[[Generation, int, list[int]], dict] | None = None) -> Generation:
        """Merge the oldest loads into a new generation. `extra` writes more files of the
        generation (it gets the old one, the new number and the loads) and returns what the
        generation file shall say about them."""
        old = self.generation()
        new = max([old.number, *[int(n[4:]) for n in children(self.spark, self.root)
                                 if n.startswith("gen=")]]) + 1
        days = {t: dict(old.places(t)) for t in self.tables}
        for name, table in self.tables.items():
            touched = sorted({d for n in loads for d in self.parts_of(n, name)})
            if not touched:
                continue
            both = self.stored(name, old, loads, touched)
            by = [self.part, *sort_cols.get(name, ())]
            (table.merge(both).repartitionByRange(*by).sortWithinPartitions(*by).write
             .partitionBy(self.part).parquet(self._gen(new, name)))
            days[name].update({d: new for d in touched})
        told = {"upto": max(loads), "days": days,
                "extra": extra(old, new, loads) if extra else {}}
        write_small(self.spark, self._gen(new, "_meta.json"), json.dumps(told))
        self._vacuum()
        return self.generation(new)

    def _vacuum(self) -> None:
        """Delete what neither the current generation nor the one before it names."""
        complete = self.generations()
        for n in children(self.spark, self.root):          # of folds that did not end
            if n.startswith("gen=") and int(n[4:]) not in complete and int(n[4:]) < complete[-1]:
                delete_path(self.spark, f"{self.root}/{n}")
        held = [self.generation(g) for g in complete[-2:]]
        for n in children(self.spark, self.root):
            if n.startswith("load=") and int(n[5:]) <= held[0].upto and len(held) > 1:
                delete_path(self.spark, f"{self.root}/{n}")
        for g in complete[:-2]:
            used = {(t, d) for h in held for t in self.tables
                    for d, x in h.places(t).items() if x == g}
            for t in children(self.spark, f"{self.root}/gen={g}"):
                if t == "_meta.json":
                    continue
                if t not in self.tables:
                    delete_path(self.spark, self._gen(g, t))
                    continue
                for d in self._parts(self._gen(g, t)):
                    if (t, d) not in used:
                        delete_path(self.spark, f"{self._gen(g, t)}/{self.part}={d}")
