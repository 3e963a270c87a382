"""Merkle manifest of a table: one tree per group, a root over the groups, a proof for every row.

A row's leaf is H (lowercase hex SHA-256) of its fields in order, each `-` if null, else its UTF-8
byte count, `:` and its text. In each group leaves ascend by the order column; while more than one
node remains, every `fanout` consecutive ones (the last run may be shorter) become the H of their
digests. What remains is the group's subroot. The subroots, ordered by group (null first, bytewise),
are reduced to the root in the same way. A proof holds a row's siblings, level by level up to the
root, left to right.

Cogrouped subtree exchange, for trees of any size:

1. Leaves are hashed by SQL functions and written. They are numbered within their group by a range
   partitioning (over group, order, digest and row, so neither a hot group nor equal rows share a
   task) and the counts of the range partitions.
2. Upwards: a superblock of `fanout ** levels` consecutive nodes is reduced to one node in one
   `applyInPandas` group, until each group has one node. A tier is smaller by that factor than the
   one below. The subroots go through the same steps.
3. Downwards: the nodes of a tier and the outer nodes that each of its superblocks needs (siblings
   above it, one row per superblock) are cogrouped by superblock. One function finishes the local
   reduction, joins each node's own siblings to the outer ones, and on the lowest tier folds the
   leaf to the root.

No task holds more than one superblock and one path; the driver sees one number per tier.

Null order values come first. Rows that repeat an order value are ordered by digest, so equal rows
are interchangeable. Empty tables give no rows. Fields of any length go through SHA-256 as a stream
of bytes; only digests are shuffled. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import pick, settle

NODE = "grp string, pos long, n long, digest string"
PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(fields: list[Column]) -> Column:
    """H of fields, each marked by its byte count."""
    def told(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[told(c) for c in fields]), 256)


def _group_key(c: Column) -> Column:
    """Text that sorts as the group does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def numbered(nodes: DataFrame, name: str) -> DataFrame:
    """`nodes` (grp, ord, digest and more) with pos, the place in the group from 0, and n, the
    group's size."""
    spark = nodes.sparkSession
    by = ["grp", "ord", "digest", "_row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = settle(nodes.withColumn("_row", F.monotonically_increasing_id()), f"{name}-nodes")
    # the id counts rows in sorted order within each range partition
    rows = settle(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_row")
                  .withColumn("_at", F.monotonically_increasing_id())
                  .withColumn("_part", F.shiftright("_at", 33)), f"{name}-sorted")
    # one row per group and range partition that holds some of it
    runs = rows.groupBy("grp", "_part").agg(F.min("_at").alias("_first"),
                                            F.count(F.lit(1)).alias("_size"))
    order = Window.partitionBy("grp").orderBy("_part")
    runs = runs.select(
        "grp", "_part", "_first",
        F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_before"),
        F.sum("_size").over(Window.partitionBy("grp")).alias("n"))
    # a sort-merge join: neither side is sent to all tasks, however small it looks
    return (rows.join(runs.hint("merge"), ["grp", "_part"])
            .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_first", "_before"))


class Subtree:
    """The levels of one superblock, from its nodes in order up to one node: `levels` of them where
    it is one of several of its group, else as many as it takes."""

    def __init__(self, digests: list[str], fanout: int, levels: int | None):
        self.fanout, self.levels = fanout, [digests]
        while len(self.levels[-1]) > 1 if levels is None else len(self.levels) <= levels:
            below = self.levels[-1]
            self.levels.append([_h("".join(below[i:i + fanout]))
                                for i in range(0, len(below), fanout)])
        self.top = self.levels[-1][0]

    def paths(self):
        """(lefts, rights) of every node: its siblings' digests on either side, for each level."""
        above = [((), ())]
        for level in reversed(self.levels[:-1]):
            out = []
            for start in range(0, len(level), self.fanout):
                run = level[start:start + self.fanout]
                lefts, rights = above[start // self.fanout]
                for i in range(len(run)):
                    out.append((("".join(run[:i]), *lefts), ("".join(run[i + 1:]), *rights)))
            above = out
        return above


def fold(digest: str, lefts, rights) -> str:
    """The root that a leaf and its siblings give."""
    for a, b in zip(lefts, rights):
        digest = _h(f"{a}{digest}{b}")
    return digest


def _subtree(pdf: pd.DataFrame, fanout: int, levels: int) -> Subtree:
    several = pdf["n"].iloc[0] > fanout ** levels
    return Subtree(pdf["digest"].tolist(), fanout, levels if several else None)


def _tiers(nodes: DataFrame, fanout: int, levels: int, name: str) -> list[DataFrame]:
    """`nodes` (grp, pos, n, digest), then its superblocks as nodes, up to one node per group."""
    width = fanout ** levels
    block = F.floor(F.col("pos") / width).cast("long")

    def reduce(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        top = _subtree(pdf, fanout, levels).top
        return pd.DataFrame({"grp": [key[0]], "pos": [key[1]],
                             "n": [-(-int(pdf["n"].iloc[0]) // width)], "digest": [top]})

    tiers = [nodes]
    while True:
        blocks = settle(tiers[-1].select("grp", block.alias("blk"), "pos", "n", "digest")
                        .groupBy("grp", "blk").applyInPandas(reduce, NODE), f"{name}-tier")
        tiers.append(blocks)
        if blocks.filter("pos > 0").isEmpty():
            return tiers


def _joined(tier: DataFrame, outer: DataFrame, fanout: int, levels: int, emit, schema: str,
            carry: list[str]) -> DataFrame:
    """Cogroups a tier's nodes with the path of each of its superblocks. `emit` gets the sorted
    nodes, their subtree's paths and the superblock's row."""
    width = fanout ** levels
    block = F.floor(F.col("pos") / width).cast("long").alias("blk")

    def run(key, pdf: pd.DataFrame, outside: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        return emit(pdf, _subtree(pdf, fanout, levels).paths(), outside.iloc[0])

    left = tier.select("grp", block, "pos", "n", "digest", *carry)
    right = outer.select("grp", F.col("pos").alias("blk"), "lefts", "rights", "subroot", "root")
    return left.groupBy("grp", "blk").cogroup(right.groupBy("grp", "blk")).applyInPandas(
        run, schema)


def _with_paths(pdf: pd.DataFrame, paths, outside) -> pd.DataFrame:
    return pd.DataFrame({
        "grp": pdf["grp"], "pos": pdf["pos"],
        "lefts": [[*a, *outside["lefts"]] for a, _ in paths],
        "rights": [[*b, *outside["rights"]] for _, b in paths],
        "subroot": outside["subroot"], "root": outside["root"]})


def _down(tiers: list[DataFrame], outer: DataFrame, fanout: int, levels: int,
          name: str) -> DataFrame:
    """Paths of the nodes of the second tier, from those of the top one."""
    for tier in reversed(tiers[1:-1]):
        outer = settle(_joined(tier, outer, fanout, levels, _with_paths, f"grp string, pos long, "
                               f"{PATH}", []), f"{name}-paths")
    return outer


def _own_path(pdf: pd.DataFrame, paths, outside) -> pd.DataFrame:
    out = _with_paths(pdf, paths, outside)
    out["subroot"] = pdf["digest"].to_numpy()
    return out


def manifest(rows: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id",
             received: dict[str, Column] | None = None, fanout: int = 8, levels: int = 4,
             with_proof: bool = False) -> DataFrame:
    """Per row: the order column, pos (place in its group), leaf, subroot, root, proof_sha256 (H of
    all sibling digests), folded_root and verified (equals root).

    `received` replaces fields by expressions over `fields` columns, for rows as they arrived
    elsewhere: `folded_root` is recomputed from the leaf of the received row and the siblings of
    the original. `with_proof` adds lefts and rights, the siblings per level on either side."""
    wanted = list(dict.fromkeys([*fields, group, order]))
    t = pick(rows, *wanted)
    original = leaf_of([F.col(c) for c in fields])
    seen = {c: (received or {}).get(c, F.col(c)) for c in fields}
    arrived = leaf_of(list(seen.values())) if received else original
    leaves = t.select(_group_key(F.col(group)).alias("grp"), F.col(order).alias("ord"),
                      F.col(order).cast("string").alias("shown"), original.alias("digest"),
                      arrived.alias("arrived"))
    proved = _prove(leaves, fanout, levels, with_proof)
    value = F.col("shown").cast(t.schema[order].dataType)
    return proved.select(value.alias(order), *[c for c in proved.columns if c != "shown"])


def _prove(leaves: DataFrame, fanout: int, levels: int, with_proof: bool) -> DataFrame:
    low = numbered(leaves, "merkle")
    tiers = _tiers(low, fanout, levels, "merkle")
    # the subroots as leaves of one more tree
    subroots = tiers[-1].select(F.lit("").alias("grp"), F.col("grp").alias("ord"), "digest")
    over = _tiers(numbered(subroots, "merkle-groups"), fanout, levels, "merkle-groups")
    none = F.array().cast("array<string>")
    top = over[-1].select("grp", "pos", none.alias("lefts"), none.alias("rights"),
                          F.lit(None).cast("string").alias("subroot"),
                          F.col("digest").alias("root"))
    above = _down(over, top, fanout, levels, "merkle-groups")
    keyed = over[0].select(F.col("grp"), "pos", "n", "digest", "ord")

    def group_paths(pdf, paths, outside):
        out = _own_path(pdf, paths, outside)
        out["grp"], out["pos"] = pdf["ord"].to_numpy(), 0
        return out

    outer = settle(_joined(keyed, above, fanout, levels, group_paths,
                           f"grp string, pos long, {PATH}", ["ord"]), "merkle-subroots")
    outer = _down(tiers, outer, fanout, levels, "merkle")

    def finish(pdf, paths, outside):
        more_left, more_right = list(outside["lefts"]), list(outside["rights"])
        proof, folded, lefts, rights = [], [], [], []
        for arrived, (a, b) in zip(pdf["arrived"], paths):
            a, b = [*a, *more_left], [*b, *more_right]
            proof.append(_h("".join(x for pair in zip(a, b) for x in pair)))
            folded.append(fold(arrived, a, b))
            if with_proof:
                lefts.append(a)
                rights.append(b)
        out = pd.DataFrame({
            "shown": pdf["shown"], "pos": pdf["pos"], "leaf": pdf["digest"],
            "subroot": outside["subroot"], "root": outside["root"], "proof_sha256": proof,
            "folded_root": folded})
        out["verified"] = out["folded_root"] == out["root"]
        if with_proof:
            out["lefts"], out["rights"] = lefts, rights
        return out

    schema = ("shown string, pos long, leaf string, subroot string, root string, "
              "proof_sha256 string, folded_root string, verified boolean")
    if with_proof:
        schema += ", lefts array<string>, rights array<string>"
    return _joined(low, outer, fanout, levels, finish, schema, ["shown", "arrived"])
