"""Connected components of a graph too large for one machine.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce
and Beyond"): each step is one partial aggregate (smallest neighbour) and one join, so a node with
very many neighbours is pre-aggregated and its join partition can be split by AQE. Each round is
written to the shared folder, and only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.filter("v > u").join(least, "u")
            .select(F.least("u", "m").alias("a"), F.col("v").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    kept = least.select(F.col("m").alias("a"), "b")
    moved = (edges.join(least, "b").filter("a <> m")
             .select(F.col("m").alias("a"), F.col("a").alias("b")))
    return kept.unionByName(moved).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node that `edges` (a, b) names: root is the smallest node of its
    component. Self-links and repeated links are allowed; nulls are not links."""
    e = settle(edges.filter("a is not null and b is not null and a <> b")
               .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
               "edges")
    seen = None
    for _ in range(max_rounds):
        e = settle(_small_star(_large_star(e)), "edges")
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            roots = e.select(F.col("a").alias("root")).distinct()
            return (e.select(F.col("b").alias("node"), F.col("a").alias("root"))
                    .unionByName(roots.select(F.col("root").alias("node"), "root")))
        seen = state
    raise RuntimeError("components did not settle")
