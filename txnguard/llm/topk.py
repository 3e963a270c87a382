"""Exact top-k search by inner product, over vectors grouped by length.

After Teflioudi et al., "LEMP: Fast Retrieval of Large Entries in a Matrix Product":

1. Vectors are grouped into norm buckets (a bucket spans a factor `ratio` of length), and a bucket
   is dealt into blocks of about `block` vectors, so vectors of one length never share a task.
2. Each query gets a lower bound of its k-th best score from the `seeds` longest vectors (a bounded
   table, broadcast).
3. A query visits only buckets whose longest vector can still reach that bound. Queries are dealt
   into blocks in the order of the lowest bucket that they visit, so a task sees one block of
   queries and one block of vectors, and a vector goes only to the query blocks that visit its
   bucket: short vectors to few of them or none.
4. There the bound and the two lengths give the smallest cosine that can matter. Small: vectors are
   pruned by length alone. Large (from `coordinate_from`): they are pruned by the feasible interval
   of the query's largest coordinates. What is left is verified by its inner product.
5. A block returns at most k rows a query; a window takes the k best of them.

Components are whole numbers, so products are exact: in doubles while they stay below 2**53, else
in Python integers (scores are cut to the range of a long). Ties go to the smaller id.

Vectors that are null, or hold a null, NaN or infinite component, and rows without id take no part.
Vectors of unequal length are compared over their common leading components. Every row is a
candidate, also rows that repeat an id (equal rows appear as often as they are there), but no row is
a candidate for a query that has its id. Query rows that repeat an id share one list of k results.
An empty vector scores 0 with everything. Empty tables give no rows; vectors of any length are
multiplied whole; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import pick, plus, settle

LONG = (1 << 63) - 1


def whole_components(vector, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null unless all of them are finite."""
    v = F.transform(vector, lambda x: x.cast("double"))
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(fit, F.transform(v, lambda x: F.floor(x * scale).cast("long")))


def _matrix(vectors, width: int) -> np.ndarray:
    """Rows padded with zeros; doubles where every product is exact in them, else objects."""
    big = max((abs(int(x)) for v in vectors if len(v) for x in (np.min(v), np.max(v))), default=0)
    out = np.zeros((len(vectors), width), float if big * big * max(width, 1) < 1 << 53 else object)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v if out.dtype == float else [int(x) for x in v]
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype == float and b.dtype == float:
        return a @ b.T
    return a.astype(object) @ b.astype(object).T


def _lengths(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m.astype(float) ** 2).sum(axis=1))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k and scores.dtype != object:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)


def _coordinate_mask(q: np.ndarray, unit: np.ndarray, cos: np.ndarray | float, focus: int):
    """Unit vectors whose largest-of-the-query coordinates allow a cosine of at least `cos`."""
    keep = np.ones(len(unit), bool)
    rest = math.sqrt(max(0.0, 1 - cos * cos))
    for f in np.argsort(-np.abs(q))[:focus]:
        spread = rest * math.sqrt(max(0.0, 1 - q[f] * q[f]))
        keep &= np.abs(unit[:, f] - q[f] * cos) <= spread + (1 - cos) * abs(q[f]) + 1e-9
    return keep


def search_block(queries: pd.DataFrame, vectors: pd.DataFrame, k: int, coordinate_from: float,
                 focus: int = 4) -> pd.DataFrame:
    """Up to k results a query from one block: query_id, vec_id, score."""
    width = max((len(v) for v in [*queries["v"], *vectors["v"]]), default=0)
    p, q = _matrix(list(vectors["v"]), width), _matrix(list(queries["v"]), width)
    order = np.argsort(-_lengths(p), kind="stable")
    p, ids = p[order], vectors["id"].to_numpy(np.int64)[order]
    p_len, q_len = _lengths(p), _lengths(q)
    unit = np.divide(p.astype(float), p_len[:, None], where=p_len[:, None] > 0,
                     out=np.zeros(p.shape))
    q_ids, theta = queries["id"].to_numpy(np.int64), queries["theta"].to_numpy(float)
    out = []
    for at in range(0, len(q), 256):                  # bounds the score matrix
        part = slice(at, at + 256)
        reach = q_len[part] * (p_len[0] if len(p_len) else 0.0)
        cos = np.divide(theta[part], reach, where=(theta[part] > 0) & (reach > 0),
                        out=np.zeros(len(reach)))
        cos[(theta[part] > 0) & (reach <= 0)] = 2.0
        by_length = np.flatnonzero((cos <= 0) | (cos < coordinate_from))
        scores = _products(q[part][by_length], p) if len(by_length) else None
        place = {int(i): r for r, i in enumerate(by_length)}
        for i in range(len(reach)):
            if cos[i] > 1 + 1e-9:
                continue                              # the whole block is too short
            g = at + i
            n = len(p)
            if theta[g] > 0:                          # lengths are in descending order
                n = int(np.searchsorted(-p_len, -theta[g] / q_len[g] * (1 - 1e-9), side="right"))
            if i in place:
                near, s = np.arange(n), scores[place[i], :n]
            else:
                near = np.flatnonzero(_coordinate_mask(
                    q[g].astype(float) / q_len[g], unit[:n], min(1.0, cos[i] * (1 - 1e-9)), focus))
                s = _products(q[g:g + 1], p[near])[0]
            other = ids[near] != q_ids[g]
            near, s = near[other], s[other]
            top = _best(ids[near], s, k)
            out += [(q_ids[g], ids[near[t]], max(-LONG - 1, min(LONG, int(s[t])))) for t in top]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def _with_bounds(queries: DataFrame, seeds: list, k: int) -> DataFrame:
    """`queries` with theta: the k-th best score among the seeds, or -inf."""
    shared = queries.sparkSession.sparkContext.broadcast(seeds)

    def run(batches):
        ids = np.array([r[0] for r in shared.value], np.int64)
        for b in batches:
            got = b["v"].to_pylist()
            width = max((len(v) for v in [*got, *(r[1] for r in shared.value)]), default=0)
            table = _matrix([r[1] for r in shared.value], width)
            theta = []
            for i, v in zip(b["id"].to_pylist(), got):
                s = _products(_matrix([v], width), table)[0][ids != i]
                theta.append(float(sorted(s, reverse=True)[k - 1]) if len(s) >= k else -math.inf)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(theta, pa.float64())],
                                             names=[*b.schema.names, "theta"])
    return queries.mapInArrow(run, plus(queries, queries.columns, "theta double"))


def _prepared(vectors: DataFrame, queries: DataFrame, k: int, block: int, seeds: int,
              ratio: float):
    """Written tables: vectors (row, id, v, bucket), queries (id, v, theta, lowest and top bucket,
    block qb), and the number of vector blocks of each bucket. No queries: None."""
    def fit(df):
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
        return (pick(df, "id", "v").filter("id is not null and v is not null")
                .select(F.col("id").cast("long").alias("id"), "v").withColumn("len", F.sqrt(square))
                .withColumn("row", F.monotonically_increasing_id()))

    step = math.log(ratio)
    p = settle(fit(vectors).withColumn(
        "bucket", F.when(F.col("len") == 0, -1).otherwise(F.floor(F.log("len") / step))
        .cast("int")), "vectors")
    longest = p.orderBy(F.col("len").desc(), "id").limit(seeds).select("id", "v").collect()
    if not longest:
        return p, None, None
    # one row per length class: at most log(range) / log(ratio) of them
    sizes = (p.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
             .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    top = F.lit(p.agg(F.max("bucket")).first()[0])
    needed = F.floor(F.log(F.col("theta") / F.col("len")) / step) - 1
    lowest = (F.when((F.col("theta") <= 0) | (F.col("len") == 0), F.lit(-1))
              .otherwise(F.greatest(F.lit(-1), F.least(top, needed))).cast("int"))
    q = settle(_with_bounds(fit(queries), [(r.id, list(r.v)) for r in longest], k)
               .select("row", "id", "v", "theta", lowest.alias("lowest"), top.alias("top")),
               "queries")
    # query blocks of consecutive reach: a class of queries covers a stretch of places
    reach = q.groupBy("lowest").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("lowest").rowsBetween(Window.unboundedPreceding, -1)   # bounded
    reach = reach.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))
    q = settle(q.join(reach, "lowest").select(
        "id", "v", "theta", "lowest", "top", F.floor(
            (F.col("at") + F.pmod(F.xxhash64("row"), F.col("n"))) / block).cast("int").alias("qb")),
        "query-blocks")
    return p, q, sizes


def _dealt(p: DataFrame, q: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries and vectors, each with the blocks (bucket, vb, qb) that it goes to. `sizes` has one row
    per length class, so it is broadcast; vectors meet the visits to their block by (bucket, vb), so
    a length that a third of all vectors have is as many keys as it has blocks."""
    sizes = F.broadcast(sizes)
    routed = (q.select("id", "v", "theta", "qb",
                       F.explode(F.sequence("lowest", "top")).alias("bucket"))
              .join(sizes, "bucket")
              .select("bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("vb"),
                      "qb", "id", "v", "theta"))
    visits = (q.groupBy("qb", "top").agg(F.min("lowest").alias("lowest"))
              .select(F.col("qb").alias("qb"),         # told apart from the column of `routed`
                      F.explode(F.sequence("lowest", "top")).alias("bucket"))
              .join(sizes, "bucket")
              .select("bucket", "qb", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
                      .alias("vb")))
    own = p.join(sizes, "bucket").select(
        "bucket", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int").alias("vb"), "id", "v")
    dealt = own.join(visits, ["bucket", "vb"]).select("bucket", "vb", "qb", "id", "v")
    return routed, dealt


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 4096,
          seeds: int = 1024, ratio: float = 1.05, coordinate_from: float = 0.7) -> DataFrame:
    """The k best of `vectors` (id, v) for each of `queries` (id, v): query_id, rank, vec_id,
    score. v is an array of longs; a vector is no candidate for the query that has its id."""
    spark = vectors.sparkSession
    p, q, sizes = _prepared(vectors, queries, k, block, seeds, ratio)
    if q is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    routed, dealt = _dealt(p, q, sizes)
    keys = ("bucket", "vb", "qb")
    found = routed.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
        lambda a, b: search_block(a, b, k, coordinate_from),
        "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
