"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashed words, word pairs and pairs with one word skipped
(A-Z lower-cased, ASCII punctuation dropped), and the words cut to their first `stem` letters, so
that inflected forms learn together. McMahan et al., "Ad Click Prediction: a View from the
Trenches": each coordinate has its own learning rate, and L1 keeps every weight at zero until its
evidence exceeds the penalty, so the model is a short list of (feature, weight).

Fitting uses a bounded sample: the `max_train` labelled rows with the smallest hash of their id,
in `epochs` passes of one stream through one task (memory: two arrays of 2**bits doubles). Scoring
runs over every whole text with the broadcast weights, of which there are at most 2**bits.

A null or empty text has no features and gets the score of the bias; where nothing can be learned
every score is `prior`. Rows without id or label are
scored but never learned from. Several labels of one id count as toxic if any of them is;
several texts of one id are learned from once (the smallest text).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import (WORDS_ONLY, pick, plus, slices, small_batches, tidy,
                                 under_safe_names, word_hashes)


@dataclass(frozen=True)
class ToxicityParams:
    bits: int = 20
    max_train: int = 12_000
    epochs: int = 3
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    stem: int = 4
    prior: float = 0.1            # chance of label 1 before anything is learned
    threshold: float = 0.5


def features(texts: list[bytes | None], p: ToxicityParams):
    """For each text its sorted distinct feature numbers; number 0 is the bias."""
    counts, h, stems = word_hashes([t.translate(WORDS_ONLY) if t else b"" for t in texts], p.stem)
    m1, m2, shift = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 64 - p.bits))
    pairs, skips = (h[:-1] * m1 ^ h[1:]) * m2, (h[:-2] * m2 ^ h[2:]) * m1
    kinds = [(x >> shift).astype(np.int64) for x in (h, stems * m1, pairs, skips)]
    at = 0
    for n in counts.tolist():
        marks = np.concatenate((kinds[0][at:at + n], kinds[1][at:at + n],
                                kinds[2][at:at + n - 1] if n > 1 else kinds[2][:0],
                                kinds[3][at:at + n - 2] if n > 2 else kinds[3][:0]))
        marks[marks == 0] = 1
        yield np.concatenate((np.zeros(1, np.int64), np.unique(marks)))
        at += n


def _chance(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-max(-35.0, min(35.0, x))))


def _log_odds(p: ToxicityParams) -> float:
    return float(np.log(p.prior / (1 - p.prior)))


class Ftrl:
    def __init__(self, p: ToxicityParams):
        self.p, self.z, self.n = p, np.zeros(1 << p.bits), np.zeros(1 << p.bits)
        self.start = _log_odds(p)

    def weights(self, i=slice(None)) -> np.ndarray:
        p, z = self.p, self.z[i]
        w = (np.sign(z) * p.l1 - z) / ((p.beta + np.sqrt(self.n[i])) / p.alpha + p.l2)
        return np.where(np.abs(z) <= p.l1, 0.0, w)

    def learn(self, i: np.ndarray, y: int) -> None:
        w = self.weights(i)
        g = _chance(self.start + w.sum()) - y
        step = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.p.alpha
        self.z[i] += g - step * w
        self.n[i] += g * g


def is_held_out(id_col: str = "doc_id"):
    """Every fifth row by crc32 of its id as text; false where the id is null."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, p: ToxicityParams = ToxicityParams(),
        text: str = "text", id_col: str = "doc_id", label: str = "toxic"):
    """(feature numbers, weights) as arrays, learned from labelled rows that are not held out."""
    spark = docs.sparkSession
    small_batches(spark)
    labels = pick(labels, id_col, label)
    docs = pick(docs, id_col, text)
    known = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull()
                           & ~is_held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_y")))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(p.max_train)   # the sample's bound
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text).cast("binary").alias("_t"))
            .join(F.broadcast(chosen), "_id")
            .groupBy("_id", "_y").agg(F.min("_t").alias("_t")))
    stream = (rows.select("_id", "_y", "_t",
                          F.explode(F.sequence(F.lit(1), F.lit(p.epochs))).alias("_e"))
              .select("_t", "_y", "_id", "_e", F.xxhash64("_id", "_e").alias("_h"))
              .repartition(1).sortWithinPartitions("_e", "_h", "_id").select("_t", "_y"))

    def learn(batches):
        model = Ftrl(p)
        for b in slices(batches, 250):
            for i, y in zip(features(b["_t"].to_pylist(), p), b["_y"].to_pylist()):
                model.learn(i, y)
        w = model.weights()
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], names=["i", "w"])

    got = stream.mapInArrow(tidy(learn), "i long, w double").toPandas()   # at most 2**bits rows
    return got["i"].to_numpy(np.int64), got["w"].to_numpy(float)


def score(docs: DataFrame, model, p: ToxicityParams = ToxicityParams(),
          text: str = "text") -> DataFrame:
    """`docs` with score (0 to 1) and predicted (0 or 1). Columns of those names, in any case, are
    replaced."""
    return under_safe_names(docs, [text], ("score", "predicted"),
                            lambda safe, t: _score(safe, model, p, t))


def _score(docs: DataFrame, model, p: ToxicityParams, text: str) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = docs.columns

    def run(batches):
        w, start = np.zeros(1 << p.bits), _log_odds(p)
        w[shared.value[0]] = shared.value[1]
        for b in slices(batches, 250):
            s = [_chance(start + w[i].sum()) for i in features(b["__llm_text"].to_pylist(), p)]
            yield pa.RecordBatch.from_arrays([b[c] for c in kept] + [pa.array(s, pa.float64())],
                                             names=[*kept, "score"])

    return (docs.select(*kept, F.col(text).cast("binary").alias("__llm_text"))
            .mapInArrow(tidy(run), plus(docs, kept, "score double"))
            .withColumn("predicted", (F.col("score") >= p.threshold).cast("int")))
