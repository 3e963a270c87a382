"""The corpus pipeline: five stages over `documents`, each one operator of `txnguard.llm`.

    toxicity       documents that the classifier predicts toxic go
    simhash_dedup  of each group of near duplicates the document with the smallest id stays
    decontaminate  documents that hold a benchmark passage go
    pii            personal data in the texts becomes pseudonyms, n_chars follows the text
    bpe            token ids, with digests of the ids and of the decoded text

Each stage takes all rows of its predecessor. All but the last return the columns of their input,
extra columns included (n_chars only where it exists). Nulls: a null text is scored like an empty
one, has fingerprint zero, holds no benchmark passage, stays null in `pii` and has no token ids.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm import bpe, decontam, pii, simhash, toxicity
from txnguard.llm.common import settle
from txnguard.llm.queries import PII_KEY, vocabulary_path
from txnguard.sources.tables import read_table

ORACLE_SQL = None          # hashing, learning and token ids are beyond SQL; tested by brute force


def _apart(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the other columns in one struct by their place, where no name can clash."""
    safe = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rest = [F.col(x) for c, x in at.items() if c not in ("doc_id", "text")]
    return safe.select(F.col(at["doc_id"]).alias("doc_id"), F.col(at["text"]).alias("text"),
                       F.struct(F.lit(1).alias("one"), *rest).alias("rest"))


def _together(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"rest._c{i}").alias(c)
                         for i, c in enumerate(columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(_apart(docs), model)
    return _together(scored.filter("predicted = 0"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.contamination(_apart(docs), read_table(spark, sf_dir, "benchmark"), window=10)
    return _together(found.filter("n_hit = 0"), docs.columns)


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = _together(pii.pseudonymise(_apart(docs), PII_KEY), docs.columns)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(kind))
    return out


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # a small memo: all stages share the Python workers' memory
    return bpe.encode_decode(docs, vocabulary_path(), memo=50_000).drop("text")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", hide_private),
    ("bpe", to_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
