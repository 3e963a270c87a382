"""The registered queries of the subpackage: each runs one operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.llm import (bpe, decontam, merkle, packing, pii, simhash, spelling, substrings,
                          token_store, topk, toxicity, urls, warc)
from txnguard.llm.oracle import LOWER, ORACLE_SQL, UPPER  # noqa: F401
from txnguard.sources.tables import read_table

VOCABULARY = "byte_bpe_50k.json"
PII_KEY = "demonstration key"            # a real job passes its own secret
# fixed values: (host, path, verdict)
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"),
             ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), topk.whole_components(F.col("embedding")).alias("v"))
    return topk.top_k(vectors, vectors.filter("id % 50 = 0"), k=5)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archive(read_table(spark, sf_dir, "pages"))
    return warc.read_records(index, with_payload=False).select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page shows the document whose number its path ends with; a page is bad when that
    document is labelled of low quality or toxic."""
    labels = (read_table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("shown"))
              .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int"))
                   .alias("bad")))
    shown = F.regexp_extract(urls.url_path(F.col("url")), r"/(\d{1,18})(?:\.html|/)?$", 1)
    pages = (read_table(spark, sf_dir, "pages")
             .select("page_id", "url", shown.try_cast("long").alias("shown"))
             .join(labels, "shown", "left"))
    return urls.judge(pages, URL_RULES, F.col("bad")).select("page_id", "host", "path", "rule",
                                                             "verdict")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, shingle=3, max_bits=3).select(
        "doc_id", "fingerprint", "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, read_table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY)


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, dictionary = token_store.write_tokens(read_table(spark, sf_dir, "documents"),
                                                 vocabulary_path(), end_id=2)
    return token_store.read_tokens(files, dictionary).select(
        F.col("doc_id").cast("long").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, vocabulary_path(), with_ids=False).select(
        "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.is_held_out().alias("held_out"), "score", "predicted")


def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents"), window=13,
                                     with_text=False).drop("removed")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering: the text of every row with crc32(doc_id) mod 3 = 0 arrives in small letters."""
    text = F.col("text")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    arrived = F.when(chosen, F.translate(text, UPPER, LOWER)).otherwise(text)
    return merkle.manifest(
        read_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
        group="lang", order="doc_id", received={"text": arrived}).drop("pos")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_table(spark, sf_dir, "documents"), vocabulary_path(), end_id=1)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(read_table(spark, sf_dir, "documents"), min_letters=5,
                                 min_count=3, drop_every=97)
    return spelling.variants(words, times=2)


QUERIES = {f.__name__: f for f in (
    op1_topk, op2_warc, op3_urls, op4_simhash, op5_decontamination, op6_pii, op7_token_store,
    op8_bpe, op9_toxicity, op10_substrings, op11_merkle, op12_packing, op13_spelling)}
