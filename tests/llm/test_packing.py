"""Packing against the library's ids, and BM25 neighbours against a plain computation."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from txnguard.llm import packing
from txnguard.llm.queries import QUERIES, vocabulary_path


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, documents, window=2048):
    """`documents`: (id, ids) of every row. Pieces hold every id once, sequences have no gap."""
    def crc(ids):
        return zlib.crc32(np.array(ids, "<u4").tobytes())
    left = Counter()
    for doc, ids in documents:
        left[doc, len(ids)] += 1
    whole = {(doc, len(ids)): ids for doc, ids in documents}
    pieces = pieces.assign(doc_id=pieces["doc_id"].astype(object).where(
        pieces["doc_id"].notna(), None))
    covered = Counter()
    for r in pieces.itertuples():
        ids = whole[r.doc_id, r.doc_tokens]
        assert r.length > 0 and crc(ids[r.start:r.start + r.length]) == r.ids_crc32
        covered.update((r.doc_id, r.doc_tokens, i) for i in range(r.start, r.start + r.length))
    assert covered == Counter({(*k, i): n for k, n in left.items() for i in range(k[1])})
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum()[:-1].tolist()]
        n = int(g["length"].sum())
        assert n <= window and (n & (n - 1) == 0 or n == window)        # nothing is padded


def test_query(spark, library):
    d = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    got = QUERIES["op12_packing"](spark, SF_SMALL).toPandas()
    check(got, [(i, library(t)) for i, t in zip(d["doc_id"].tolist(), d["text"].tolist())])


@pytest.mark.parametrize("window,shard_docs", [(8, 3), (64, 5), (2048, 4096)])
def test_odd_rows_and_small_shards(spark, library, window, shard_docs):
    rows = [(str(i), f"word{i % 7} some text of row {i} " * (i % 5)) for i in range(40)]
    rows += [("1", None), ("2", ""), ("same", "twin text"), ("same", "twin text"),
             (None, "no id"), ("long", " ".join(f"w{i % 313}" for i in range(9000))),
             ("space", " \n\t")]
    df = spark.createDataFrame(rows, "doc_id string, text string").selectExpr(
        "*", "1 as n", "'x' as TEXT", "'y' as `a.b`", "2 as first", "'r' as rest")
    pieces = packing.pack(df, vocabulary_path(), window=window, shard_docs=shard_docs,
                          with_ids=True)
    check(pieces.drop("ids").toPandas(), [(i, library(t)) for i, t in rows], window)
    flat = packing.sequences(pieces, window, pad_id=9).collect()
    assert sum(r.length for r in flat) == sum(len(library(t)) for _, t in rows)
    assert all(len(r.ids) == r.length for r in flat)
    assert packing.pack(df.limit(0), vocabulary_path(), window=window).count() == 0


def test_neighbours_are_bm25():
    rng = random.Random(2)
    docs = [[rng.randrange(60) for _ in range(rng.randrange(1, 40))] for _ in range(80)]
    df = np.zeros(100)
    for d in docs:
        df[list(set(d))] += 1
    mean = sum(map(len, docs)) / len(docs)
    stats = packing.Collection(len(docs), mean, df)
    n = np.array(list(map(len, docs)))
    terms = [None if i % 9 else np.stack(np.unique(d, return_counts=True)).astype("<u4").tobytes()
             for i, d in enumerate(docs)]             # some documents with more than their rest
    rest = [np.array(d if t is None else d[-1:], "<u2").tobytes() for d, t in zip(docs, terms)]
    index = packing.Shard(rest, terms, n, stats, "<u2", 100, query_terms=100)

    def score(q, d):
        return sum(math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * d.count(t) * 2.2
                   / (d.count(t) + 1.2 * (0.25 + 0.75 * len(d) / mean)) for t in set(q))
    used = {3, 4, 5}
    for u in used:
        index.unused[u] = False
    for q in (0, 9, 17):
        want = sorted(((-score(docs[q], d), i) for i, d in enumerate(docs)
                       if i not in used and set(d) & set(docs[q])))
        for some in (1, 5, 64):
            got = list(index.neighbours(q, some))
            assert sorted(got) == sorted(i for _, i in want)
            by = dict((i, -s) for s, i in want)
            scores = [by[i] for i in got]
            assert all(a > b - 1e-6 for a, b in zip(scores, scores[1:]))


def test_related_documents_meet():
    """Two topics in turn: the windows hold one topic each."""
    docs = [[10 + i % 5, 20, 21, 22] if i % 2 else [40 + i % 5, 50, 51, 52] for i in range(16)]
    df = np.zeros(100)
    for d in docs:
        df[d] += 1
    stats = packing.Collection(16, 4.0, df)
    index = packing.Shard([np.array(d, "<u2").tobytes() for d in docs], [None] * 16,
                          np.full(16, 4), stats, "<u2", 100)
    for pieces in packing.pack_shard(index, [4] * 16, 16):
        assert len({docs[d][1] for d, _, _ in pieces}) == 1


def test_powers_of_two():
    assert packing.powers_of_two(13) == [8, 4, 1] and packing.powers_of_two(0) == []


def test_statistics_are_counted_while_encoding(spark, library):
    """Document frequencies come from what the encoding tasks counted; nothing else is read."""
    texts = [None, "", "the cat and the dog", "the cat", "\n", " ".join(f"w{i % 50}" for i in range(300))]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)],
                               "doc_id string, text string").repartition(9)
    rows, size = packing.encode_all(df, vocabulary_path(), 1, 64, "text", "doc_id", False)
    blind = rows.selectExpr("doc_id", "n", "cast(null as binary) as rest",
                            "cast(null as binary) as terms", "df")
    got = packing.collection(blind, size)
    held, total = Counter(), 0
    for t in texts:
        held.update(set(library(t)))
        total += len(library(t))
    want = np.zeros(size)
    for term, n in held.items():
        want[term] = n
    plain = packing.Collection(len(texts), total / len(texts), want)
    assert got.docs == plain.docs and got.mean_length == plain.mean_length
    assert np.array_equal(got.idf, plain.idf)


def test_leading_terms_are_the_first_of_the_ranking():
    rng = np.random.default_rng(5)
    for terms in (3, 40, 70_000):
        held = rng.integers(1, 6, 300)
        held = np.minimum(held, terms)
        doc = np.repeat(np.arange(300), held)
        term = np.concatenate([np.sort(rng.choice(terms, k, replace=False)) for k in held])
        weight = rng.choice([0.0, 0.5, 1.25, 3.0], len(doc))            # many ties
        ranked, begin = packing._best_first(doc, term, weight), np.cumsum(held) - held
        first, second = packing._two_best(doc, term, weight, held)
        assert np.array_equal(first, ranked[begin])
        assert np.array_equal(second, ranked[begin + (held > 1)])
