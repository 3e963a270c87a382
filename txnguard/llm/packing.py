"""Lexical retrieval packing: training sequences of related documents, without padding.

A document's ids (with an end id) are cut into pieces, and each sequence of at most `window` ids
holds pieces of documents that share words.

1. Documents are encoded once and written with their ids. Every full window of a long document is a
   sequence of its own; what is left of a document, less than a window, is packed with others.
2. BM25 statistics cover whole texts and all documents: the number of documents, their mean length
   and, for each term, the number of documents that hold it, counted while documents are encoded.
   Terms are token ids, so the table of document frequencies is as long as the vocabulary and can
   be broadcast.
3. Documents are ordered by their terms of the highest weight (range partitioning by sampled
   bounds), so that related ones are near each other and a hot group is divided. Consecutive ones
   form shards of at most `shard_docs` documents and `shard_ids` ids.
4. Each shard has an inverted index of BM25 weights over its whole documents. The next unused
   document is the seed of a window; its `query_terms` terms of the highest weight retrieve the
   unused documents of the shard, best first, which fill the window greedily. The one that overflows is
   cut, and its rest is the next seed. Where none shares a term, the next unused one follows. The
   last window of a shard, when not full, is cut into sequences of the powers of two that its length
   consists of, so that nothing is padded.

Shards are packed in a stream: a task holds one shard and the ids of one batch. Any number of rows
of one source, copies or common words changes nothing in that.

Null texts are empty: their one id is the end id. Repeated rows are documents of their own. Empty
tables give no rows. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import pick, settle, slices, small_batches, tidy
from txnguard.llm.token_store import Encoder, loaded

K1, B = 1.2, 0.75
PIECES = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def powers_of_two(n: int) -> list[int]:
    """The powers of two that `n` consists of, largest first."""
    return [1 << i for i in reversed(range(n.bit_length())) if n >> i & 1]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encode_all(docs: DataFrame, vocabulary: str, end_id: int, window: int, text: str,
               id_col: str, with_ids: bool) -> tuple[DataFrame, int]:
    """A written table of the documents, and the size of the vocabulary: doc_id, n (ids, the end id
    included), base (sequence id of the first full window), full (check sum of each full window's
    ids), full_ids (those ids, with `with_ids`), rest (the ids behind them) and terms (of documents with full windows, as the rest holds
    all ids of any other: distinct ids and how often they occur).

    A task's last row is no document: its df tells how many of the task's documents hold each term
    (terms and numbers, 64 bits each), and its other columns are null."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())        # one vocabulary file, a few MB
    size = max(Encoder(spec.value).size, end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def run(batches):
        encoder, windows = loaded(spec.value), TaskContext.get().partitionId() << 36
        df = np.zeros(size, np.int64)
        for b in slices(batches, 1500):
            ids_of = encoder.many([t or "" for t in b["t"].to_pylist()])
            n, base, full, full_ids, rest, terms = [], [], [], [], [], []
            for ids in ids_of:
                ids = np.append(ids, np.uint32(end_id)).astype(kind)
                whole = len(ids) // window
                n.append(len(ids))
                base.append(windows)
                windows += whole
                cut = [ids[i * window:(i + 1) * window] for i in range(whole)]
                full.append([_crc(x) for x in cut])
                full_ids.append([x.astype("<u4").tobytes() for x in cut] if with_ids else None)
                rest.append(ids[whole * window:].tobytes())
                terms.append(np.stack(np.unique(ids, return_counts=True)).astype("<u4").tobytes()
                             if whole else None)
            df += np.bincount(_vectors(rest, terms, kind)[1], minlength=size)
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array(n, pa.int64()), pa.array(base, pa.int64()),
                 pa.array(full, pa.list_(pa.int64())), pa.array(full_ids, pa.list_(pa.binary())),
                 pa.array(rest, pa.binary()), pa.array(terms, pa.binary()),
                 pa.nulls(len(n), pa.binary())], names=names)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, k) for k in (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                                      pa.list_(pa.binary()), pa.binary(), pa.binary())]
            + [pa.array([np.stack([at, df[at]]).astype("<i8").tobytes()], pa.binary())],
            names=names)

    names = ["doc_id", "n", "base", "full", "full_ids", "rest", "terms", "df"]
    rows = pick(docs, id_col, text).toDF("id", "t").select(F.col("id").cast("string"), "t")
    return settle(rows.mapInArrow(tidy(run), "doc_id string, n long, base long, full array<long>, "
                                  "full_ids array<binary>, rest binary, terms binary, df binary"),
                  "pack-ids"), size


class Collection:
    """BM25 statistics of all documents."""

    def __init__(self, docs: int, mean_length: float, df: np.ndarray):
        self.docs, self.mean_length = docs, max(mean_length, 1.0)
        self.idf = np.log1p((docs - df + 0.5) / (df + 0.5))

    def weights(self, term: np.ndarray, tf: np.ndarray, length) -> np.ndarray:
        return self.idf[term] * tf * (K1 + 1) / (
            tf + K1 * (1 - B + B * length / self.mean_length))


def _vectors(rest: list, terms: list, kind: str):
    """(document, term, tf) of whole documents, ordered by document and term."""
    alone = [np.frombuffer(r if t is None else b"", kind) for r, t in zip(rest, terms)]
    # one sort of (document, term) numbers, 32 bits wide where both fit into 16
    narrow = kind == "<u2" and len(alone) <= 1 << 16
    wide, bits = (np.uint32, np.uint32(16)) if narrow else (np.uint64, np.uint64(32))
    doc = np.repeat(np.arange(len(alone), dtype=wide), [len(x) for x in alone])
    flat = np.concatenate(alone).astype(wide) if alone else np.empty(0, wide)
    key, tf = np.unique(doc << bits | flat, return_counts=True)
    doc, term = (key >> bits).astype(np.int64), (key & ((wide(1) << bits) - wide(1))).astype(np.int64)
    long = [(i, np.frombuffer(t, "<u4").reshape(2, -1).astype(np.int64))
            for i, t in enumerate(terms) if t is not None]
    if long:
        doc = np.concatenate([doc, *[np.full(x.shape[1], i) for i, x in long]])
        term = np.concatenate([term, *[x[0] for _, x in long]])
        tf = np.concatenate([tf, *[x[1] for _, x in long]])
        order = np.argsort(doc, kind="stable")
        doc, term, tf = doc[order], term[order], tf[order]
    return doc, term, tf


def _best_first(doc: np.ndarray, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Terms of each document by falling weight (as 32-bit floats), ties to the smaller term."""
    falling = 0xFFFFFFFF - weight.astype(np.float32).view(np.uint32).astype(np.uint64)
    if not len(doc) or doc[-1] >= 1 << 16 or term.max() >= 1 << 16:
        return term[np.lexsort((term, falling, doc))]
    key = doc.astype(np.uint64) << np.uint64(48) | falling << np.uint64(16) | term.astype(np.uint64)
    key.sort()
    return (key & np.uint64(0xFFFF)).astype(np.int64)


def _two_best(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, held: np.ndarray):
    """The first two terms of each document in the order of `_best_first` (the first twice, where it
    has one); a document has `held` terms, one at least."""
    if not len(held):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    falling = 0xFFFFFFFF - weight.astype(np.float32).view(np.uint32).astype(np.uint64)
    key = falling << np.uint64(32) | term.astype(np.uint64)
    begin = np.cumsum(held) - held
    first = np.minimum.reduceat(key, begin)
    key[key == np.repeat(first, held)] = np.uint64(0xFFFFFFFFFFFFFFFF)
    second = np.where(held > 1, np.minimum.reduceat(key, begin), first)
    return [(x & np.uint64(0xFFFFFFFF)).astype(np.int64) for x in (first, second)]


def collection(rows: DataFrame, size: int) -> Collection:
    """Statistics of the table that `encode_all` wrote, from what its tasks counted: one number for
    each term that a task has seen. The result is as long as the vocabulary."""
    def run(batches):
        for b in batches:
            for told in b["df"].to_pylist():
                term, df = np.frombuffer(told, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(df)],
                                                 names=["term", "df"])

    df = np.zeros(size)
    for r in (rows.filter("df is not null").select("df")
              .mapInArrow(tidy(run), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):   # one row per token id
        df[r.term] = r.df
    n, mean = rows.agg(F.count("n"), F.avg("n")).first()       # n is null in the rows of df
    return Collection(n, mean or 0.0, df)


def leading_terms(rows: DataFrame, stats, size: int) -> DataFrame:
    """`rows` with first and second, the document's terms of the highest BM25 weight."""
    kind = "<u2" if size <= 1 << 16 else "<u4"

    def run(batches):
        for b in slices(batches, 2000):
            doc, term, tf = _vectors(b["rest"].to_pylist(), b["terms"].to_pylist(), kind)
            n = b["n"].to_numpy()
            weight = stats.value.weights(term, tf, n[doc])
            first, second = _two_best(doc, term, weight, np.bincount(doc, minlength=len(n)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32))],
                names=[*b.schema.names, "first", "second"])

    ddl = "doc_id string, n long, rest binary, terms binary, first int, second int"
    return rows.select("doc_id", "n", "rest", "terms").mapInArrow(tidy(run), ddl)


class Shard:
    """An inverted index of BM25 weights over some documents, and which of them are unused."""

    def __init__(self, rest: list[bytes], terms: list, n: np.ndarray, stats: Collection, kind: str,
                 size: int, query_terms: int = 12):
        doc, term, tf = _vectors(rest, terms, kind)
        weight = stats.weights(term, tf, n[doc])
        # the query of each document: its terms of the highest weight
        held = np.bincount(doc, minlength=len(rest))
        begin = np.cumsum(held) - held
        ranked = _best_first(doc, term, weight)
        self.query = [ranked[a:a + min(k, query_terms)] for a, k in zip(begin, held)]
        # postings by term
        order = np.argsort(term.astype(np.uint16) if size <= 1 << 16 else term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.at = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=size))))
        self.unused = np.ones(len(rest), bool)
        self.score = np.zeros(len(rest))

    def neighbours(self, seed: int, some: int = 64):
        """Unused documents that share a query term of `seed`, best first (ties by place)."""
        self.score[:] = 0
        for t in self.query[seed].tolist():
            a, b = self.at[t], self.at[t + 1]
            self.score[self.doc[a:b]] += self.weight[a:b]     # a document is once in a list
        found = np.flatnonzero((self.score > 0) & self.unused)
        value = self.score[found]
        if len(found) > some:                     # few are asked for: the others are sorted last
            least = np.partition(value, -some)[-some]
            first = value >= least
            yield from found[first][np.argsort(-value[first], kind="stable")].tolist()
            found, value = found[~first], value[~first]
        yield from found[np.argsort(-value, kind="stable")].tolist()


def pack_shard(index: Shard, lengths: list[int], window: int):
    """Sequences as lists of (document, from, to): every id of every document once."""
    after = 0                                     # all documents before it are used
    left = None                                   # (document, from) of a cut one
    while True:
        if left is None:
            while after < len(lengths) and not index.unused[after]:
                after += 1
            if after == len(lengths):
                return
            left = (after, 0)
            index.unused[after] = False
        seed, at = left
        out, room = [(seed, at, lengths[seed])], window - (lengths[seed] - at)
        left, following = None, index.neighbours(seed)
        while room and left is None:
            doc = next(following, None)
            if doc is None:                       # none shares a term
                while after < len(lengths) and not index.unused[after]:
                    after += 1
                if after == len(lengths):
                    break
                doc = after
            index.unused[doc] = False
            take = min(room, lengths[doc])
            out.append((doc, 0, take))
            room -= take
            if take < lengths[doc]:
                left = (doc, take)
        yield from [out] if not room else _apart(out, window - room)


def _apart(pieces: list, total: int):
    """A sequence of `total` ids cut into sequences whose lengths are powers of two."""
    for size in powers_of_two(total):
        out = []
        while size:
            doc, a, b = pieces[0]
            take = min(size, b - a)
            out.append((doc, a, a + take))
            size -= take
            pieces = pieces[1:] if take == b - a else [(doc, a + take, b), *pieces[1:]]
        yield out


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, window: int = 2048,
         shard_docs: int = 4096, shard_ids: int = 2 << 20, query_terms: int = 12,
         with_ids: bool = False, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """A written table with one row per piece: doc_id (text), start (its document's ids before it),
    length, ids_crc32 (of the ids as little-endian unsigned 32-bit integers), doc_tokens,
    sequence_id, offset (place in the sequence) and, with `with_ids`, the ids as such integers.
    `sequences` puts sequences together."""
    spark = docs.sparkSession
    rows, size = encode_all(docs, vocabulary, end_id, window, text, id_col, with_ids)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    stats = spark.sparkContext.broadcast(collection(rows, size))   # as long as the vocabulary
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = (leading_terms(rows.filter(F.octet_length("rest") > 0), stats, size)
            .withColumn("_row", F.monotonically_increasing_id()))
    by = ["first", "second", "_row"]
    near = settle(near, "pack-terms").repartitionByRange(parts, *by).sortWithinPartitions(*by)
    width = np.dtype(kind).itemsize

    def run(batches):
        sequence = 1 << 62 | TaskContext.get().partitionId() << 36
        held: list[tuple] = []
        total = 0

        def packed():
            nonlocal sequence
            doc_id, n, rest, terms = zip(*held)
            n = np.array(n)
            index = Shard(rest, terms, n, stats.value, kind, size, query_terms)
            out = []
            for pieces in pack_shard(index, [len(r) // width for r in rest], window):
                offset = 0
                for doc, a, b in pieces:
                    ids = rest[doc][a * width:b * width]
                    before = int(n[doc]) - len(rest[doc]) // width
                    out.append((doc_id[doc], before + a, b - a, _crc(np.frombuffer(ids, kind)),
                                int(n[doc]), sequence, offset,
                                *([np.frombuffer(ids, kind).astype("<u4").tobytes()]
                                  if with_ids else [])))
                    offset += b - a
                sequence += 1
            held.clear()
            kinds = [pa.string(), *[pa.int64()] * 6, pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

        for b in slices(batches, 1000):
            for row in zip(*[b[c].to_pylist() for c in ("doc_id", "n", "rest", "terms")]):
                size_of = len(row[2]) // width + (len(row[3]) // 8 if row[3] else 0)
                if held and (len(held) == shard_docs or total + size_of > shard_ids):
                    yield packed()
                    total = 0
                held.append(row)
                total += size_of
        if held:
            yield packed()

    names = [f.split()[0] for f in PIECES.split(", ")] + (["ids"] if with_ids else [])
    filled = near.select("doc_id", "n", "rest", "terms").mapInArrow(
        tidy(run), PIECES + (", ids binary" if with_ids else ""))
    whole = rows.filter("size(full) > 0").select(
        "doc_id", "n", "base", "full_ids", F.posexplode("full").alias("k", "ids_crc32"))
    whole = whole.select(
        "doc_id", (F.col("k") * window).cast("long").alias("start"),
        F.lit(window).cast("long").alias("length"), "ids_crc32", F.col("n").alias("doc_tokens"),
        (F.col("base") + F.col("k")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *([F.element_at("full_ids", F.col("k") + 1).alias("ids")] if with_ids else []))
    return settle(whole.unionByName(filled), "pack-pieces")


def sequences(pieces: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """sequence_id, length and ids (padded to `window` unless the length is a power of two) of the
    pieces that `pack(..., with_ids=True)` returns. A group holds one window."""
    def join(key, pdf):
        ids = np.frombuffer(b"".join(pdf.sort_values("offset")["ids"]), "<u4").tolist()
        n = len(ids)
        return pd.DataFrame({"sequence_id": [key[0]], "length": [n],
                             "ids": [ids + [pad_id] * (window - n if n & (n - 1) else 0)]})
    return pieces.groupBy("sequence_id").applyInPandas(
        join, "sequence_id long, length long, ids array<long>")
