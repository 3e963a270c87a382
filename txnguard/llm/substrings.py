"""Removal of word passages that repeat an earlier document, by window hashes in prefix groups.

A window is `window` consecutive words; a passage repeats when a window of it also starts in a
document with a smaller id. The grouping follows Mansour et al., "ERA: Efficient Serial and Parallel
Suffix Tree Construction" (variable-length prefixes split suffixes into groups that fit in memory),
but no suffix tree is built: a group compares the 64-bit hashes of whole windows.

1. A window has a prefix code: 16 bits of the hash of its first word and first two words, then bits
   of its first four, eight and all words. Counting the leading bits over all documents (at most
   65,536 counters) gives the groups: neighbouring rare prefixes share a group, and a prefix with
   too many windows is split by the bits of its longer prefixes.
2. Documents are dealt into blocks by id. Within a block, the first document of each distinct
   window stands for the block, so a passage that a third of all documents share reaches a group
   at most once a block. Each (block, group) is one packed row of 64-bit hashes.
3. A group sorts its hashes. Every window whose block stands behind a smaller document with the same
   hash is answered with one bit.
4. The answers go back to the blocks. A window is a repeat if a smaller document in the block or
   elsewhere has it; overlapping repeats merge into ranges, and their words go.

Windows are compared by their hash: 64 bits, and equal prefix codes (16 bits and more) besides, so
with 10**13 windows fewer than one false repeat is expected. Words are not compared again.

A null text has no words. A document without id comes after all others. Rows that repeat an id are
one document as far as "smaller" goes, so they do not remove each other's words.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import pick, slices, small_batches, word_hashes

BINS = 1 << 16
LAST = (1 << 63) - 1                              # stands for a missing id: after all others
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
DEPTHS = (1, 2, 4, 8)                             # prefix lengths that give 8 bits each


CHUNK = 1 << 19                                   # bytes of text that are hashed at once


def suffix_paths(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(prefix codes, path hashes) of the runs of `window` words in a sequence of word hashes."""
    n = max(0, len(h) - window + 1)
    path, code, bits = np.zeros(n, np.uint64), np.zeros(n, np.uint64), 64
    if n == 0:
        return code, path
    for depth in range(1, window + 1):
        path *= _M1
        path += h[depth - 1:depth - 1 + n]
        path ^= path >> np.uint64(30)
        path *= _M2
        path ^= path >> np.uint64(29)
        if depth in DEPTHS:
            bits -= 8
            code |= (path >> np.uint64(56)) << np.uint64(bits)
    code |= path >> np.uint64(64 - bits)
    return code, path


def text_paths(texts: list, window: int):
    """(words, prefix codes, path hashes) of texts, one after the other: words per text, and codes
    and paths of its suffixes with at least `window` words. Short texts are computed together."""
    words, codes, paths = [np.empty(0, np.int64)], [], []
    held: list[bytes] = []

    def flush():
        n, h, _ = word_hashes(held)
        code, path = suffix_paths(h, window)
        # runs that would reach into the next text don't count
        left = np.repeat(np.cumsum(n), n) - np.arange(len(h))
        whole = left[:len(path)] >= window
        words.append(n)
        codes.append(code[whole])
        paths.append(path[whole])
        held.clear()

    size = 0
    for t in texts:
        held.append(t or b"")
        size += len(held[-1])
        if size >= CHUNK:
            flush()
            size = 0
    if held:
        flush()
    none = [np.empty(0, np.uint64)]
    return np.concatenate(words), np.concatenate(codes or none), np.concatenate(paths or none)


def _words(text) -> list[bytes]:
    return text.split() if text else []


class Groups:
    """Which group a prefix code belongs to. `counts` are suffixes by the code's leading 16 bits."""

    def __init__(self, counts: np.ndarray, size: int):
        self.splits = np.maximum(1, -(-counts // size)).astype(np.uint64)
        alone = self.splits > 1
        first, group, load = np.zeros(BINS, np.int64), -1, size
        for b in range(BINS):
            if alone[b] or load + counts[b] > size:
                group, load = group + 1, 0
            first[b] = group
            if alone[b]:
                group, load = group + int(self.splits[b]) - 1, size
            else:
                load += counts[b]
        self.first = first

    def of(self, code: np.ndarray) -> np.ndarray:
        b = (code >> np.uint64(48)).astype(np.int64)
        rest = (code >> np.uint64(16)) & np.uint64(0xFFFFFFFF)       # longer prefixes
        return self.first[b] + (rest * self.splits[b] >> np.uint64(32)).astype(np.int64)


def _prefix_counts(texts: DataFrame, window: int) -> tuple[np.ndarray, int]:
    def run(batches):
        counts, size = np.zeros(BINS, np.int64), 0
        for b in slices(batches, 500):
            texts = b["_t"].to_pylist()
            size += sum(len(t) for t in texts if t)
            _, code, _ = text_paths(texts, window)
            counts += np.bincount((code >> np.uint64(48)).astype(np.int64), minlength=BINS)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)),
                                          pa.array(np.append(counts[at], size))],
                                         names=["bin", "n"])

    got = (texts.mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
           .collect())                            # at most BINS + 1 rows
    counts, size = np.zeros(BINS, np.int64), 0
    for r in got:
        if r.bin < 0:
            size = r.n
        else:
            counts[r.bin] = r.n
    return counts, size


class Block:
    """The suffixes of one block of documents, in order of (id, text)."""

    def __init__(self, docs: pd.DataFrame, window: int, groups: Groups):
        rank = docs["_k"].to_numpy(np.int64)
        texts = [t if isinstance(t, bytes) else None for t in docs["_t"]]
        order = sorted(range(len(texts)), key=lambda i: (rank[i], texts[i] or b""))
        self.order, self.rank, self.texts = order, rank[order], [texts[i] for i in order]
        self.words, code, path = text_paths(self.texts, window)
        self.sizes = np.maximum(0, self.words - window + 1)      # suffixes of each document
        _, first, inverse = np.unique(path, return_index=True, return_inverse=True)
        # a stable order: by group, then by first place in the block
        group = groups.of(code[first])
        at = np.lexsort((first, group))
        self.first, self.group, self.path = first[at], group[at], path[first[at]]
        self.place = np.empty(len(at), np.int64)   # of each distinct path in that order
        self.place[at] = np.arange(len(at))
        self.of = self.place[inverse]              # of each suffix
        self.doc = np.repeat(np.arange(len(self.rank)), self.sizes)
        self.least = self.rank[self.doc[self.first]] if len(first) else np.empty(0, np.int64)

    def runs(self):
        """(group, from, to) over the distinct paths."""
        cut = np.flatnonzero(np.diff(self.group)) + 1
        ends = [0, *cut.tolist(), len(self.group)]
        return [(int(self.group[a]), a, b) for a, b in zip(ends, ends[1:]) if a < b]


def _packed_ids(least: np.ndarray) -> bytes:
    """Ascending runs of ids: differences and run lengths, compressed."""
    cut = np.concatenate(([0], np.flatnonzero(np.diff(least)) + 1))
    ids, n = least[cut], np.diff(np.append(cut, len(least)))
    data = np.concatenate((np.diff(ids, prepend=np.int64(0)), n)).astype("<i8")
    return zstandard.compress(data.view(np.uint8).reshape(-1, 8).T.tobytes(), 3)


def _unpacked_ids(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T
    both = np.ascontiguousarray(raw).view("<i8").ravel()
    half = len(both) // 2
    return np.repeat(np.cumsum(both[:half]), both[half:])


def answer(group: pd.DataFrame) -> pd.DataFrame:
    """One group: for each block, a bit for every window whose hash a smaller document has too. Blocks
    without such a window get no row."""
    paths = [np.frombuffer(x, "<u8") for x in group["paths"]]
    ids = np.concatenate([_unpacked_ids(x) for x in group["ids"]])
    path = np.concatenate(paths)
    order = np.argsort(path, kind="stable")
    leaf = path[order]
    node = np.concatenate(([0], np.flatnonzero(leaf[1:] != leaf[:-1]) + 1))
    least = np.repeat(np.minimum.reduceat(ids[order], node), np.diff(np.append(node, len(leaf))))
    bit = np.zeros(len(path), bool)
    bit[order] = least < ids[order]
    out, at = [], 0
    for block, number, p in zip(group["block"], group["grp"], paths):
        part = bit[at:at + len(p)]
        at += len(p)
        if part.any():
            out.append((block, number, len(p), zstandard.compress(np.packbits(part).tobytes())))
    return pd.DataFrame(out, columns=["block", "grp", "n", "bits"])


def _covered(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal word ranges covered by windows at the given ascending starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    lo, hi = starts[np.concatenate(([0], cut))], starts[np.append(cut - 1, len(starts) - 1)]
    return list(zip(lo.tolist(), (hi + window).tolist()))


def remove_repeats(docs: DataFrame, window: int = 13, group_size: int = 1 << 20,
                   block_bytes: int = 8 << 20, text: str = "text", id_col: str = "doc_id",
                   with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, removed (word ranges), kept_sha256, and kept_text (the kept
    words joined by spaces) unless `with_text` is off. doc_id is a whole number."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = pick(docs, id_col, text).toDF("_id", "_t").select(F.col("_id").cast("long"),
                                                             F.col("_t").cast("binary"))
    counts, size = _prefix_counts(rows.select("_t"), window)
    groups = spark.sparkContext.broadcast(Groups(counts, group_size))    # 65,536 entries
    n_blocks = -(-size // block_bytes) or 1
    # one exchange of the documents by block, used by both steps below
    dealt = (rows.withColumn("_k", F.coalesce("_id", F.lit(LAST)))
             .withColumn("block", F.pmod(F.xxhash64("_k"), F.lit(n_blocks)).cast("int"))
             .repartition("block"))

    def ship(pdf: pd.DataFrame) -> pd.DataFrame:
        b = Block(pdf, window, groups.value)
        block = int(pdf["block"].iloc[0])
        return pd.DataFrame([(block, g, b.path[lo:hi].astype("<u8").tobytes(),
                              _packed_ids(b.least[lo:hi])) for g, lo, hi in b.runs()],
                            columns=["block", "grp", "paths", "ids"])

    def settle_block(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["pos", "n_words", "n_removed", "removed", "kept_sha256", "kept_text"]
        if not len(pdf):
            return pd.DataFrame([], columns=["doc_id", *names[1:]])
        b = Block(pdf, window, groups.value)
        elsewhere = np.zeros(len(b.path), bool)
        where = {g: (lo, hi) for g, lo, hi in b.runs()}
        for g, n, bits in zip(answers["grp"], answers["n"], answers["bits"]):
            lo, hi = where[int(g)]
            raw = np.frombuffer(zstandard.decompress(bits), np.uint8)
            elsewhere[lo:hi] = np.unpackbits(raw, count=int(n)).astype(bool)
        repeat = elsewhere[b.of] | (b.least[b.of] < b.rank[b.doc])
        ends = np.cumsum(b.sizes)
        out = []
        for i, t in enumerate(b.texts):
            starts = np.flatnonzero(repeat[ends[i] - b.sizes[i]:ends[i]])
            words, spans = _words(t), _covered(starts, window)
            kept, at = [], 0
            for lo, hi in spans:
                kept += words[at:lo]
                at = hi
            line = b" ".join(kept + words[at:])
            out.append((b.order[i], len(words), sum(hi - lo for lo, hi in spans),
                        [list(s) for s in spans], hashlib.sha256(line).hexdigest(),
                        line.decode("utf-8", "replace") if with_text else None))
        got = pd.DataFrame(out, columns=names).sort_values("pos", kind="stable")
        ids = pdf["_k"].to_numpy(np.int64)[got["pos"].to_numpy()]
        got["doc_id"] = [None if k == LAST else int(k) for k in ids]
        got["doc_id"] = got["doc_id"].astype("Int64")
        return got[["doc_id", *names[1:]]]

    answers = (dealt.groupBy("block").applyInPandas(ship, "block int, grp long, paths binary, "
                                                          "ids binary")
               .groupBy("grp").applyInPandas(answer, "block int, grp long, n long, bits binary"))
    out = (dealt.groupBy("block").cogroup(answers.groupBy("block"))
           .applyInPandas(settle_block, "doc_id long, n_words long, n_removed long, removed "
                                        "array<array<int>>, kept_sha256 string, kept_text string"))
    out = out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    return out if with_text else out.drop("kept_text")
