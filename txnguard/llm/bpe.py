"""Byte-pair encoding and decoding of whole texts with a vocabulary file.

The file's pre-tokenisation pattern cuts a text into pieces. A piece's bytes form a doubly linked
list of symbols; a priority queue holds every adjacent pair that has a merge, lowest rank (then
leftmost) first. A popped entry is stale, and skipped, when one of its two symbols has since been
merged. Each merge adds the new pairs on either side. Decoding concatenates the vocabulary strings
of the ids and turns the byte alphabet back into bytes; bytes that aren't UTF-8 become U+FFFD.

Words repeat, so a Python worker remembers the ids of up to `memo` words, and keeps
them between tasks. Added tokens of the file ("special"
ones) are found in the text first and take their own id, as the file asks.

Null texts are empty and have no ids. Repeated rows are encoded one by one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import (HEAD, NEWLINE, Memo, RunMemo, encode_by_runs, plus, slices,
                                 small_batches, tidy, under_safe_names)

# fixed value: the pattern that byte-level vocabularies of this kind cut text with
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 characters stand for themselves, the others for characters from 256 on, in order."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Bpe:
    """Encoder and decoder of one vocabulary file (the JSON of a byte-level BPE tokenizer)."""

    def __init__(self, spec: dict, memo: int = 400_000):
        model = spec["model"]
        alphabet = byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        self.base = [vocab[c] for c in alphabet]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[a + b])
        back = {c: b for b, c in enumerate(alphabet)}
        self.strings = {i: bytes(back[c] for c in s) for s, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.strings |= {i: s.encode() for s, i in self.added.items()}
        self.split_added = re.compile("(" + "|".join(
            map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pieces = regex.compile(PIECES)
        self.memo = RunMemo(self._learn, memo)
        self.piece_memo = Memo(lambda piece: np.array(self.merge(piece.encode(
            "utf-8", "surrogatepass")), "<u4").tobytes(), 2 * memo)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        ids: list = [self.base[b] for b in data]
        n = len(ids)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        queue = []
        for i in range(n - 1):
            if (m := ranks.get((ids[i], ids[i + 1]))) is not None:
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, new = heapq.heappop(queue)
            j = right[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue                                    # stale
            ids[i], ids[j] = new, None
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (m := ranks.get((new, ids[k]))) is not None:
                    heapq.heappush(queue, (m[0], i, new, ids[k], m[1]))
            if (h := left[i]) >= 0 and (m := ranks.get((ids[h], new))) is not None:
                heapq.heappush(queue, (m[0], h, ids[h], new, m[1]))
        return [x for x in ids if x is not None]

    def _run_ids(self, run: str) -> bytes:
        memo = self.piece_memo
        return b"".join([memo[p] if len(p) <= 64 else np.array(self.merge(p.encode(
            "utf-8", "surrogatepass")), "<u4").tobytes() for p in self.pieces.findall(run)])

    def _learn(self, keys: list[str]) -> list[bytes]:
        return [self._run_ids(k.removeprefix(HEAD) if k[0] in HEAD + NEWLINE else " " + k)
                for k in keys]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        plain = [i for i, t in enumerate(texts) if t and HEAD not in t
                 and not (self.split_added and self.split_added.search(t))]
        found = dict(zip(plain, encode_by_runs([texts[i] for i in plain], self.memo)))
        return [found[i] if i in found else self._with_added(t) for i, t in enumerate(texts)]

    def _with_added(self, text: str) -> np.ndarray:
        parts = self.split_added.split(text) if self.split_added else [text]
        return np.frombuffer(b"".join([np.array([self.added[s]], "<u4").tobytes()
                                       if s in self.added else self._run_ids(s)
                                       for s in parts if s]), "<u4")

    def decode(self, ids) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[tuple[str, int], Bpe] = {}


def loaded(spec: str, memo: int) -> Bpe:
    """The encoder of a vocabulary, one per Python worker."""
    key = (hashlib.sha256(spec.encode()).hexdigest(), memo)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(json.loads(spec), memo)
    return _LOADED[key]


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text",
                  with_ids: bool = True, memo: int = 400_000) -> DataFrame:
    """`docs` with n_tokens, ids (array of int), ids_sha256 (of the ids as little-endian unsigned
    32-bit integers) and decoded_sha256 (of the decoded text); `with_ids=False` leaves the ids
    out. `memo` is the number of words that a worker remembers (about 400 bytes each, with their
    pieces); a small one costs time only. Columns of those names, in any case, are replaced."""
    return under_safe_names(docs, [text], ("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
                            lambda safe, t: _encode_decode(safe, vocabulary, t, with_ids, memo))


def _encode_decode(docs: DataFrame, vocabulary: str, text: str, with_ids: bool,
                   memo: int) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())       # one vocabulary file, a few MB
    new = ["n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]
    kept = docs.columns

    def run(batches):
        bpe = loaded(spec.value, memo)
        for b in slices(batches, 250):
            n, ids, sha, back = [], [], [], []
            for x in bpe.many([t or "" for t in b["__llm_text"].to_pylist()]):
                n.append(len(x))
                ids.append(x)
                sha.append(hashlib.sha256(x.tobytes()).hexdigest())
                back.append(hashlib.sha256(bpe.decode(x.tolist()).encode()).hexdigest())
            cols = [b[c] for c in kept] + [pa.array(n, pa.int64())]
            if with_ids:
                flat = np.concatenate(ids) if ids else np.empty(0, "<u4")
                ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                     pa.array(flat.astype(np.int32))))
            cols += [pa.array(sha, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*kept, *new])

    kinds = {"n_tokens": "long", "ids": "array<int>"}
    fields = plus(docs, kept, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in new))
    return docs.select(*kept, F.col(text).alias("__llm_text")).mapInArrow(tidy(run), fields)
