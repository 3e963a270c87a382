"""Token ids in binary files: one zstandard frame per document and a shared trained dictionary.

1. A dictionary is trained on the serialized ids of a bounded sample (`sample` documents with the
   smallest hash of their id, at most `sample_bytes` of each).
2. Documents are range-partitioned by id (rows that repeat an id also by the beginning of their text,
   which keeps the order) and sorted. Each task encodes its documents, appends the
   end id, compresses every document separately with the dictionary and writes files of about
   `max_file` bytes. Files carry the dictionary's hash and an index of frame offsets, so a single
   short document is one small read (`TokenFile.ids`).
3. The written files are listed in a table with the number of ids before each of them, and are read
   back file by file.

File format: magic, length and JSON of the header (dictionary hash, integer type, end id), frames,
then the footer: a zstandard frame of JSON with ids and frame offsets, its offset and the magic.

Null texts are empty. Rows that repeat an id are all kept, ordered by text; null ids come first.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import (HEAD, NEWLINE, RunMemo, encode_by_runs, pick, settle,
                                 shared_path, small_batches, tidy)

MAGIC = b"TOKIDS01"
FILES = "part int, seq int, file string, docs long, tokens long, bytes long"


class Encoder:
    """Ids of whole texts by the tokenizers library, as little-endian unsigned 32-bit integers.

    With a byte-level pre-tokenizer texts are cut into runs that are encoded on their own (see
    `common.run_keys`): all runs of a batch that are new go through the library in one text, and up
    to `memo` runs are remembered. Any other kind of tokenizer, and a text that contains an added
    token, is encoded whole."""

    def __init__(self, spec: str, memo: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size()
        told = json.loads(spec)
        pre = told.get("pre_tokenizer") or {}
        self.by_runs = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                        and not pre.get("add_prefix_space") and not told.get("normalizer"))
        # texts with one of these are encoded whole
        self.whole_if = [HEAD, *(t["content"] for t in told.get("added_tokens", []))]
        # a character of the byte alphabet is a byte, so a token's bytes are its length
        self.bytes = np.zeros(self.size, np.int64)
        for token, i in self.library.get_vocab().items():
            self.bytes[i] = len(token)
        self.memo = RunMemo(self._learn, memo)

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, keys: list[str]) -> list[bytes]:
        out: list = [None] * len(keys)
        after_space = [i for i, k in enumerate(keys) if k[0] not in HEAD + NEWLINE]
        for i, ids in zip(after_space, self._apart([keys[i] for i in after_space], " ")):
            out[i] = ids
        # after a newline, which is a token of its own unless space stands at its other side
        heads = [i for i, k in enumerate(keys) if k[0] == HEAD and k[1:] and not k[1].isspace()
                 and not k[-1].isspace()]
        for i, ids in zip(heads, self._apart([keys[i][1:] for i in heads], "\n")):
            out[i] = ids[4:]
        for i, k in enumerate(keys):
            if out[i] is None:
                out[i] = self.whole(k.removeprefix(HEAD)) if k != HEAD else b""
        return out

    def _apart(self, runs: list[str], before: str, together: int = 1000) -> list[bytes]:
        """Ids of `before` and each run. Many runs are encoded as one text and told apart by the
        bytes that their tokens stand for."""
        out: list[bytes] = []
        parts = [runs[at:at + together] for at in range(0, len(runs), together)]
        coded = self.library.encode_batch_fast([before + before.join(p) for p in parts],
                                               add_special_tokens=False)
        for part, encoding in zip(parts, coded):
            ids = np.array(encoding.ids, "<u4")
            sizes = np.fromiter(map(len, map(str.encode, part)), np.int64, len(part))
            cut = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(sizes + 1)) + 1
            data, ends = ids.tobytes(), (4 * cut).tolist()
            out += [data[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return out

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        whole = [not t or not self.by_runs or any(x in t for x in self.whole_if) for t in texts]
        by_runs = iter(encode_by_runs([t for t, w in zip(texts, whole) if not w], self.memo))
        return [np.frombuffer(self.whole(t) if t else b"", "<u4") if w else next(by_runs)
                for t, w in zip(texts, whole)]


_LOADED: dict[str, Encoder] = {}


def loaded(spec: str) -> Encoder:
    """The encoder of a vocabulary, one per Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(spec)
    return _LOADED[key]


def _sample(docs: DataFrame, spec, dtype: str, end_id: int, sample: int, sample_bytes: int,
            text: str, id_col: str) -> list[bytes]:
    docs = pick(docs, id_col, text).toDF("_id", "_t")
    chosen = (docs.select("_id").filter("_id is not null").distinct()
              .orderBy(F.xxhash64("_id"), "_id").limit(sample))

    def run(batches):
        encoder = loaded(spec.value)
        for b in batches:
            got = [_packed(ids, dtype, end_id)[:sample_bytes]
                   for ids in encoder.many([t or "" for t in b["_t"].to_pylist()])]
            yield pa.RecordBatch.from_arrays([b["_id"], pa.array(got, pa.binary())],
                                             names=["_id", "ids"])

    rows = (docs.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_t").alias("_t")))
    kind = docs.schema["_id"].dataType.simpleString()
    return [bytes(r.ids) for r in rows.mapInArrow(tidy(run), f"_id {kind}, ids binary")
            .orderBy("_id").collect()]


def _packed(ids: np.ndarray, dtype: str, end_id: int) -> bytes:
    return np.append(ids, np.uint32(end_id)).astype(dtype).tobytes()


def train_dictionary(samples: list[bytes], size: int = 64 << 10) -> bytes:
    """A zstandard dictionary; where the samples are too few to train on, their bytes themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


def _dictionary(data: bytes):
    return zstandard.ZstdCompressionDict(data) if data else None


class _Writer:
    def __init__(self, out, header: dict):
        told = json.dumps(header).encode()
        self.out, self.ids, self.offsets, self.tokens = out, [], [], 0
        out.write(MAGIC + struct.pack("<I", len(told)) + told)

    def add(self, doc, frame: bytes, tokens: int) -> None:
        self.ids.append(doc)
        self.offsets.append(self.out.tell())
        self.tokens += tokens
        self.out.write(frame)

    def close(self) -> int:
        at = self.out.tell()
        self.out.write(zstandard.compress(json.dumps([self.ids, [*self.offsets, at]]).encode()))
        self.out.write(struct.pack("<Q", at) + MAGIC)
        size = self.out.tell()
        self.out.close()
        return size


class TokenFile:
    """One file, opened for reading whole or by document number."""

    def __init__(self, uri: str, dictionary: bytes):
        store, path = fs.FileSystem.from_uri(uri)
        self.file = store.open_input_file(path)
        end = self.file.size()
        at, magic = struct.unpack("<Q8s", self.file.read_at(16, end - 16))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no token file")
        head = struct.unpack("<I", self.file.read_at(4, len(MAGIC)))[0]
        self.header = json.loads(self.file.read_at(head, len(MAGIC) + 4))
        if self.header["dictionary_sha256"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError(f"{uri} needs another dictionary")
        self.docs, self.offsets = json.loads(
            zstandard.decompress(self.file.read_at(end - 16 - at, at)))
        self.z = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def _ids(self, frame) -> np.ndarray:
        return np.frombuffer(self.z.decompress(frame), self.header["dtype"]).astype("<u4")

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document, by one read."""
        lo, hi = self.offsets[k], self.offsets[k + 1]
        return self._ids(self.file.read_at(hi - lo, lo))

    def all(self, max_read: int = 8 << 20):
        """(document id, ids) in order, by reads of about `max_read` bytes."""
        k = 0
        while k < len(self.docs):
            to = k + 1
            while to < len(self.docs) and self.offsets[to + 1] - self.offsets[k] <= max_read:
                to += 1
            data = self.file.read_at(self.offsets[to] - self.offsets[k], self.offsets[k])
            for i in range(k, to):
                lo = self.offsets[i] - self.offsets[k]
                yield self.docs[i], self._ids(data[lo:lo + self.offsets[i + 1] - self.offsets[i]])
            k = to


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int = 2, folder: str | None = None,
                 sample: int = 2000, sample_bytes: int = 16 << 10, max_file: int = 16 << 20,
                 parts: int | None = None, text: str = "text",
                 id_col: str = "doc_id") -> tuple[DataFrame, bytes]:
    """Write the files below `folder` (a new shared one by default). Returns the table of files in
    document order, with the number of ids before each (`start`), and the dictionary."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or shared_path(spark, "tokens")
    with open(vocabulary, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())        # one vocabulary file, a few MB
    dtype = "<u2" if max(Encoder(spec.value).size - 1, end_id) < 1 << 16 else "<u4"
    dictionary = train_dictionary(_sample(docs, spec, dtype, end_id, sample, sample_bytes, text,
                                          id_col))
    shared = spark.sparkContext.broadcast(dictionary)        # at most 64 KiB
    header = {"dictionary_sha256": hashlib.sha256(dictionary).hexdigest(), "dtype": dtype,
              "end_id": end_id}
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (pick(docs, id_col, text).toDF("_k", "_t")
               .repartitionByRange(parts, "_k", F.substring("_t", 1, 64)).sortWithinPartitions("_k", "_t")
               .select(F.col("_k").cast("string").alias("_k"), "_t"))

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task, encoder = TaskContext.get(), loaded(spec.value)
        z = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(shared.value))
        out, name, rows = None, None, []

        def done():
            rows.append((task.partitionId(), len(rows), name, len(out.ids), out.tokens,
                         out.close()))
        for b in batches:
            texts = [t or "" for t in b["_t"].to_pylist()]
            for doc, encoded in zip(b["_k"].to_pylist(), encoder.many(texts)):
                if out is None:
                    name = f"tokens-{task.partitionId():05d}-{len(rows):05d}-{task.taskAttemptId()}.bin"
                    out = _Writer(store.open_output_stream(f"{root}/{name}", compression=None),
                                  header)
                ids = _packed(encoded, dtype, end_id)
                out.add(doc, z.compress(ids), len(ids) // np.dtype(dtype).itemsize)
                if out.out.tell() >= max_file:
                    done()
                    out = None
        if out is not None:
            done()
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        names = ("part", "seq", "file", "docs", "tokens", "bytes")
        cols = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=list(names))

    files = settle(ordered.mapInArrow(tidy(run), FILES), "token-files")
    # one row per file: a single small partition
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.select(
        F.concat(F.lit(f"{folder}/"), F.col("file")).alias("file"), "docs", "tokens", "bytes",
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start")), dictionary


def read_tokens(files: DataFrame, dictionary: bytes, with_ids: bool = False) -> DataFrame:
    """Read files back: doc_id (text), start, n_tokens, ids_crc32, and the ids if asked for."""
    spark = files.sparkSession
    shared = spark.sparkContext.broadcast(dictionary)
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def batch(rows):
        cols = list(zip(*rows))
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                          names=names)

    def run(batches):
        for b in batches:
            for uri, start in zip(b["file"].to_pylist(), b["start"].to_pylist()):
                rows = []
                for doc, ids in TokenFile(uri, shared.value).all():
                    rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()),
                                 *([ids.tolist()] if with_ids else [])))
                    start += len(ids)
                    if len(rows) == 2000:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    parts = max(1, min(files.count(), 10_000))
    ids = ", ids array<long>" if with_ids else ""
    return (files.select("file", "start").repartition(parts, "file")
            .mapInArrow(run, f"doc_id string, start long, n_tokens long, ids_crc32 long{ids}"))
