"""Small helpers of the operators: written intermediate tables, byte tables, word hashes."""

from __future__ import annotations

import ctypes
import gc
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnguard.session import checkpoint_root

# bytes.translate tables: A-Z to a-z, and that with every other ASCII non-alphanumeric as a space
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORDS_ONLY = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it again: cuts the lineage, survives lost
    executors, and stops Python stages from running twice."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, whatever the other columns are called (names that
    differ in case only, or hold a dot)."""
    columns = df.columns
    return df.toDF(*[f"_{i}" for i in range(len(columns))]).select(
        *[F.col(f"_{columns.index(n)}").alias(n) for n in names])


def under_safe_names(df: DataFrame, used: list[str], new: tuple[str, ...], run) -> DataFrame:
    """`run(frame, *used)` with the columns of `df` under names that clash with nothing (also where
    they differ in case only, or hold a dot); the result has their own names again. Columns named
    like one of `new`, in any case, are replaced. `used` are columns that `run` works on."""
    names, replaced = df.columns, {n.lower() for n in new}
    at = [names.index(u) for u in used]
    kept = [i for i, n in enumerate(names) if n.lower() not in replaced or i in at]
    safe = df.toDF(*[f"_c{i}" for i in range(len(names))]).select(*[f"_c{i}" for i in kept])
    out = run(safe, *[f"_c{i}" for i in at])
    own = {f"_c{i}": names[i] for i in kept}
    return out.toDF(*[own.get(c, c) for c in out.columns])


BATCH_ROWS = 1500


def small_batches(spark: SparkSession) -> None:
    """Rows per Arrow batch for whole texts, the same for every operator, so that the order in which
    queries are built and run changes nothing. What needs less at once cuts its batches (`slices`)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def slices(batches, rows: int):
    """Arrow batches cut to at most `rows` rows each, whatever the session's batch size is."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def tidy(run):
    """The same function for mapInArrow, giving memory back to the system when a task ends. Python
    workers live on between tasks, beside the executor's heap."""
    def wrapped(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):
            libc.malloc_trim(0)
    return wrapped


def plus(df: DataFrame, kept: list[str], ddl: str) -> StructType:
    """The schema of `kept` columns of `df` followed by the fields of `ddl`."""
    return StructType(df.select(*kept).schema.fields + StructType.fromDDL(ddl).fields)


def utf8(text) -> bytes:
    """UTF-8 of a text; nulls (None, NaN) are empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


class Memo(dict):
    """A function's results by key. At most about `limit` of them are held, in two generations: a
    full one becomes the older, and what is used again moves over."""

    def __init__(self, fn, limit: int):
        super().__init__()
        self.fn, self.limit, self.old = fn, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit // 2:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        self[key] = value
        return value


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
# a random-looking number for each byte value, made by rule
BYTE_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b]), 13) for b in range(256)], np.uint64)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(texts: list[bytes], letters: int = 0):
    """(words per text, 64-bit hash of every word, the same of its first `letters` letters or
    None). Words are what bytes.split() gives. A hash is a polynomial in the values of the bytes,
    so all words are hashed by array operations over the bytes."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    sizes = ends - starts
    if not len(sizes):
        none = np.empty(0, np.uint64)
        return np.zeros(len(texts), np.int64), none, none if letters else None
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    power = np.full(int(sizes.max()), _M1, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    letter = data[~space]
    value = BYTE_VALUES[letter]
    value *= power[place]

    def mixed(sums, size):
        h = sums + size.astype(np.uint64) * _M2
        h = (h ^ (h >> np.uint64(32))) * _M2
        return h ^ (h >> np.uint64(29))

    h, stems = mixed(np.add.reduceat(value, first), sizes), None
    if letters:
        begins = (letter & 0xC0) != 0x80                 # first bytes of UTF-8 characters
        nth = np.cumsum(begins)
        value[nth - np.repeat(nth[first] - begins[first], sizes) > letters] = 0
        stems = mixed(np.add.reduceat(value, first), np.zeros(len(first), np.int64))
    upto = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return np.diff(upto, prepend=0), h, stems


START = re.compile(r" (?=\S)")
HEAD, NEWLINE = "\0", "\n"
LONGEST = 64


def _lines(text: str) -> list[str]:
    cut = text.split("\n")
    odd = any(not x or x[0].isspace() or x[-1].isspace() for x in cut)
    return [text] if odd else cut


def run_keys(text: str) -> list[str]:
    """A text cut where byte-level pre-tokenizers always start a token: before a space that a
    non-space follows, and around a newline between non-spaces. A key is a run without the space
    before it, HEAD and a run that has no space before it, or NEWLINE. `text` holds no HEAD."""
    out: list[str] = []
    for i, line in enumerate(_lines(text)):
        head, *rest = START.split(line)
        out += [NEWLINE, HEAD + head, *rest] if i else [HEAD + head, *rest]
    return out


class RunMemo:
    """Ids of runs as bytes, by key; `learn` gives those of new keys, in their order. Forgets
    everything when more than `limit` keys are held; keys of more than LONGEST characters are not
    held."""

    def __init__(self, learn, limit: int):
        self.learn, self.limit = learn, limit
        self.known: dict[str, bytes] = {}

    def __call__(self, keys: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known.clear()
        ids = list(map(self.known.get, keys))
        missing = [i for i, x in enumerate(ids) if x is None]
        new = [keys[i] for i in missing]
        learned = self.learn(new)
        for i, x in zip(missing, learned):
            ids[i] = x
        if max(map(len, new), default=0) <= LONGEST:
            self.known.update(zip(new, learned))
        else:
            self.known.update((k, x) for k, x in zip(new, learned) if len(k) <= LONGEST)
        return ids


def _are_plain(keys: pa.Array) -> np.ndarray:
    """Which keys are what splitting at single spaces gives where words and newlines stand apart by
    them: a newline, or printable letters without a space (HEAD before them or not)."""
    body = pc.utf8_ltrim(keys, HEAD)
    plain = pc.or_(pc.and_(pc.utf8_is_printable(body), pc.not_equal(body, "")),
                   pc.equal(keys, NEWLINE))
    return plain.to_numpy(zero_copy_only=False)


def _ids_of(keys: pa.Array, memo: RunMemo, check: bool):
    """(ids of each list of run keys, for each whether it holds keys that aren't plain)."""
    coded = keys.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    run = coded.indices.to_numpy(zero_copy_only=False)
    runs_upto = np.concatenate(([0], np.cumsum(
        pc.list_value_length(keys).to_numpy(zero_copy_only=False))))
    bad = ~_are_plain(coded.dictionary) if check else np.zeros(len(distinct), bool)
    odd = np.diff(np.concatenate(([0], np.cumsum(bad[run])))[runs_upto]) > 0
    if bad.any():
        found = iter(memo([k for k, b in zip(distinct, bad.tolist()) if not b]))
        ids = [b"" if b else next(found) for b in bad.tolist()]
    else:
        ids = memo(distinct)
    # copy each run's ids from the table of distinct runs to its place
    taken = pa.array(ids, pa.large_binary()).take(coded.indices)
    _, ends, data = taken.buffers()
    flat = np.frombuffer(data, "<u4") if data else np.empty(0, "<u4")
    cuts = (np.frombuffer(ends, np.int64)[runs_upto] // 4).tolist()
    return [flat[a:b] for a, b in zip(cuts, cuts[1:])], odd


def encode_by_runs(texts: list[str], memo: RunMemo) -> list[np.ndarray]:
    """Ids of non-empty texts from the ids of their runs. The texts of a batch are cut at spaces
    and their runs numbered by Arrow, so Python handles each distinct run of a batch once. Texts
    where that cut leaves odd pieces (more than single spaces and newlines) are cut one by one."""
    marked = pa.array([HEAD + t.replace("\n", " \n " + HEAD) for t in texts], pa.string())
    out, odd = _ids_of(pc.split_pattern(marked, " "), memo, check=True)
    at = np.flatnonzero(odd).tolist()
    if at:
        keys = pa.array([run_keys(texts[i]) for i in at], pa.list_(pa.string()))
        for i, ids in zip(at, _ids_of(keys, memo, check=False)[0]):
            out[i] = ids
    return out
