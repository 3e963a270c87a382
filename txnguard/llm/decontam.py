"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised alike: A-Z lower-cased, words are runs of ASCII
letters, digits and non-ASCII characters. Every run of `window` words of an item is a pattern (a
shorter item is one pattern). All patterns form one automaton over word numbers, and each document
is scanned once. Hits are ranges of words, mapped to character offsets of the original text.

The automaton is a set of flat arrays (edges, fail links, outputs), made once by one task, level by
level, and written to the shared folder. Workers map the files into memory, so the workers of a
machine share one copy, and a benchmark of any size costs one pass over the documents. A word of
benchmark text takes about 21 bytes per word of the window (a 20 MB benchmark: some 0.7 GB); where
the shared folder is no mounted one, each worker reads its own copy. Nothing goes to the driver.

A scan steps through many places of a batch at once: the state after a word depends on no more
words than the longest pattern has, so a batch is cut into lanes, each of which begins that many
words early. Words are numbered by 64-bit hashes; the letters of all words of a hit are compared
before it counts.

A null or empty text has no words, an empty benchmark hits nothing, an empty table stays empty.
Very long texts are hashed in pieces. Benchmark rows without an id still mark words but are not
counted as items. Repeated benchmark rows count once; repeated documents are judged one by one.
"""

from __future__ import annotations

import hashlib
import io
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import (WORDS_ONLY, pick, plus, shared_path, slices, small_batches, tidy,
                                 under_safe_names, word_hashes)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PIECE = 1 << 19                                   # bytes of text that are hashed at once
LANE = 128                                        # words that a lane of a scan answers for


def normal_words(text: bytes | None) -> list[bytes]:
    return text.translate(WORDS_ONLY).split() if text else []


def _hashes(texts: list[bytes]) -> list[np.ndarray]:
    """The hashes of each normalised text's words; long texts are cut at spaces and put together."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    held: list[tuple[int, bytes]] = []

    def flush():
        n, h, _ = word_hashes([t for _, t in held])
        for (i, _), part in zip(held, np.split(h, np.cumsum(n)[:-1])):
            out[i].append(part)
        held.clear()

    size = 0
    for i, t in enumerate(texts):
        at = 0
        while at < len(t):
            end = len(t) if len(t) - at <= PIECE else t.find(b" ", at + PIECE)
            end = len(t) if end < 0 else end
            held.append((i, t[at:end]))
            size, at = size + end - at, end
            if size >= PIECE:
                flush()
                size = 0
    if held:
        flush()
    return [p[0] if len(p) == 1 else np.concatenate(p) if p else np.empty(0, np.uint64)
            for p in out]


def _strings(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as (bytes, offsets)."""
    return (np.frombuffer(b"".join(values), np.uint8),
            np.cumsum([0, *map(len, values)], dtype=np.int64))


def automaton(items: list[tuple[str | None, bytes | None]], window: int) -> dict[str, np.ndarray]:
    """The flat arrays of the automaton over all windows of (item id, text) rows.

    State 0 is the root. Edges are sorted by (state, word), and edge i leads to state i + 1, so one
    binary search follows an edge: states are numbered level by level in the order of their edges."""
    texts = [(t or b"").translate(WORDS_ONLY) for _, t in items]
    hashes = _hashes(texts)
    flat = np.concatenate([np.empty(0, np.uint64), *hashes])
    vocabulary, first, number = np.unique(flat, return_index=True, return_inverse=True)
    words = [w for t in texts for w in t.split()]
    letters = [words[i] for i in first]
    number = number.astype(np.int64) + 1
    if any(letters[k - 1] != w for k, w in zip(number.tolist(), words)):
        raise ValueError("two words of the benchmark have the same 64-bit hash")
    base = len(vocabulary) + 1

    length = np.array([len(h) for h in hashes], np.int64)
    size = np.minimum(length, window)
    count = np.where(length > 0, length - size + 1, 0)       # patterns of each item
    item = np.repeat(np.arange(len(items)), count)
    begin = np.repeat(np.cumsum(length) - length, count) + (
        np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))
    size = size[item]

    state = np.zeros(len(begin), np.int64)
    edges, levels, total = [np.empty(0, np.int64)], [], 1
    for depth in range(1, int(size.max(initial=0)) + 1):
        on = np.flatnonzero(size >= depth)
        keys, to = np.unique(state[on] * base + number[begin[on] + depth - 1],
                             return_inverse=True)
        state[on] = total + to
        edges.append(keys)
        levels.append((total, total + len(keys)))
        total += len(keys)
    edge = np.concatenate(edges)
    root = np.zeros(base, np.int32)
    if levels:
        root[edge[:levels[0][1] - 1]] = np.arange(*levels[0])

    fail, out = np.zeros(total, np.int32), np.zeros(total, np.int32)
    depth_of = np.zeros(total, np.int32)
    out[state] = state                                       # states where a pattern ends
    out[0] = 0
    for depth, (lo, hi) in enumerate(levels, 1):
        parent, word = np.divmod(edge[lo - 1:hi - 1], base)
        if depth > 1:
            fail[lo:hi] = _step(edge, fail, root, fail[parent].astype(np.int64), word)
        depth_of[lo:hi] = depth
        none = lo + np.flatnonzero(out[lo:hi] == 0)
        out[none] = out[fail[none]]                          # the longest shorter pattern

    names = sorted({i for i, _ in items if i is not None})
    rank = {n: k for k, n in enumerate(names)}
    of = np.array([rank.get(i, -1) for i, _ in items], np.int64)[item]
    ends = np.unique(np.stack([state, of], 1)[of >= 0], axis=0)
    blob, at = _strings(letters)
    name_blob, name_at = _strings([n.encode() for n in names])
    return {"vocabulary": vocabulary, "letters": blob, "letters_at": at, "edge": edge,
            "root": root, "fail": fail, "out": out, "depth": depth_of,
            "item_at": np.searchsorted(ends[:, 0], np.arange(total + 1)).astype(np.int64),
            "item": ends[:, 1].copy(), "names": name_blob, "names_at": name_at}


def _step(edge, fail, root, state, word) -> np.ndarray:
    """The next states for states and words, along fail links where there is no edge."""
    base, to = len(root), root[word].astype(np.int64)
    left = np.flatnonzero((state > 0) & (word > 0))
    to[word == 0] = 0
    s = state[left]
    while len(left):
        key = s * base + word[left]
        at = np.minimum(np.searchsorted(edge, key), len(edge) - 1)
        found = edge[at] == key
        to[left[found]] = at[found] + 1
        left, s = left[~found], fail[s[~found]].astype(np.int64)
        go = s > 0                                           # at the root `to` is right already
        left, s = left[go], s[go]
    return to


class Patterns:
    """The windows of (item_id, text) rows as one automaton, over arrays in memory or in files."""

    def __init__(self, items: list[tuple[str | None, bytes | None]] = (), window: int = 10,
                 arrays: dict[str, np.ndarray] | None = None):
        self.a = automaton(list(items), window) if arrays is None else arrays
        self.early = max(0, int(self.a["depth"][-1]) - 1)    # the last state is a deepest one

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, hit ranges of words [from, to), and the items found."""
        return self.scan_all([text])[0]

    def scan_all(self, texts: list[bytes | None]) -> list[tuple[int, list, set]]:
        plain = [(t or b"").translate(WORDS_ONLY) for t in texts]
        numbers = [self._numbers(h) for h in _hashes(plain)]
        found = self._hits(numbers)
        for i in found:
            odd = self._misread(plain[i], numbers[i], found[i][0])
            while odd:                                       # equal hashes, different letters
                numbers[i][odd] = 0
                found[i] = self._hits([numbers[i]]).get(0, ([], set()))
                odd = self._misread(plain[i], numbers[i], found[i][0])
        return [(len(n), *found.get(i, ([], set()))) for i, n in enumerate(numbers)]

    def _numbers(self, h: np.ndarray) -> np.ndarray:
        known = self.a["vocabulary"]
        if not len(known):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        return np.where(known[at] == h, at + 1, 0)

    def _misread(self, plain: bytes, numbers: np.ndarray, spans) -> list[int]:
        words, at, letters = plain.split(), self.a["letters_at"], self.a["letters"]
        return [i for lo, hi in spans for i in range(lo, hi)
                if letters[at[numbers[i] - 1]:at[numbers[i]]].tobytes() != words[i]]

    def _states(self, seq: np.ndarray):
        """(place, state) of the words of a sequence after which a pattern ends."""
        a, early = self.a, self.early
        lanes = -(-len(seq) // LANE)
        padded = np.zeros(early + lanes * LANE, np.int64)
        padded[early:early + len(seq)] = seq
        steps = np.lib.stride_tricks.sliding_window_view(padded, early + LANE)[::LANE].T.copy()
        state, ends = np.zeros(lanes, np.int64), a["out"]
        places, states = [], []
        for i, word in enumerate(steps):
            state = _step(a["edge"], a["fail"], a["root"], state, word)
            if i >= early and state.any():
                hit = np.flatnonzero(ends[state])
                if len(hit):
                    places.append(hit * LANE + i - early)
                    states.append(ends[state[hit]])
        return ((np.concatenate(places), np.concatenate(states)) if places
                else (np.empty(0, np.int64), np.empty(0, np.int32)))

    def _hits(self, numbers: list[np.ndarray]) -> dict[int, tuple[list, set]]:
        """Hit ranges and items of the texts that have any, by their place in the list."""
        if not len(self.a["edge"]) or not numbers:
            return {}
        stop = np.zeros(1, np.int64)                         # between texts: no pattern goes over
        place, state = self._states(np.concatenate([x for n in numbers for x in (n, stop)]))
        begin = np.cumsum([0, *(len(n) + 1 for n in numbers)])
        text = np.searchsorted(begin, place, "right") - 1
        a, out = self.a, {}
        for i in np.unique(text).tolist():
            mine = text == i
            last = place[mine] - begin[i] + 1
            s = state[mine]
            spans = merged(list(zip((last - a["depth"][s]).tolist(), last.tolist())))
            items, s = set(), np.unique(s)
            while len(s):                                    # and all shorter patterns
                for x in s.tolist():
                    items.update(a["item"][a["item_at"][x]:a["item_at"][x + 1]].tolist())
                s = np.unique(a["out"][a["fail"][s]])
                s = s[s > 0]
            out[i] = (spans, {self._name(k) for k in items})
        return out

    def _name(self, k: int) -> str:
        at = self.a["names_at"]
        return self.a["names"][at[k]:at[k + 1]].tobytes().decode()


def write_automaton(benchmark: DataFrame, window: int, item: str, text: str) -> str | None:
    """Build the automaton in one task, write it to a folder of the shared one, and return that (None
    for a benchmark without rows). A repeated attempt writes a folder of its own."""
    folder = shared_path(benchmark.sparkSession, "automaton")
    rows = (benchmark.select(F.col(item).cast("string").alias("i"),
                             F.col(text).cast("binary").alias("t"))
            .filter("t is not null").distinct().coalesce(1))

    def run(batches):
        items = [(i, t) for b in batches
                 for i, t in zip(b["i"].to_pylist(), b["t"].to_pylist())]
        if not items:
            return
        store, root = fs.FileSystem.from_uri(folder)
        name = str(TaskContext.get().taskAttemptId())
        store.create_dir(f"{root}/{name}", recursive=True)
        for key, value in automaton(items, window).items():
            data = io.BytesIO()
            np.save(data, value)
            with store.open_output_stream(f"{root}/{name}/{key}.npy", compression=None) as f:
                f.write(data.getbuffer())
        yield pa.RecordBatch.from_pydict({"name": [name]})

    got = rows.mapInArrow(tidy(run), "name string").first()
    return f"{folder}/{got.name}" if got else None


ARRAYS = ("vocabulary", "letters", "letters_at", "edge", "root", "fail", "out", "depth", "item_at",
          "item", "names", "names_at")


@lru_cache(maxsize=1)
def loaded(folder: str) -> Patterns:
    """The automaton of a folder, kept by the worker."""
    store, root = fs.FileSystem.from_uri(folder)

    def load(key):
        path = f"{root}/{key}.npy"
        if isinstance(store, fs.LocalFileSystem):
            return np.load(path, mmap_mode="r")
        with store.open_input_file(path) as f:
            return np.load(io.BytesIO(f.read()))
    return Patterns(arrays={k: load(k) for k in ARRAYS})


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def original_spans(text: str, spans: list[tuple[int, int]]) -> list[list[int]]:
    """Character offsets [from, to) in the original text of ranges of words."""
    if not spans:
        return []
    at = [m.span() for m in WORD.finditer(text)]
    return [[at[lo][0], at[hi - 1][1]] for lo, hi in spans]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text",
                  item: str = "item_id", item_text: str = "text") -> DataFrame:
    """`docs` with n_words, n_hit, items (sorted ids as strings) and spans (character offsets of
    hit passages). Columns of those names, in any case, are replaced."""
    bench = pick(benchmark, item, item_text).toDF("item", "text")
    return under_safe_names(docs, [text], NEW, lambda safe, t: _contamination(
        safe, bench, window, t))


NEW = ("n_words", "n_hit", "items", "spans")


def _contamination(docs: DataFrame, benchmark: DataFrame, window: int, text: str) -> DataFrame:
    small_batches(docs.sparkSession)
    kept = docs.columns
    folder = write_automaton(benchmark, window, "item", "text")

    def run(batches):
        patterns = loaded(folder) if folder else Patterns()
        for b in slices(batches, 500):
            texts = b["__llm_text"].to_pylist()
            found = patterns.scan_all(texts)
            yield pa.RecordBatch.from_arrays([b[c] for c in kept] + _columns(texts, found),
                                             names=[*kept, *NEW])

    body = docs.select(*kept, F.col(text).cast("binary").alias("__llm_text"))
    return body.mapInArrow(tidy(run), plus(
        docs, kept, "n_words long, n_hit long, items array<string>, spans array<array<int>>"))


def _columns(texts, found) -> list[pa.Array]:
    spans = [original_spans((t or b"").decode("utf-8", "replace"), s)
             for t, (_, s, _) in zip(texts, found)]
    return [pa.array([n for n, _, _ in found], pa.int64()),
            pa.array([sum(hi - lo for lo, hi in s) for _, s, _ in found], pa.int64()),
            pa.array([sorted(i) for _, _, i in found], pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.list_(pa.int32())))]


def items_digest(items) -> str:
    """SHA-256 of the comma-joined ids."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
