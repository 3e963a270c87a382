"""Spelling variants: the words of a corpus, which of them lie one edit apart, and the frequent
form that each rare one is a variant of.

Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z in small letters, counted
over whole texts. Two words are near when one inserted, deleted or replaced code point makes one
the other. A word's form is its near word of the largest count (ties: smallest in code-point
order), if that has `times` the word's count. Counts grow along forms, so following them ends.

PartEnum signatures find the near pairs. A word is the set of its (letter, nth occurrence)
elements, a binary vector. A replaced letter changes two elements, an inserted one changes one, so
near words of equal length are at Hamming distance two and those of different length at distance
one. Elements are dealt to n1 parts of n2 subparts each by a hash. Two vectors at distance at most
k differ by at most k2 = ceil((k + 1) / n1) - 1 elements in some part, so they agree on all but k2
subparts of it: a signature is the elements of n2 - k2 subparts of one part, and all choices of
them are enumerated. Signatures are exact: every near pair shares at least one.

Two more exact conditions narrow a signature: the shorter word's length, and the letters of one
half. With n the shorter length and h = n // 2, one edit leaves either the first h letters or the
last n - h as they are, so each signature is issued once with the first h and once with the last
n - h letters. A family of words that share a long beginning, or all letters (anagrams), thus
doesn't meet in one bucket. Candidates meet in an equi-join on the 64-bit hash of all this, whose
condition verifies the edit distance, so that no candidate pair is ever written. There are no caps.

Null texts have no words; a null id counts as empty text in the check sum. Empty tables give no
rows; repeated rows count each time. Texts of any length are read whole; a word of any length is a
word. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import LOWER, pick, settle, small_batches, tidy

M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def word_counts(docs: DataFrame, min_letters: int = 5, min_count: int = 3,
                drop_every: int | None = None, text: str = "text",
                id_col: str = "doc_id") -> DataFrame:
    """(word, n) of all words of at least `min_letters` letters and `min_count` occurrences.

    With `drop_every`, a run whose h = crc32("<id>:<run>") that number divides loses its letter
    h % length: spelling errors with a known origin, for tests of the grouping."""
    spoken = re.compile(f"[a-zÀ-ÿ]{{{min_letters},}}")

    def run(batches):
        total: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total.keys()), pa.string()),
                 pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for doc, t in zip(b["id"].to_pylist(), b["t"].to_pylist()):
                if not t:
                    continue
                found = Counter(spoken.findall(t.encode("utf-8", "surrogatepass").translate(LOWER)
                                               .decode("utf-8", "surrogatepass")))
                if not drop_every:
                    total.update(found)
                    continue
                upto = zlib.crc32(f"{doc or ''}:".encode())
                for w, n in found.items():
                    h = zlib.crc32(w.encode(), upto)
                    if h % drop_every == 0:
                        i = h % len(w)
                        w = w[:i] + w[i + 1:]
                        if len(w) < min_letters:
                            continue
                    total[w] += n
            if len(total) > 200_000:
                yield out()
                total.clear()
        yield out()

    small_batches(docs.sparkSession)
    rows = pick(docs, id_col, text).toDF("id", "t").select(F.col("id").cast("string"), "t")
    return (rows.mapInArrow(tidy(run), "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M1
    return x ^ (x >> np.uint64(31))


class Letters:
    """Hashes of the vectors and of the halves of many words, by array operations."""

    def __init__(self, words: list[str]):
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.end = np.cumsum(self.size)
        self.begin = self.end - self.size
        self.word = np.repeat(np.arange(len(words)), self.size)
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"),
                             "<u4").astype(np.uint64)
        # elements (letter, nth occurrence in its word)
        order = np.lexsort((code, self.word))
        w, c = self.word[order], code[order]
        new = np.ones(len(c), bool)
        new[1:] = (w[1:] != w[:-1]) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)
        nth = np.arange(len(c)) - np.repeat(first, np.diff(np.append(first, len(c))))
        self.owner = w
        self.element = _mixed(c * M1 + nth.astype(np.uint64) * M2 + np.uint64(1))
        # running sums of letter values by place from the beginning and from the end
        place = np.arange(len(code)) - self.begin[self.word]
        back = self.size[self.word] - 1 - place
        value = _mixed(code + np.uint64(7))
        zero = np.zeros(1, np.uint64)
        self.from_left = np.concatenate((zero, np.cumsum(
            value * _mixed(place.astype(np.uint64) + np.uint64(3)))))
        self.from_right = np.concatenate((zero, np.cumsum(
            value * _mixed(back.astype(np.uint64) + np.uint64(3)))))

    def halves(self, n: np.ndarray):
        """Hashes of the first n // 2 letters and of the last n - n // 2."""
        h = n // 2
        left = self.from_left[self.begin + h] - self.from_left[self.begin]
        right = self.from_right[self.end] - self.from_right[self.end - (n - h)]
        return _mixed(left + np.uint64(11)), _mixed(right + np.uint64(13))

    def signatures(self, k: int, n1: int, n2: int) -> list[np.ndarray]:
        """PartEnum: one array per signature, with its hash for each word."""
        k2 = -(-(k + 1) // n1) - 1
        if not 0 <= k2 < n2:
            raise ValueError("n2 must exceed ceil((k + 1) / n1) - 1")
        part = (self.element >> np.uint64(20)) % np.uint64(n1 * n2)
        sums = np.zeros((n1 * n2, len(self.size)), np.uint64)
        np.add.at(sums, (part.astype(np.int64), self.owner), self.element)
        out = []
        for i in range(n1):
            for chosen in combinations(range(i * n2, (i + 1) * n2), n2 - k2):
                h = np.full(len(self.size), len(out) + 1, np.uint64)
                for p in chosen:
                    h = _mixed(h * M1 + sums[p])
                out.append(h)
        return out


SAME, SHORT, LONG = 0, 1, 2


def bucket_keys(words: list[str], two: tuple[int, int] = (2, 4), one: tuple[int, int] = (2, 1)):
    """(index of word, role, key) arrays. Words of equal length meet in role SAME; a word meets
    words one letter longer as SHORT and those as LONG."""
    letters = Letters(words)
    rows = []

    def issue(role, n, signatures, tag):
        ok = np.flatnonzero(n >= 0)
        if not len(ok):
            return
        n = np.maximum(n, 0)
        for half in letters.halves(n):
            at = _mixed(half + n.astype(np.uint64) * M1 + np.uint64(tag))
            for s in signatures:
                rows.append((ok, np.full(len(ok), role, np.int8), _mixed(s + at * M2)[ok]))

    issue(SAME, letters.size, letters.signatures(2, *two), 1)
    apart = letters.signatures(1, *one)
    issue(SHORT, letters.size, apart, 2)
    issue(LONG, letters.size - 1, apart, 2)
    index, role, key = (np.concatenate(x) for x in zip(*rows))
    return index, role, key.view(np.int64)


def near_pairs(words: DataFrame, two: tuple[int, int] = (2, 4),
               one: tuple[int, int] = (2, 1)) -> DataFrame:
    """(a, a_n, b, b_n): all pairs of `words` (word, n; each word once) at edit distance one, each
    pair once. `two` and `one` are (n1, n2) for distance two and one."""
    def run(batches):
        for b in batches:
            ws = b["word"].to_pylist()
            for at in range(0, len(ws), 2000):
                index, role, key = bucket_keys(ws[at:at + 2000], two, one)
                take = pa.array(index + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(role), b["word"].take(take), b["n"].take(take)],
                    names=["key", "role", "word", "n"])

    rows = words.select("word", "n").mapInArrow(tidy(run), "key long, role byte, word string, "
                                                           "n long")
    a = rows.filter(F.col("role") != LONG).select(
        "key", F.col("role").alias("ra"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = rows.filter(F.col("role") != SHORT).select(
        "key", F.col("role").alias("rb"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    meet = (((F.col("ra") == SAME) & (F.col("rb") == SAME) & (F.col("a") < F.col("b")))
            | ((F.col("ra") == SHORT) & (F.col("rb") == LONG)))
    found = a.join(b, (a["key"] == b["key"]) & meet
                   & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1))
    return found.select("a", "a_n", "b", "b_n").distinct()


def _roots(forms: DataFrame, name: str) -> DataFrame:
    """(word, root) for `forms` (word, form): pointers doubled until they end."""
    up = settle(forms.select("word", F.col("form").alias("root")), name)
    while True:
        nxt = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        up = settle(up.select("word", "root").join(nxt, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), name)
        if up.filter("moved").isEmpty():
            return up.select("word", "root")


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """`words` (word, n; each word once) with n_near (number of near words), form, form_n and root
    (the last of the forms; the word itself where it has none)."""
    words = settle(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words)

    def way(x, y):
        return F.struct(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("o"),
                        F.col(f"{y}_n").alias("o_n"))
    ways = F.explode(F.array(way("a", "b"), way("b", "a")))
    best = F.min(F.struct((-F.col("o_n")).alias("m"), F.col("o").alias("o")))
    near = (pairs.select(ways.alias("p")).select("p.*").groupBy("word", "n")
            .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    held = -F.col("best.m") >= F.lit(times) * F.col("n")
    near = settle(near.select("word", "n_near", F.when(held, F.col("best.o")).alias("form"),
                              F.when(held, -F.col("best.m")).alias("form_n")), "spelling-near")
    roots = _roots(near.filter("form is not null"), "spelling-roots")
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
