"""Spelling variants against brute force: all pairs, chains of forms, odd texts."""

import random
import zlib
from collections import Counter

import pandas as pd
import pytest
import regex

from tests.conftest import SF_SMALL
from txnguard.llm import spelling
from txnguard.llm.queries import QUERIES


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1:] == b[i + 1:]
    return a[i + 1:] == b[i:] if len(a) > len(b) else b[i + 1:] == a[i:]


def plain_words(rows, drop_every, min_letters=5, min_count=3):
    n = Counter()
    for doc, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in regex.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % drop_every == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1:]
            if len(w) >= min_letters:
                n[w] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def plain_variants(n):
    near = {w: [] for w in n}
    words = sorted(n)
    for i, a in enumerate(words):
        for b in words[:i]:
            if one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o)) if others else None
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_query_equals_brute_force(spark):
    d = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    want = plain_variants(plain_words(zip(d["doc_id"].tolist(), d["text"].tolist()), 97))
    got = QUERIES["op13_spelling"](spark, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(r.form for r in got)


@pytest.mark.parametrize("two,one", [((2, 4), (2, 1)), ((1, 4), (1, 3)), ((3, 1), (2, 2))])
def test_near_pairs_of_crowded_words(spark, two, one):
    """Few letters, anagrams, common beginnings and ends, letters beyond ASCII."""
    rng = random.Random(3)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(250)}
    words |= {"prefix" + "".join(rng.choice("xyzÿ") for _ in range(3)) for _ in range(60)}
    words |= {"".join(rng.choice("pq") for _ in range(4)) + "ending" for _ in range(15)}
    base = "w" * 400
    words |= {base, base + "w", base[:200] + "v" + base[200:], base[:399] + "u"}
    words = sorted(words)
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = spelling.near_pairs(df, two, one).collect()
    found = [tuple(sorted((r.a, r.b))) for r in got]
    want = [(a, b) for i, a in enumerate(words) for b in words[i + 1:] if one_edit(a, b)]
    assert len(found) == len(set(found)) and sorted(found) == sorted(want)


def test_near_words_share_a_key():
    rng = random.Random(9)
    letters = "abcdeéÿ"
    for _ in range(300):
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(2, 14)))
        i, kind = rng.randrange(len(a)), rng.randrange(3)
        x = rng.choice(letters)
        b = [a[:i] + a[i + 1:], a[:i] + x + a[i:], a[:i] + x + a[i + 1:]][kind]
        if a == b or not b:
            continue
        index, role, key = spelling.bucket_keys([a, b])
        mine, other = ({(r, k) for i, r, k in zip(index, role, key) if i == w} for w in (0, 1))
        if len(a) == len(b):
            assert any(r == spelling.SAME and (r, k) in other for r, k in mine)
        else:
            short, long = (mine, other) if len(a) < len(b) else (other, mine)
            assert {k for r, k in short if r == spelling.SHORT} & {
                k for r, k in long if r == spelling.LONG}


def test_chain_of_forms(spark):
    """The root lies many forms away, and several words end at it."""
    words = ["aaaaa" + "b" * i for i in range(12)]
    df = spark.createDataFrame([(w, 2 ** i) for i, w in enumerate(words)] + [("zzzzz", 7)],
                               "word string, n long")
    got = {r.word: r for r in spelling.variants(df).collect()}
    assert {got[w].root for w in words} == {words[-1]}
    assert got[words[-1]].form is None and got["zzzzz"].root == "zzzzz"
    assert got[words[3]].form == words[4] and got[words[3]].n_near == 2


def test_odd_texts(spark):
    long = "word" * 100_000
    rows = [(1, None, 1), (2, "", 2), (None, "Überaus überaus", 3), (3, long, 4), (3, long, 4),
            (3, long, 4), (4, "ÜBERAUS Überaus x×y÷z abcde1abcde_abcde", 5), (5, " \t ", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long") \
        .selectExpr("*", "'x' as TEXT", "'y' as `a.b`", "'z' as word", "1 as Doc_Id")
    for every in (97, 2):
        got = spelling.variants(spelling.word_counts(docs, drop_every=every)).collect()
        want = plain_variants(plain_words([r[:2] for r in rows], every))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    plain = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert plain == {long: 3, "abcde": 3, "Überaus": 3}          # only A-Z become small
    assert spelling.variants(spelling.word_counts(docs.limit(0))).count() == 0
