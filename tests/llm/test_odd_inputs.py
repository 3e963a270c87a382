"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from txnguard.llm import (bpe, decontam, pii, simhash, substrings, token_store, topk, toxicity,
                          urls, warc)
from txnguard.llm.queries import URL_RULES, vocabulary_path

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again until night falls", "a"),
    (2, None, "b"),
    (3, "", "c"),
    (4, LONG, "d"),
    (5, "the quick brown fox jumps over the lazy dog again and again until night falls", "e"),
    (5, "the quick brown fox jumps over the lazy dog again and again until night falls", "e"),
    (None, "no id at all", None),
    (None, None, None),
    (6, " \t\n", "f"),
]
CLASH = ("doc_id long, text string, source string, fp long, n_words long, n_hit long, items string, "
         "spans string, score string, predicted string, n_tokens string, ids string, "
         "n_private string, block string, _t string, _k string, row string, key string, won string")


@pytest.fixture(scope="module")
def docs(spark):
    extra = len(CLASH.split(",")) - 3
    return spark.createDataFrame([(*r, 7, 8, 9, *["x"] * (extra - 3)) for r in ROWS], CLASH)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_simhash(docs, none):
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in
           simhash.near_duplicates(docs).collect()}
    by_id = {r[0]: r for r in got}
    assert by_id[1][1:] == by_id[5][1:] and by_id[5][2] == 1
    zero = [r for r in got if r[1] == "0" * 16]
    assert {r[0] for r in zero} == {2, 3, 6, None} and {r[2] for r in zero} == {2}
    assert simhash.near_duplicates(docs).count() == len(ROWS)
    assert simhash.near_duplicates(none).count() == 0


def test_keep_one(docs, none, spark):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 4]
    assert simhash.keep_one(none).count() == 0
    no_ids = spark.createDataFrame([(None, "same text here"), (None, "same text here")],
                                   "doc_id long, text string")
    assert simhash.keep_one(no_ids).count() == 1


def test_decontamination(docs, none, spark):
    bench = spark.createDataFrame(
        [(1, "Quick, brown FOX", "z"), (1, "Quick, brown FOX", "z"), (2, None, "z"),
         (3, " .. ", "z"), (None, "lazy dog", "z")], "item_id long, text string, spans string")
    out = decontam.contamination(docs, bench)
    assert set(out.columns) == set(docs.columns)
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].items) == (15, 5, ["1"])
    assert [ROWS[0][1][a:b] for a, b in got[1].spans] == ["quick brown fox", "lazy dog"]
    assert got[2].n_words == 0 and got[4].n_words == 60_000
    assert decontam.contamination(none, bench).count() == 0
    assert decontam.contamination(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    long = spark.createDataFrame([(1, "- x ." * 300_000 + " lazy dog"), (2, "lazy " * 200_000)],
                                 "doc_id long, text string")
    got = [(r.n_words, r.n_hit) for r in decontam.contamination(long, bench).orderBy(
        "doc_id").collect()]
    assert got == [(300_002, 2), (200_000, 0)]


def test_pii(docs, none):
    out = pii.pseudonymise(docs, "k")
    assert set(out.columns) == set(docs.columns)
    assert (sorted((str(r.doc_id), str(r.text)) for r in out.collect())
            == sorted((str(r[0]), str(r[1])) for r in ROWS))
    assert pii.pseudonymise(none, "k").count() == 0


def test_token_store(docs, none):
    files, dictionary = token_store.write_tokens(docs, vocabulary_path())
    got = token_store.read_tokens(files, dictionary).orderBy("start").collect()
    assert len(got) == len(ROWS)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert [r.doc_id for r in got] == [None, None, "1", "2", "3", "4", "5", "5", "6"]
    assert got[3].n_tokens == got[4].n_tokens == 1
    files, dictionary = token_store.write_tokens(none, vocabulary_path())
    assert token_store.read_tokens(files, dictionary).count() == 0


def test_bpe(docs, none):
    out = bpe.encode_decode(docs, vocabulary_path())
    assert {"ids", "n_tokens", "source", "row"} <= set(out.columns)
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[2].ids == by_id[3].ids == []
    assert by_id[4].decoded_sha256 == hashlib.sha256(LONG.encode()).hexdigest()
    assert bpe.encode_decode(none, vocabulary_path()).count() == 0


def test_toxicity(docs, none, spark):
    labels = spark.createDataFrame([(1, 1, "x"), (1, 0, "x"), (4, 0, "x"), (None, 1, "x"),
                                    (5, None, "x")], "doc_id long, toxic int, text string")
    for d, lab in ((docs, labels), (docs, labels.limit(0)), (none, labels)):
        model = toxicity.fit(d, lab)
        out = toxicity.score(d, model)
        assert set(out.columns) == set(docs.columns)
        assert out.count() == d.count()
        assert out.filter("score is null or score < 0 or score > 1").count() == 0


def test_substrings(docs, none):
    got = substrings.remove_repeats(docs)
    rows = {(r.doc_id, r.n_words, r.n_removed) for r in got.collect()}
    assert rows == {(1, 15, 0), (2, 0, 0), (3, 0, 0), (4, 60_000, 0), (5, 15, 15), (None, 4, 0),
                    (None, 0, 0), (6, 0, 0)}
    assert got.count() == len(ROWS)
    assert substrings.remove_repeats(none).count() == 0


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    raw = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [None, 1.0]), (4, [nan, 1.0]),
         (5, [inf, 1.0]), (6, None), (7, []), (8, [0.0, 0.0]), (9, [2.0]), (9, [2.0]),
         (None, [9.0, 9.0]), (10, [-1.0, 3e30])], "id long, e array<double>")
    v = raw.select("id", topk.whole_components(F.col("e")).alias("v"))
    got = topk.top_k(v, v, k=3).collect()
    best = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        best.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert best[0] == [(9, 131072), (9, 131072), (1, 65536)]    # every row is a candidate
    assert best[7] == [(0, 0), (1, 0), (2, 0)]
    assert set(best) == {0, 1, 2, 7, 8, 9, 10}
    assert topk.top_k(v.limit(0), v).count() == 0
    assert topk.top_k(v, v.limit(0)).count() == 0
    assert topk.top_k(v.filter("id < 2"), v, k=5).filter("query_id = 0").count() == 1
    again = spark.createDataFrame([(0, [1]), (1, [5]), (1, [9]), (2, [7])],
                                  "id long, v array<long>").selectExpr("*", "'x' as ID")
    got = topk.top_k(again, again.filter("v[0] = 1"), k=5)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(1, 9), (2, 7), (1, 5)]


def test_vectors_go_only_where_they_are_needed(spark):
    """Short vectors reach no query block whose queries need long ones."""
    rows = [(i, [int(1.06 ** (i % 200)) + 1, i % 7]) for i in range(4000)]
    v = spark.createDataFrame(rows, "id long, v array<long>")
    p, q, sizes = topk._prepared(v, v.filter("id % 2 = 0"), 5, 100, 64, 1.05)
    _, dealt = topk._dealt(p, q, sizes)
    blocks = q.select("qb").distinct().count()
    assert blocks >= 15 and dealt.count() < 0.5 * 4000 * blocks
    got = topk.top_k(v, v.filter("id % 400 = 0"), block=100, seeds=64).collect()
    for query in range(0, 4000, 400):
        want = sorted(((-sum(a * b for a, b in zip(rows[query][1], x)), i)
                       for i, x in rows if i != query))[:5]
        assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])
                if r.query_id == query] == want


ODD_NAMES = ["Score", "N_TOKENS", "__one", "a.b", "rest", "N_HIT", "FP", "n_private", "_c0",
             "`q`", "text two", "Component_Id"]


def test_clashing_names_in_every_operator_and_stage(spark):
    """Names that differ from new columns in case only, hold a dot or a quote, or look like helpers."""
    import corpus_pipeline

    rows = [(1, "a b c d one two", 5), (2, None, None), (2, "call +44 20 7946 0958", 3)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    odd = plain.select("*", *[F.lit(i) for i in range(len(ODD_NAMES))]).toDF(
        "doc_id", "text", "n_chars", *ODD_NAMES)
    bench = spark.createDataFrame([(1, "zz yy", 0)], "item_id long, text string, `a.b` int")
    labels = spark.createDataFrame([(1, 1, 2)], "doc_id long, toxic int, `x.y` int")

    def told(df, *new):
        low = {n.lower() for n in new}
        assert [c for c in df.columns if c.lower() not in low] == [
            c for c in odd.columns if c.lower() not in low]
        assert df.count() == 3
    told(decontam.contamination(odd, bench), "n_words", "n_hit", "items", "spans")
    told(pii.pseudonymise(odd, "k"), "n_private")
    told(bpe.encode_decode(odd, vocabulary_path()), "n_tokens", "ids", "ids_sha256",
         "decoded_sha256")
    model = toxicity.fit(odd, labels)
    told(toxicity.score(odd, model), "score", "predicted")
    assert simhash.keep_one(odd).columns == odd.columns
    assert simhash.near_duplicates(odd).count() == 3
    assert substrings.remove_repeats(odd).count() == 3
    files, dictionary = token_store.write_tokens(odd, vocabulary_path())
    assert token_store.read_tokens(files, dictionary).count() == 3
    for stage in (corpus_pipeline.hide_private,):
        out = stage(spark, odd, "")
        assert out.columns == odd.columns and out.count() == 3
    apart = corpus_pipeline._apart(odd)
    assert sorted(map(str, corpus_pipeline._together(apart, odd.columns).collect())) == sorted(
        map(str, odd.collect()))
    pages = spark.createDataFrame([(1, "http://a/", "x", 1, 2), (2, None, None, 1, 2)],
                                  "page_id long, url string, html string, `p.q` int, PAGE int")
    assert warc.write_archive(pages).count() == 2
    empty_id = spark.createDataFrame([("", "u", "y" * 200), ("b", "u", "y" * 200)],
                                     "page_id string, url string, html string")
    index = {r.page_id: r.record_type for r in warc.write_archive(empty_id).collect()}
    read = {r.page_id: r.record_type for r in
            warc.read_records(warc.write_archive(empty_id)).collect()}
    assert index == read == {"": "response", "b": "revisit"}

def test_warc(spark):
    big = "x" * 200
    pages = spark.createDataFrame(
        [(3, "http://a/ b\n", big, 1), (1, None, big, 1), (2, "http://ü/", big, 1),
         (1, None, big, 1), (4, "", None, 1), (5, "u", "", 1), (None, "u", big, 1),
         (6, "u", "short", 1), (7, "u", "short", 1)],
        "page_id long, url string, html string, digest int")
    index = warc.write_archive(pages)
    assert index.count() == 9
    got = sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes,
                  bytes(r.payload).decode() if r.payload is not None else None)
                 for r in warc.read_records(index).collect())
    assert got == sorted([("3", "revisit", "1", 200, None), ("1", "response", None, 200, big),
                          ("2", "revisit", "1", 200, None), ("1", "response", None, 200, big),
                          ("4", "response", None, 0, ""), ("5", "response", None, 0, ""),
                          ("None", "revisit", "1", 200, None),
                          ("6", "response", None, 5, "short"), ("7", "response", None, 5, "short")])
    one = warc.read_records(index.filter("page_id = '6'")).collect()
    assert [bytes(r.payload) for r in one] == [b"short"]
    assert warc.read_records(warc.write_archive(pages.limit(0))).count() == 0


def test_coalesced_reads():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 100, 5), ("a", 500, 5), ("b", 505, 5)]
    assert warc.coalesced(rows, max_gap=90, max_read=1000) == [
        ["a", 0, 105, [0, 1, 2]], ["a", 500, 505, [3]], ["b", 505, 510, [4]]]
    assert [r[3] for r in warc.coalesced(rows, max_gap=90, max_read=20)] == [[0, 1], [2], [3], [4]]


def test_urls(spark):
    pages = spark.createDataFrame(
        [(1, "http://Www.Example.ORG/en/12?x", 1), (2, None, 0), (3, "no scheme", None),
         (4, "x://com/de/a#b", None), (5, "http://sub.com/fr/?q", 1), (6, "http://h", 1),
         (7, "http://a?u=http://com/de/", 0), (7, "http://a?u=http://com/de/", 0),
         (8, "http://xcom/de/", 0)], "page_id long, url string, host int")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in
           urls.judge(pages, URL_RULES, F.col("host")).collect()}
    rows = {r[0]: r for r in got}
    assert rows[1][1:] == ("www.example.org", "/en/12", "example.org/en/1", "block")
    assert rows[2][1:4] == ("", "", None) and rows[3][1:4] == ("", "", None)
    assert rows[4][1:] == ("com", "/de/a", "com/de/", "block")
    assert rows[5][1:] == ("sub.com", "/fr/", "com/fr/", "allow")
    assert rows[6][1:4] == ("h", "", None)
    assert rows[7][1:4] == ("a", "", None) and rows[8][3] is None
    assert urls.judge(pages, URL_RULES, F.col("host")).count() == 9
    assert urls.judge(pages.limit(0), URL_RULES, F.col("host")).count() == 0


def test_reputation_shrinks(spark):
    rows = ([("bad.x.org", 1)] * 60 + [("few.x.org", 1)] * 1 + [("good.x.org", 0)] * 60
            + [("new.bad.net", None)] + [("www.bad.net", 1)] * 80 + [("h.fine.net", 0)] * 80
            + [("1.2.3.4:80", 0), ("u@shop.co.uk.", 0)])
    got = {r.host: r for r in urls.reputation(
        spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["bad.x.org"].verdict == "block" and got["good.x.org"].verdict == "allow"
    assert got["few.x.org"].verdict == "allow"          # one page is not enough
    assert got["few.x.org"].bad_mean < got["bad.x.org"].bad_mean
    assert got["new.bad.net"].n == 0 and got["new.bad.net"].bad_mean > 0.5
    parts = spark.createDataFrame([("1.2.3.4:80",), ("u@shop.co.uk.",), ("a.b.c.de",)], "h string")
    bare = urls.bare_host(F.col("h"))
    assert [tuple(r) for r in parts.select(urls.domain_of(bare), urls.suffix_of(bare)).collect()
            ] == [("1.2.3.4", ""), ("shop.co.uk", "co.uk"), ("c.de", "de")]
