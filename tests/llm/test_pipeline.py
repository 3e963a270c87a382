"""The corpus pipeline, stage by stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.conftest import SF_SMALL
from tests.llm.test_brute_force import plain_simhash, roots
from txnguard.llm.queries import QUERIES
from txnguard.sources.tables import read_table


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF_SMALL, "documents"), []
    for name, stage in cp.STAGES:
        after = cp.settle(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_return_the_columns_of_documents(stages):
    for name, (before, after) in stages.items():
        if name != "bpe":
            assert after.dtypes == before.dtypes, name
    assert {"doc_id", "lang", "n_tokens", "ids", "ids_sha256"} <= set(stages["bpe"][1].columns)


def test_toxic_documents_go(spark, stages):
    scored = QUERIES["op9_toxicity"](spark, SF_SMALL).filter("predicted = 0")
    assert ids(stages["toxicity"][1]) == ids(scored)


def test_one_of_each_group_stays(stages):
    rows = sorted((r.doc_id, plain_simhash(r.text)) for r in stages["simhash_dedup"][0].collect())
    pairs = [(a, b) for a in range(len(rows)) for b in range(a)
             if (rows[a][1] ^ rows[b][1]).bit_count() <= 3]
    group = roots(len(rows), pairs)
    assert ids(stages["simhash_dedup"][1]) == sorted(rows[r][0] for r in set(group))


def test_contaminated_documents_go(spark, stages):
    clean = QUERIES["op5_decontamination"](spark, SF_SMALL).filter("not contaminated")
    assert ids(stages["decontaminate"][1]) == sorted(
        set(ids(clean)) & set(ids(stages["decontaminate"][0])))


def test_private_data_goes(spark, stages):
    before, after = stages["pii"]
    assert ids(before) == ids(after)
    assert after.filter(F.col("n_chars") != F.length("text")).count() == 0
    want = {r.doc_id: r.text for r in QUERIES["op6_pii"](spark, SF_SMALL).collect()}
    assert all(want[r.doc_id] == r.text for r in after.collect())


def test_tokens(stages):
    before, after = stages["bpe"]
    joined = after.join(before, "doc_id")
    assert joined.count() == before.count() == after.count()
    assert joined.filter(F.sha2(F.col("text").cast("binary"), 256)
                         != F.col("decoded_sha256")).count() == 0
    assert after.filter(F.size("ids") != F.col("n_tokens")).count() == 0


def test_odd_rows_through_all_stages(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame(
        [(1, None, 1, "x", "y", None), (None, text, 1, "x", "y", 3), (None, text, 1, "x", "y", 3),
         (2, "", 1, "x", "y", 0), (3, "w " * 50_000, 1, "x", "y", 7), (3, "w " * 50_000, 1, "x", "y", 7),
         (4, "card 4111111111111111", 1, "x", "y", 21)],
        "doc_id long, text string, score int, predicted string, rest string, n_chars long")
    for rows in (docs, docs.limit(0)):
        df = rows
        for name, stage in cp.STAGES:
            after = stage(spark, df, SF_SMALL)
            if name != "bpe":
                assert after.columns == docs.columns, name
            df = cp.settle(after, "test-odd")
        got = sorted((r.doc_id or -1) for r in df.collect())
        assert got == ([-1, 1, 3, 4] if rows is docs else [])


def test_run_equals_the_stages(spark, stages):
    assert sorted(cp.run(spark, SF_SMALL).select("doc_id", "ids_sha256").collect()) == sorted(
        stages["bpe"][1].select("doc_id", "ids_sha256").collect())
