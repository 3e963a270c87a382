"""The Merkle manifest against a plain recursion, with trees of several tiers and odd rows."""

import zlib
from hashlib import sha256

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from txnguard.llm import merkle
from txnguard.llm.queries import QUERIES

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, TEXT string, "
          "`a.b` string, grp string, pos string, digest string, Lang int, n int")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes, fanout):
    """(top, proof of each node as a list of (left, right))."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // fanout * fanout
            proofs[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + fanout])))
        nodes = [h("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], proofs


def plain(rows, fanout, tamper):
    """rows: (doc_id, source, lang, n_chars, text); the expected result rows."""
    groups = {}
    for r in rows:
        groups.setdefault("" if r[2] is None else "=" + r[2], []).append(r)
    keys = sorted(groups, key=lambda k: k.encode())
    subs = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subs[k] = tree([leaf(r) for r in groups[k]], fanout)
    root, tops = tree([subs[k][0] for k in keys], fanout)
    out = []
    for k, top in zip(keys, tops):
        for r, path in zip(groups[k], subs[k][1]):
            path = path + top
            x = leaf(tamper(r))
            for a, b in path:
                x = h(a + x + b)
            out.append((r[0], leaf(r), subs[k][0], root, h("".join(a + b for a, b in path)), x,
                        x == root))
    return sorted(map(str, out))


def lowered(r):
    if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 or r[4] is None:
        return r
    return (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))


def test_query_equals_recursion(spark):
    d = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in d[FIELDS].itertuples(index=False)]
    got = QUERIES["op11_merkle"](spark, SF_SMALL).collect()
    assert sorted(str(tuple(r)) for r in got) == plain(rows, 8, lowered)
    assert 0 < sum(r.verified for r in got) < len(got)


@pytest.mark.parametrize("fanout,levels", [(2, 1), (3, 2), (8, 4)])
def test_odd_rows_and_several_tiers(spark, fanout, levels):
    rows = [(i, "s", f"l{i % 3 // 2}", i, f"Text {i} Ä") for i in range(60)]
    rows += [(None, None, None, None, None), (None, "x", "de", 3, "A"), (5, "s", "l0", 5, "B"),
             (5, "s", "l0", 5, "B"), (2**60 + 1, "", "", 0, ""), (2**60 + 2, "s", "", None, "Z"),
             (7, "s", None, 1, "N" * 300_000), (9, "ü", "ü", 1, "é:1"), (None, "x", "de", 3, "A")]
    rows += [(100 + i, "s", f"m{i:03d}", 1, "X") for i in range(40)]        # many groups
    df = spark.createDataFrame(
        [(r[0], r[4], r[2], r[1], r[3], "E", "x", "g", "p", "d", 1, 2) for r in rows], SCHEMA)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = merkle.manifest(
        df, FIELDS, received={"text": F.when(chosen, F.translate(
            "text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            .otherwise(F.col("text"))}, fanout=fanout, levels=levels, with_proof=True).collect()
    assert sorted(str((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root,
                       r.verified)) for r in got) == plain(rows, fanout, lowered)
    for r in got:                                  # the proofs themselves lead to the root
        assert merkle.fold(r.leaf, r.lefts, r.rights) == r.root
    assert merkle.manifest(df.limit(0), FIELDS, fanout=fanout, levels=levels).count() == 0


def test_hot_group_is_spread(spark):
    """One group with all rows, many of them equal: no range partition holds most of them."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("ord"),
        F.lit("=x").alias("grp"), F.lit("d").alias("digest"))
    out = merkle.numbered(df, "t").select("pos", "n", F.spark_partition_id().alias("p"))
    assert out.agg(F.count_distinct("pos"), F.min("pos"), F.max("pos"), F.max("n")).first() == (
        20_000, 0, 19_999, 20_000)
    nodes = df.withColumn("_row", F.monotonically_increasing_id())
    sizes = (nodes.repartitionByRange(8, "grp", "ord", "digest", "_row")
             .groupBy(F.spark_partition_id()).count().collect())
    assert max(r["count"] for r in sizes) < 2 * 20_000 / 8
