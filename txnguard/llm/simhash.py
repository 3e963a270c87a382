"""SimHash near-duplicate groups by multi-index hashing.

A fingerprint has one bit per hash bit of the word shingles: 1 where more than half of the shingle
hashes have it. Two texts are linked when their fingerprints differ in at most `max_bits` bits,
and the groups are the connected components of these links.

Finding the links (Norouzi et al., "Fast Exact Search in Hamming Space with Multi-Index Hashing"):
the 64 bits are cut into `segments` parts. Two fingerprints within `max_bits` agree in at least
one part up to max_bits // segments bits, so every fingerprint looks up the small Hamming ball
around each of its parts in a table of parts, and the complete distance of every match is checked.
With two parts and three bits the ball has 33 values of 32 bits, so a lookup stays selective with
billions of fingerprints. Only the lookups of larger values are made: of a pair, one finds the
other.

Equal fingerprints are one node. A part shared by more than `hot_part` distinct fingerprints (a
large group of near copies) is not joined pair by pair: its members and its lookups are dealt into
blocks, each pair of blocks is one bounded task group, and it returns a spanning forest of the
links found there instead of the links. No link is lost, and no group is ever in one task.

Nulls and texts without words have fingerprint zero and are linked like any other. Repeated rows
stay repeated. Rows with a null doc_id join groups but never name one unless nobody else is in it.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnguard.llm.common import (LOWER, pick, plus, settle, slices, small_batches, tidy,
                                 under_safe_names)
from txnguard.llm.components import components

SEED = 42


def simhash(text: bytes, shingle: int) -> int:
    """Unsigned fingerprint of one text."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in
                          zip(starts[:n].tolist(), (ends[k - 1:] - 1).tolist())), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = hashes[at:at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, text: str = "text",
                     name: str = "fp") -> DataFrame:
    """`docs` with the fingerprint as a signed 64-bit integer in column `name`."""
    return under_safe_names(docs, [text], (name,),
                            lambda safe, t: _with_fingerprint(safe, shingle, t, name))


def _with_fingerprint(docs: DataFrame, shingle: int, text: str, name: str) -> DataFrame:
    small_batches(docs.sparkSession)
    kept = docs.columns

    def run(batches):
        for b in slices(batches, 500):
            fp = np.array([simhash(t or b"", shingle) for t in b["__llm_text"].to_pylist()],
                          np.uint64)
            yield pa.RecordBatch.from_arrays([b[c] for c in kept] + [pa.array(fp.view(np.int64))],
                                             names=[*kept, name])

    return (docs.select(*kept, F.col(text).cast("binary").alias("__llm_text"))
            .mapInArrow(tidy(run), plus(docs, kept, f"{name} long")))


def _parts(segments: int) -> list[tuple[int, int, int]]:
    """(number, shift, width) of the parts of the 64 bits."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(i, lo, hi - lo) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]))]


def _part_value(shift: int, width: int):
    v = F.shiftrightunsigned("fp", shift)
    return v if width == 64 else v.bitwiseAND(F.lit((1 << width) - 1))


def _ball(width: int, radius: int) -> list[int]:
    """Bit masks of every change of at most `radius` bits."""
    return [sum(1 << b for b in bits) for r in range(radius + 1)
            for bits in combinations(range(width), r)]


def _forest(pdf: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    """Links that connect what the lookups and the members of one pair of blocks connect."""
    probes = pdf.loc[pdf["probe"], "fp"].to_numpy(np.int64).view(np.uint64)
    table = pdf.loc[~pdf["probe"], "fp"].to_numpy(np.int64).view(np.uint64)
    label = np.arange(len(table))
    a, b = [], []
    for p in probes:
        near = np.flatnonzero(np.bitwise_count(table ^ p) <= max_bits)
        if len(near):
            groups, first = np.unique(label[near], return_index=True)
            a += [p] * len(groups)
            b += table[near[first]].tolist()
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    return pd.DataFrame({"a": np.array(a, np.uint64).view(np.int64),
                         "b": np.array(b, np.uint64).view(np.int64)})


def links(nodes: DataFrame, max_bits: int = 3, segments: int = 2, hot_part: int = 256,
          block: int = 4096) -> DataFrame:
    """(a, b) between distinct fingerprints of `nodes` (fp): within `max_bits` of each other, and
    enough of them that their components are those of all such pairs."""
    if max_bits >= 64:
        raise ValueError("max_bits must be below 64")
    radius = max_bits // segments
    members, probes = None, None
    for i, shift, width in _parts(segments):
        value = _part_value(shift, width)
        m = nodes.select("fp", F.lit(i).alias("part"), value.alias("key"))
        masks = F.array(*[F.lit(x if x < 1 << 63 else x - (1 << 64)).cast("long")
                          for x in _ball(width, radius)])
        p = (nodes.select("fp", F.lit(i).alias("part"), value.alias("own"),
                          F.explode(masks).alias("mask"))
             .select("fp", "part", F.col("own").bitwiseXOR(F.col("mask")).alias("key"),
                     (F.col("mask") == 0).alias("same"), "own")
             .filter("key >= own").drop("own"))
        members = m if members is None else members.unionByName(m)
        probes = p if probes is None else probes.unionByName(p)
    sized = members.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = settle(sized.filter(F.col("n") > hot_part), "hot-parts")
    near = F.bit_count(F.col("p.fp").bitwiseXOR(F.col("t.fp"))) <= max_bits
    ordered = ~F.col("p.same") | (F.col("p.fp") < F.col("t.fp"))
    on = (F.col("p.part") == F.col("t.part")) & (F.col("p.key") == F.col("t.key"))
    if hot.isEmpty():
        table = members
    else:
        table = members.join(hot.select("part", "key"), ["part", "key"], "left_anti")
    found = (probes.alias("p").join(table.alias("t"), on & ordered & near)
             .select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b")))
    if hot.isEmpty():
        return found
    # shared parts: blocks of lookups against blocks of members
    hot_probes = probes.join(hot, ["part", "key"])
    n_probes = hot_probes.groupBy("part", "key").agg(F.count(F.lit(1)).alias("np"))
    deal = (hot.join(n_probes, ["part", "key"])
            .select("part", "key", F.ceil(F.col("n") / block).cast("int").alias("tb"),
                    F.ceil(F.col("np") / block).cast("int").alias("pb")))
    h = F.xxhash64("fp")
    p = (probes.join(deal, ["part", "key"])
         .select("part", "key", "fp", F.pmod(h, "pb").cast("int").alias("i"),
                 F.explode(F.sequence(F.lit(0), F.col("tb") - 1)).alias("j"),
                 F.lit(True).alias("probe")))
    t = (members.join(deal, ["part", "key"])
         .select("part", "key", "fp", F.explode(F.sequence(F.lit(0), F.col("pb") - 1)).alias("i"),
                 F.pmod(h, "tb").cast("int").alias("j"), F.lit(False).alias("probe")))
    in_blocks = (p.unionByName(t).groupBy("part", "key", "i", "j")
                 .applyInPandas(lambda pdf: _forest(pdf, max_bits), "a long, b long"))
    return found.unionByName(in_blocks)


def groups(marks: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """(fp, root, component_id) for each fingerprint of `marks` (doc_id, fp): root is the smallest
    fingerprint of the group, component_id its smallest doc_id."""
    nodes = settle(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits, segments))
    named = (nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, segments: int = 2,
                    text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fp, fingerprint, component_id), one row per input row. component_id is the
    smallest doc_id that links lead to."""
    rows = pick(docs, id_col, text).toDF("doc_id", "t")
    marks = settle(with_fingerprint(rows, shingle, "t").drop("t"), "fingerprints")
    return marks.join(groups(marks, max_bits, segments), "fp").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, segments: int = 2,
             text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One document of each group: the one with the smallest id (nulls last); of rows that repeat
    that id and fingerprint, the one with the smallest text. Columns keep their names."""
    return under_safe_names(docs, [text, id_col], (), lambda safe, t, i: _keep_one(
        safe, shingle, max_bits, segments, t, i))


def _keep_one(docs: DataFrame, shingle: int, max_bits: int, segments: int, text: str,
              id_col: str) -> DataFrame:
    body = F.struct(*[F.col(c) for c in docs.columns])
    rows = docs.select(body.alias("row"), F.col(id_col).alias("doc_id"), F.col(text).alias("t"))
    marked = settle(with_fingerprint(rows, shingle, "t").drop("t"), "marked")
    marks = marked.select("doc_id", "fp")
    winners = (marks.join(groups(marks, max_bits, segments), "fp").groupBy("root")
               .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp"))
                    .alias("w"))
               .select(_key(F.col("w.doc_id")).alias("key"), F.col("w.fp").alias("won")))
    first = Window.partitionBy("key", "fp").orderBy(F.col(f"row.{text}"))
    return (marked.withColumn("key", _key(F.col("doc_id"))).join(winners, "key")
            .filter("fp = won").withColumn("nth", F.row_number().over(first))
            .filter("nth = 1").select("row.*"))


def _key(doc_id):
    return F.coalesce(doc_id.cast("string"), F.lit("null"))
