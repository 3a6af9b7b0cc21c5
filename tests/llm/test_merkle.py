"""Merkle manifest against a plain fold over all rows, and its SQL."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tagweave.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, text, lang, source, n = row
    fields = (doc_id, source, lang, None if n is None else n + more, text)
    return h("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """All levels of a tree, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h("".join(low[i:i + 2])) for i in range(0, len(low), 2)])
    return levels


def steps(levels, i):
    """Siblings ('' if none) and whether they lie left, from leaf ``i`` to the top."""
    out = []
    for low in levels[:-1]:
        out.append((low[i ^ 1] if i ^ 1 < len(low) else "", i % 2 == 1))
        i //= 2
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = lambda x: (x is not None, x if x is not None else 0)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang, members in groups.items():
        members.sort(key=lambda r: (order(r[0]), leaf_of(r)))
        trees[lang] = tree([leaf_of(r) for r in members])
    top = tree([trees[x][-1][0] for x in langs]) if langs else None
    out = []
    for g, lang in enumerate(langs):
        for i, r in enumerate(groups[lang]):
            path = steps(trees[lang], i) + steps(top, g)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf_of(r, int(hit))
            for sibling, left in path:
                node = h(sibling + node if left else node + sibling)
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[lang][-1][0], root, h("".join(s for s, _ in path)), node, node == root))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, merkle.document_proofs(df).select(*cols).collect()), key=repr)


LANGS = ["en", "fr", None, "", "-", "é", "z"]


@pytest.mark.parametrize("n", [1, 700])
def test_equals_brute_force(spark, n):
    rows = [(i * 37 % 1009, f"text {i} é" * (i % 5), LANGS[i % 11 % 7], f"s{i % 3}" if i % 4 else None, i if i % 6 else None) for i in range(n)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_long_texts_and_a_hot_group(spark):
    rows = [(None, None, None, None, None)] * 3 + [(5, "a", "en", "s", 1)] * 4 + [(5, t, "en", "s", 1) for t in ("b", "", None)]
    rows += [(i, "x" * 300_000 if i == 7 else "y", "en", "s", 1) for i in range(7, 1200)]
    got = run(spark, rows)
    assert got == brute(rows) and any(not r[-1] for r in got)


def test_tampering_is_seen_and_only_there(spark):
    rows = [(i, f"t{i}", "en", "s", None if i % 50 == 0 else i) for i in range(300)]
    for doc_id, *_, verified in run(spark, rows):
        hit = zlib.crc32(str(doc_id).encode()) % 7 == 0 and doc_id % 50 != 0
        assert verified == (not hit)


def test_empty_and_clashing_columns(spark):
    assert merkle.document_proofs(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, f"t{i}", LANGS[i % 3], "s", i) for i in range(20)]
    names = ("_g", "_k", "_node", "_pos", "leaf", "root", "path", "a.b", "_rest")
    more = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in names])
    assert sorted(map(tuple, merkle.document_proofs(more).collect()), key=repr) == brute(rows)


def test_only_every_span_th_level_is_stored(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), F.lit("g").alias("g"))
    m = merkle.build(df, F.col("g"), F.col("k"), merkle.leaf(F.col("k")), {"kept": F.col("k") * 2})
    assert [t.count() for t in m.groups] == [20, 1] and len(m.top) == 1
    assert max(r[0] for t in m.groups for r in t.select(F.size("_items")).collect()) <= 1 << merkle.SPAN
    p = merkle.proofs(m).where(merkle.fold(F.col("leaf"), F.col("path")) == F.col("root"))
    assert p.where("kept = key * 2 AND size(path) = 13").count() == 5000
