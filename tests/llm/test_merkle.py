"""Operator 12 against a plain tree."""

from hashlib import sha256
from itertools import groupby
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from signalspark.llm import merkle as M

ROWS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, i):
    """(left, hash or None) from the bottom up."""
    out = []
    for level in tree[:-1]:
        out.append((i % 2 == 1, level[i ^ 1] if i ^ 1 < len(level) else None))
        i //= 2
    return out


def brute(rows):
    """Contract rows of (doc_id, source, lang, n_chars, text) rows."""
    entries = []
    for d, source, lang, n, text in rows:
        hit = d is not None and crc32(str(d).encode()) % 7 == 0 and n is not None
        own = leaf(d, source, lang, n, text)
        entries.append(((lang is not None, (lang or "").encode()), (d is not None, d or 0), own, leaf(d, source, lang, n + 1, text) if hit else own, d))
    entries.sort(key=lambda e: e[:4])
    groups = [list(g) for _, g in groupby(entries, key=lambda e: e[0])]
    trees = [levels([e[2] for e in g]) for g in groups]
    top = levels([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for i, (_, _, own, now, d) in enumerate(group):
            steps = siblings(tree, i) + siblings(top, k)
            for left, other in steps:
                now = h(now) if other is None else h(other, now) if left else h(now, other)
            out.append((d, own, tree[-1][0], top[-1][0], h(*(x for _, x in steps if x)), now, now == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fold", [2, 10])
def test_whole_table_equal_to_plain_tree(spark, fold):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([tuple(r) for r in docs.select(*M.FIELDS).collect()])
    assert got(M.proofs(M.build_manifest(docs, fold))) == want
    assert 0 < sum(not r[-1] for r in want) < len(want) / 4


@pytest.mark.parametrize("fold", [1, 3])
def test_odd_rows(spark, fold):
    rows = [(None, None, None, None, None), (None, "s", None, 3, "abc"), (7, "s", "en", None, None), (7, "s", "en", 4, "é" * 4), (7, "s", "en", 4, "é" * 4)]
    rows += [(i, "s|1:", "de" if i % 3 else "", i, "t" * i) for i in range(-3, 40)] + [(99, None, "zz", 2**63 - 1, ""), (2**62, "s", "ü", 1, "long " * 200000)]
    rows += [(i, None, f"lang{i}", 0, "") for i in range(20)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS + ", grp string, place long")
    assert got(M.proofs(M.build_manifest(df, fold))) == brute(rows)


def test_one_leaf_and_none(spark, tmp_path):
    for rows in ([(7, "s", "en", 1, "a")], []):
        spark.createDataFrame(rows, ROWS).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert got(M.op12_merkle_manifest(spark, str(tmp_path))) == brute(rows)


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 8, 21])
def test_octopus_is_enough_and_minimal(rows):
    tree = levels([h(str(i)) for i in range(rows)])
    nodes = {(k, i): x for k, level in enumerate(tree) for i, x in enumerate(level)}
    for known in ([0], [rows - 1], list(range(rows)), list(range(0, rows, 3)), list(range(rows // 3, rows // 2 + 1))):
        wanted = M.missing(known, rows)
        have = {(0, i): tree[0][i] for i in known} | {c: nodes[c] for c in wanted}
        made = M.derive(dict(have), known, rows)
        assert made[len(tree) - 1, 0] == tree[-1][0]
        needed = {c for i in known for k in range(len(tree) - 1) if (c := (k, (i >> k) ^ 1))[1] < len(tree[k])}
        derived = {(k, i >> k) for i in known for k in range(len(tree))}
        assert sorted(wanted) == sorted(needed - derived)
        assert all(M.fold(tree[0][i], M.path(made, i, rows)) == tree[-1][0] for i in known)


def test_partitions_fetch_each_coordinate_once(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    m = M.build_manifest(docs, 4)
    wanted = m.wanted.collect()
    # 63 partitions of 16 leaves, six levels above them; a lone node has no sibling.
    assert len(wanted) == len(set(wanted)) and len(wanted) <= 63 * 6 and min(r.level for r in wanted) == 4
