"""Operator 11: held-out accuracy, and its parts against plain loops."""

import math
from zlib import crc32

import numpy as np
import pytest

from signalspark.llm import quality as Q

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    df = Q.op11_quality_classifier(spark, sf)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = {r.doc_id: r for r in df.collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) and r.held_out == (crc32(str(d).encode()) % 3 == 1) for d, r in rows.items())
    labels = [(rows[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    for label in (0, 1):
        right = [r.predicted == q for r, q in labels if q == label]
        assert len(right) > 100 and np.mean(right) >= 0.97


def test_only_labels_outside_the_held_out_fold_count(spark, tmp_path):
    rows = [(i, ("Good words in a row. " if i % 2 else "%%% ### ") * (1 + i % 5)) for i in range(200)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    held = lambda i: crc32(str(i).encode()) % 3 == 1
    found = []
    for flip in (False, True):
        labels = [(i, (i + (flip and held(i))) % 2) for i, _ in rows]
        spark.createDataFrame(labels, LABELS).write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
        found.append(sorted(map(tuple, Q.op11_quality_classifier(spark, str(tmp_path)).collect())))
    assert found[0] == found[1] and [r[3] for r in found[0]] == [i % 2 for i, _ in rows]


def test_odd_rows_and_labels(spark):
    texts = [(None, "some words"), (1, None), (2, ""), (3, " \n\t"), (4, "a"), (4, "b b b"), (5, "word " * 300000), (6, "x" * 2500000), (7, "ü\n" * 9)]
    docs = spark.createDataFrame([(d, t, 0.1, 1) for d, t in texts], DOCS + ", score double, label int")
    for labels, prior in (([], 0.5), ([(1, 1), (None, 0), (2, None), (3, 7)], 0.75), ([(1, 0), (1, 0), (2, 1), (4, 1), (4, 0), (99, 1)], None)):
        model = Q.train(docs, spark.createDataFrame(labels, LABELS))
        rows = Q.scored(docs, model).collect()
        assert sorted((r.doc_id for r in rows), key=str) == sorted((d for d, _ in texts), key=str)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        assert prior is None or all(math.isclose(r.score, prior) for r in rows)
    assert Q.scored(spark.createDataFrame([], DOCS), model).collect() == []


def test_log_odds_are_sums_of_table_entries():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(50, 3)).round(1)
    edges = [Q.cuts(x[:, 0], np.ones(50)), np.array([0.0]), np.empty(0)]
    m = Q.Model(edges, 0.3, [rng.normal(size=len(e) + 1) for e in edges], [(0, 1), (1, 2)], [rng.normal(size=(Q.COARSE, Q.COARSE)) for _ in range(2)])
    for row, z in zip(x, m.log_odds(x), strict=True):
        b = [sum(v >= c for c in e) for v, e in zip(row, edges, strict=True)]
        c = [k * Q.COARSE // max(len(e) + 1, Q.COARSE) for k, e in zip(b, edges, strict=True)]
        assert math.isclose(z, 0.3 + sum(m.tables[f][b[f]] for f in range(3)) + sum(t[c[f], c[g]] for (f, g), t in zip(m.pairs, m.pair_tables, strict=True)))


@pytest.mark.parametrize("seed", range(5))
def test_trees_take_the_best_cut(seed):
    rng = np.random.default_rng(seed)
    g, h, n = rng.normal(size=12) * 9, rng.random(12) * 5, rng.integers(0, 20, 12).astype(float)
    gain = lambda a, b: a * a / (b + Q.RIDGE)
    tried = {}
    for k in range(1, 12):
        if min(n[:k].sum(), n[k:].sum()) >= Q.LEAST_LEAF:
            tried[k] = gain(g[:k].sum(), h[:k].sum()) + gain(g[k:].sum(), h[k:].sum()) - gain(g.sum(), h.sum())
    found, k = Q.best_cut(g, h, n)
    assert math.isclose(found, max(tried.values())) and math.isclose(tried[k], found)
    values = Q.small_tree(g, h, n)
    assert 2 <= len(set(values)) <= 3


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(9)
    x = rng.random((2000, 4))
    y = ((x[:, 1] > 0.5) ^ (x[:, 3] > 0.5)).astype(float)
    w = np.ones(2000)
    edges = [Q.cuts(x[:, f], w) for f in range(4)]
    m = Q.Model(edges, 0.0, [])
    b = m.bins(x)
    m.tables = Q.boost_features(b, y, w, [len(e) + 1 for e in edges], 0.0)
    assert ((m.log_odds(x) > 0) == y).mean() < 0.65
    c = Q._coarse_bins(m, b)
    alone = m.log_odds(x)
    gains = Q.pair_gains(c, y, w, alone)
    m.pairs = [max(gains, key=gains.get)]
    assert m.pairs == [(1, 3)]
    m.pair_tables = Q.boost_pairs(c, y, w, alone, m.pairs)
    assert ((m.log_odds(x) > 0) == y).mean() > 0.97


def test_cuts_and_features():
    assert Q.cuts(np.array([3.0, 3.0, 3.0]), np.ones(3)).size == 0
    x = Q.features([b"", b" ", b"A b! a\nA b! a\n"])
    f = dict(zip(Q.FEATURES, x[2], strict=True))
    assert np.isfinite(x).all() and not x[0][: 4 + len(Q.KINDS)].any()
    assert f["distinct_lines"] == 0.5 and f["words_in_line"] == 3 and math.isclose(f["capital"], 2 / 14) and f["top_word"] == 4 / 6
