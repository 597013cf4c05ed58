"""Near-duplicate vectors against all pairs."""

import numpy as np
import pyarrow as pa
import pytest

from signalspark.llm.vector_dedup import RECALL, near_duplicate_vectors, passes_for
from tests.llm import brute


def all_pairs(rows, threshold=0.95):
    """{row number: (links, component)} by brute force; ids are unique."""
    ok = [(i, np.array(v, np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    links = []
    for k, (i, x) in enumerate(ok):
        for j, y in ok[:k]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.append((i, j))
    comp = brute.components([i for i, _ in rows], links)
    n = {i: 0 for i, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    return {i: (n[i], comp[i], comp[i] == i) for i, _ in rows}


def test_equal_to_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 24))
    rows = [(10 + i, v.tolist()) for i, v in enumerate(base)]
    for i in range(120):  # near copies of the first, more than a window holds, and pairs
        rows.append((1000 + i, (base[0] + rng.normal(size=24) * 0.05).tolist()))
    for i in range(1, 20):
        rows.append((2000 + i, (base[i] * 3 + rng.normal(size=24) * 0.05).tolist()))
    rows += [(3000 + i, base[25].tolist()) for i in range(8)]
    rows += [(1, None), (2, []), (3, [0.0] * 24), (4, [float("nan")] + [1.0] * 23), (5, [float("inf")] * 24), (6, [None] + [1.0] * 23), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1e-200] * 24), (0, [1e200] * 24)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cls int").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(df).collect()}
    want = all_pairs([(i, v) for i, v in rows if i not in (0, 9)])
    assert {i: got[i] for i in want} == want
    assert got[0] == (1, 0, True) and got[9] == (1, 0, False)


def test_whole_table_finds_nine_in_ten_links(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = {r.vec_id: r.n_links for r in near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert len(got) == len(rows)
    assert all(got[i] <= n for (i, _), n in zip(rows, want.tolist(), strict=True))
    assert sum(got.values()) >= 0.9 * want.sum()


def test_null_ids_repeated_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, near_duplicate_vectors(df).collect()), key=str) == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, None)]
    assert near_duplicate_vectors(df.limit(0)).collect() == []


def test_ids_shared_by_different_vectors(spark):
    rows = [(5, [1.0, 0.0, 0.0]), (5, [0.0, 1.0, 0.0]), (6, [1.0, 0.1, 0.0]), (7, [0.0, 1.0, 0.1]), (8, [0.0, 0.0, 1.0]), (8, [0.0, 0.0, 2.0]), (8, [1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = [(5, 1, 5, True), (5, 1, 5, True), (6, 1, 5, False), (7, 1, 5, False), (8, 0, 8, True), (8, 1, 8, True), (8, 1, 8, True)]
    assert sorted(map(tuple, near_duplicate_vectors(df).collect())) == want


def planted(n, pairs, dim, common, seed):
    """Unit vectors whose mean cosine is about ``common``; row ``n + i`` is at cosine 0.95 to 0.97 of row ``i``."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x = x / np.linalg.norm(x, axis=1, keepdims=True) * (1 - common) ** 0.5 + np.eye(dim)[0] * common**0.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(pairs, dim))
    side -= (side * x[:pairs]).sum(axis=1, keepdims=True) * x[:pairs]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cos = rng.uniform(0.95, 0.97, (pairs, 1))
    return np.concatenate([x, x[:pairs] * cos + side * (1 - cos**2) ** 0.5])


@pytest.mark.parametrize("common", [0.0, 0.5, 0.7])
def test_planted_pairs_in_a_large_table_with_a_common_direction(spark, common):
    n, pairs = 40_000, 1000
    x = planted(n, pairs, 64, common, 7)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": list(x)})).repartition(8)
    got = {r.vec_id: r.component_id for r in near_duplicate_vectors(df).where("n_links > 0").collect()}
    assert sum(got.get(n + i, -1) == got.get(i, -2) for i in range(pairs)) >= 0.9 * pairs


def test_expected_recall_holds_at_every_size():
    for n in (10, 10**4, 10**6, 10**8, 10**10):
        for spread in (1.0, 0.5, 0.3):
            bits, angle = max(0, np.log2(n / 32)), np.arccos(1 - 0.05 / spread)
            assert 1 - (1 - (1 - angle / np.pi) ** bits) ** passes_for(n, spread, 0.95, 32, 12) >= RECALL - 1e-9
