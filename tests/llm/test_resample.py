"""Operator 13 against plain Python."""

import math
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from signalspark.llm import resample as R

DOCS = "doc_id long, text string"


def grams(text):
    low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low.decode())]
    return len(words), [crc32(b" ".join(words[i : i + k])) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    s, t = Counter(b for _, x in docs for b in grams(x)[1]), Counter(b for x in target for b in grams(x)[1])
    every, wanted = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * every / ((s[b] + 1) * wanted))) for b in range(10000)]
    rows, able = [], []
    for i, (d, x) in enumerate(docs):
        n, found = grams(x)
        weight, score = sum(gain[b] for b in found), None
        if d is not None:
            h = int(sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= 20:
                able.append((-score, d, i))
        rows.append([d, len(found), weight, score, None])
    for rank, (_, _, i) in enumerate(sorted(able)[: 5 * len(able) // 100], 1):
        rows[i][4] = rank
    return sorted(map(tuple, rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_whole_table_equal_to_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    df = R.op13_importance_resampling(spark, sf)
    assert df.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    want = brute(docs, [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    assert got(df) == want and sum(r[4] is not None for r in want) > 30


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977} Ünï-x" for i in range(60000))  # several blocks
    docs = [(1, None), (2, ""), (3, "... \t"), (None, "a b c " * 9), (5, "A b.C " * 9), (5, "A b.C " * 9), (6, long), (7, "x" * 3000000), (8, "y " * 19)]
    docs += [(100 + i, f"words of the document {i} " * 6) for i in range(60)]
    df = spark.createDataFrame([(d, t, "a", 1) for d, t in docs], DOCS + ", rank string, place long")
    target = spark.createDataFrame([(None,), ("a b c d",), ("document words",)], "text string")
    want = brute(docs, [None, "a b c d", "document words"])
    result = R.resampled(df, target)
    assert got(result) == want
    drawn = {r[0] for r in want if r[4] is not None}
    kept = R.drawn_documents(df, target)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == drawn and drawn


def test_empty_tables(spark):
    docs, none = [(1, "a b " * 12), (2, "c")], spark.createDataFrame([], DOCS)
    assert got(R.resampled(spark.createDataFrame(docs, DOCS), none)) == brute(docs, [])
    assert R.resampled(none, none).collect() == []
    assert got(R.resampled(spark.createDataFrame([(1, None)], DOCS), none)) == [(1, 0, 0, brute([(1, None)], [])[0][3], None)]


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_crc_of_runs_is_put_together_from_words(monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK_BYTES", block)
    texts = ["Hello, Wörld 123 foo-bar", "", "a" * 300 + " b " + "é" * 200 + " c d e " * 3, "x y z " * 50, "z" * 127 + " " + "z" * 128 + " q"]
    found = [[] for _ in texts]
    n_words = np.zeros(len(texts), int)
    for bucket, text, words in R.feature_buckets([t.encode() for t in texts]):
        n_words += words
        for b, t in zip(bucket.tolist(), text.tolist(), strict=True):
            found[t].append(b)
    assert [(n, sorted(f)) for n, f in zip(n_words, found, strict=True)] == [(n, sorted(x)) for n, x in map(grams, texts)]


def test_weights_from_planes_are_sums_of_products():
    rng = np.random.default_rng(3)
    for high, count in ((1, 2), (9000, 40), (40000, 1 << 20)):
        gains, counts = rng.integers(-high, high + 1, 10000), rng.integers(0, count, (7, 10000))
        assert (R.weights(counts, R.gain_planes(gains)) == counts @ gains).all()
    assert R.weights(np.zeros((2, 10000), int), R.gain_planes(np.zeros(10000, int))).tolist() == [0, 0]
