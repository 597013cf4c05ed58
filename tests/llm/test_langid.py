"""Language identification: held-out accuracy, features, calibration, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalspark.llm import langid
from signalspark.llm.langid import Model, held_out, identify, ngrams, op1_language_id, temperature, train


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = op1_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    out = [r for r in rows if r.held_out]
    assert 150 < len(out) < 350
    assert sum(r.lang == r.lang_pred for r in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_documents_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    wrong = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (train(d.where(~held_out(F.col("doc_id")))) for d in (docs, wrong))
    assert a.langs == b.langs and np.array_equal(a.weights, b.weights) and a.temperature == b.temperature


def brute_shares(text):
    """{bucket: share of the text's n-grams} with plain integers."""
    letters = "".join(c if c.isalpha() or ord(c) > 0xFFFF else " " for c in f" {text.lower()} ")
    grams = []
    for n in (1, 2, 3):
        for i in range(len(letters) - n + 1):
            h = n
            for c in letters[i : i + n]:
                h = (h + ord(c)) * 0x9E3779B97F4A7C15 % 2**64
                h ^= h >> 29
            grams.append(h >> 48)
    return {g: grams.count(g) / len(grams) for g in set(grams)}


def brute_train(rows, langs):
    """Weights {(bucket, k): w} and IDF by follow-the-regularised-leader one coordinate at a time; rows are (fold, doc_id, text, lang)."""
    shares = {doc: brute_shares(text) for _, doc, text, _ in rows}
    idf = {g: math.log((1 + len(rows)) / (1 + sum(g in x for x in shares.values()))) + 1 for x in shares.values() for g in x}
    mean = {}
    for shard in range(langid.SHARDS):
        some = sorted((doc, lang) for fold, doc, _, lang in rows if fold >= langid.SHARDS and fold % langid.SHARDS == shard)
        z, n = {}, {}

        def weight(key, z=z, n=n):
            v = z.get(key, 0.0)
            return 0.0 if abs(v) <= langid.L1 else (math.copysign(langid.L1, v) - v) / ((langid.BETA + n[key] ** 0.5) / langid.ALPHA + langid.L2)

        rng = np.random.default_rng(17)
        for _ in range(langid.EPOCHS):
            for i in rng.permutation(len(some)):
                x = {g: langid.SCALE * share * idf[g] for g, share in shares[some[i][0]].items()}
                e = [math.exp(sum(v * weight((g, k)) for g, v in x.items())) for k in range(len(langs))]
                for k, lang in enumerate(langs):
                    error = e[k] / sum(e) - (lang == some[i][1])
                    for g, v in x.items():
                        w, old = weight((g, k)), n.get((g, k), 0.0)
                        n[g, k] = old + (v * error) ** 2
                        z[g, k] = z.get((g, k), 0.0) + v * error - (n[g, k] ** 0.5 - old**0.5) / langid.ALPHA * w
        for key in z:
            mean[key] = mean.get(key, 0.0) + weight(key) / langid.SHARDS
    return mean, idf


def test_equal_to_brute_force(spark):
    words = {"a": ["tik", "tak", "été"], "b": ["lorem", "ipsum"], "c": ["日本", "語x", "ß"]}
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(rng.choice(words[k], 6)) + (" 1, tik" if i % 5 == 0 else ""), k) for i, k in enumerate(rng.choice(list(words), 90).tolist())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    folds = {r.doc_id: r.fold for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(langid.FOLDS * langid.SHARDS)).alias("fold")).collect()}
    model = train(df)
    weights, idf = brute_train([(folds[i], i, t, k) for i, t, k in rows], ["a", "b", "c"])
    assert model.langs == ["a", "b", "c"] and np.count_nonzero(model.weights) == sum(w != 0 for w in weights.values()) > 20
    assert all(abs(model.weights[k, g] - w) < 1e-9 for (g, k), w in weights.items())
    for r in identify(df, model).collect():
        x = brute_shares(r.text)
        e = [math.exp(sum(langid.SCALE * share * idf[g] * weights.get((g, k), 0.0) for g, share in x.items()) / model.temperature) for k in range(3)]
        assert r.lang_pred == "abc"[e.index(max(e))] and abs(r.score - max(e) / sum(e)) < 1e-4


def test_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = train(docs)
    rows = [(1, None), (2, ""), (3, "12 34 !?"), (4, "der und die und das " * 30), (4, "der und die und das " * 30), (None, "the of and the is")]
    df = spark.createDataFrame([(*r, 0.5, True) for r in rows], "doc_id long, text string, score double, known boolean")
    got = identify(df, model).collect()
    assert [(r.doc_id, r.text) for r in got] == rows
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in got[3:]] == ["de", "de", "en"]
    assert train(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {(r.lang_pred, r.score) for r in identify(df, None).collect()} == {("und", 0.0)}
    assert identify(df.limit(0), model).collect() == []


def test_no_language_is_left_out(spark):
    df = spark.createDataFrame([(i, f"text {i} abc", f"l{i % 4}") for i in range(80)], "doc_id long, text string, lang string")
    assert train(df, sample=80).langs == ["l0", "l1", "l2", "l3"]
    with pytest.raises(ValueError, match="3 languages at most"):
        train(df, sample=60)


def test_ngrams_stay_in_their_text():
    texts = ["Ab1c", "x", "日本", "😀é"]
    for (h, s), *alone in zip(ngrams(texts), *(ngrams([t]) for t in texts), strict=True):
        for i, (one, _) in enumerate(alone):
            assert h[s[i] : s[i + 1]].tolist() == one.tolist()


def test_temperature_recovers_the_scale():
    rng = np.random.default_rng(1)
    true = rng.normal(size=(4000, 3))
    p = np.exp(true) / np.exp(true).sum(axis=1, keepdims=True)
    label = np.array([rng.choice(3, p=q) for q in p])
    assert abs(temperature(true * 5, label) - 5) < 0.7
    assert np.allclose(Model(["a"], np.ones(1), np.ones((1, 1)), 2.0).probabilities(np.array([[3.0]])), 1)
