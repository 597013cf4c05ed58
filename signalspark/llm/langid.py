"""Operator 1: language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

*Features.*  Text is lower-cased, other characters than letters become spaces, and its n-grams of 1 to 3 characters are hashed to ``BUCKETS``
buckets.  A feature is the share of a bucket among the text's n-grams times its inverse document frequency; that is
counted over all documents that may be learned from.
*Training.*  A sample of about ``SAMPLE`` labelled documents (the documented bound; equal parts for each language, whole
texts) is dealt to ``SHARDS`` groups.  Each trains by follow-the-regularised-leader with elastic-net penalties, and the
shards' weights are averaged.
*Calibration.*  One in ``FOLDS`` sampled documents is kept out of training and sets the temperature of the softmax.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import U64, chunks, count_rows, read_table, stored, sum_counts

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SAMPLE = 6000
SHARDS = 4
EPOCHS = 3
FOLDS = 5
#: Features are shares of n-grams; this brings them to about 1.
SCALE = 10.0
#: Learning rate (alpha, beta) and penalties of FTRL.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.01
#: Bytes of text that are looked up at a time.
PREDICT_BYTES = 1 << 19
#: Share of the documents that a common n-gram's bucket is in, the n-grams below which a text is too short to tell, and how far under
#: the least share of common ones among the calibration texts a text of a learned language may be.
COMMON, FEW_NGRAMS, SLACK = 0.001, 60, 0.9
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point of the first plane is a letter; others count as one."""
    return np.array([chr(c).isalpha() for c in range(0xD800)] + [False] * 0x800 + [chr(c).isalpha() for c in range(0xE000, 0x10000)])


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all texts' n-grams one after another, and where each text's begin (and the end).

    Texts are padded with a space on either side, so each has n-grams of every order up to 3 if it has a letter.
    """
    points = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "replace"), np.uint32) for t in texts]
    flat = np.concatenate(points) if points else np.empty(0, np.uint32)
    letters = _letters()
    flat = np.where((flat > 0xFFFF) | letters[np.minimum(flat, 0xFFFF)], flat, 32).astype(U64)
    ends = np.cumsum([len(p) for p in points])
    for n in ORDERS:
        h = np.full(len(flat) - n + 1, n, U64)
        for j in range(n):
            h = (h + flat[j : len(flat) - n + 1 + j]) * U64(0x9E3779B97F4A7C15)
            h ^= h >> U64(29)
        inside = np.ones(len(h), bool)
        for j in range(1, n):
            inside[ends[:-1] - j] = False
        yield (h[inside] >> U64(48)).astype(np.int64) & (BUCKETS - 1), np.concatenate(([0], ends - (n - 1) * np.arange(1, len(ends) + 1)))


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  #: languages x buckets
    temperature: float = 1.0
    common: np.ndarray | None = None  #: whether a bucket is in many documents that were learned from
    least_cover: float = 0.0  #: least share of common n-grams of a text in a learned language

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Texts x languages, and the share of each text's longest n-grams that are common (1 where there are few)."""
        table = (self.weights * self.idf * SCALE).astype(np.float32)
        out, size = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for h, starts in ngrams(texts):
            n = np.diff(starts)
            size += n
            for k in range(len(self.langs)):
                out[:, k] += np.add.reduceat(table[k][h], starts[:-1], dtype=np.float64)
            cover = np.where(n < FEW_NGRAMS, 1.0, np.add.reduceat(self.common[h], starts[:-1], dtype=np.float64) / n)
        return out / size[:, None], cover

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def _document_frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    df = np.zeros(BUCKETS, np.int64)
    for _, texts in chunks(batches, limit=PREDICT_BYTES):
        grams = list(ngrams([t.decode("utf-8", "replace") for t in texts]))
        for i in range(len(texts)):
            df += np.bincount(np.concatenate([h[s[i] : s[i + 1]] for h, s in grams]), minlength=BUCKETS) > 0
    part, counts = count_rows(df)
    yield pa.RecordBatch.from_arrays([part, counts], names=["part", "counts"])


def _features(rows: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and shares of each text."""
    out = []
    for text in rows["text"]:
        h = np.concatenate([h for h, _ in ngrams([text])])
        at, n = np.unique(h, return_counts=True)
        out.append((at, n / len(h)))
    return out


def _train(rows: pd.DataFrame, langs: list[str], idf) -> pd.DataFrame:
    """FTRL over one shard; a row for each language: its weights in all buckets, compressed."""
    rows = rows.sort_values("doc_id")
    label = [langs.index(x) for x in rows["lang"]]
    xs = [(at, SCALE * share * idf.value[at]) for at, share in _features(rows)]
    z, n = np.zeros((BUCKETS, len(langs))), np.zeros((BUCKETS, len(langs)))

    def solved(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    rng = np.random.default_rng(17)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(xs)):
            at, x = xs[i]
            zs, ns = z[at], n[at]
            w = solved(zs, ns)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label[i]] -= 1.0
            g = x[:, None] * p
            more = ns + g * g
            z[at] = zs + g - (np.sqrt(more) - np.sqrt(ns)) / ALPHA * w
            n[at] = more
    w = solved(z, n)
    return pd.DataFrame({"shard": rows["fold"].iloc[0] % SHARDS, "k": range(len(langs)), "w": [zlib.compress(v.tobytes(), 1) for v in np.ascontiguousarray(w.T)]})


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """The shards' weights of one language, averaged in the shards' order."""
    total = sum(np.frombuffer(zlib.decompress(w)) for w in rows.sort_values("shard")["w"])
    return pd.DataFrame({"k": [rows["k"].iloc[0]], "w": [zlib.compress((total / SHARDS).tobytes(), 1)]})


def _sample_logits(batches: Iterable[pd.DataFrame], model) -> Iterator[pd.DataFrame]:
    for rows in batches:
        if len(rows):
            logits, cover = model.value.logits(list(rows["text"]))
            yield pd.DataFrame({"lang": rows["lang"], "logits": list(logits), "cover": cover})


def temperature(logits: np.ndarray, label: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden section over its logarithm (-3 to 6)."""

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        top = z.max(axis=1)
        return float((np.log(np.exp(z - top[:, None]).sum(axis=1)) + top - z[np.arange(len(label)), label]).sum())

    ratio, lo, hi = (5**0.5 - 1) / 2, -3.0, 6.0
    for _ in range(60):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(labelled: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from ``labelled (doc_id, text, lang)``; None without a labelled text that has a letter.

    The model grows with the number of languages, so more than ``sample`` / 20 of them are refused.
    """
    spark = labelled.sparkSession
    labelled = labelled.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & has_letter(F.col("text"))).select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    each = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    totals = {r["lang"]: r["n"] for r in each.limit(sample // 20 + 1).collect()}
    if len(totals) > sample // 20:
        raise ValueError(f"a sample of {sample} texts is for {sample // 20} languages at most, and lang holds more")
    if not totals:
        return None
    langs, n_docs = sorted(totals), sum(totals.values())
    df = sum_counts(labelled.select(F.col("text").cast("binary").alias("text")).mapInArrow(_document_frequencies, "part int, counts binary"), BUCKETS)
    idf = np.log((1 + n_docs) / (1 + df)) + 1
    idf_ = spark.sparkContext.broadcast(idf)
    # A language's documents are taken by a hash of their id, as many as fill its part of the sample on average.
    share = F.create_map(*(x for k in langs for x in (F.lit(k), F.lit(min(1.0, sample / len(langs) / totals[k])))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    picked = labelled.where(draw < share[F.col("lang")]).withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS * SHARDS)))
    picked = stored(picked, "langid-sample")
    learn = picked.where(F.col("fold") >= SHARDS)
    trained = learn.groupBy((F.col("fold") % SHARDS).alias("shard")).applyInPandas(lambda rows: _train(rows, langs, idf_), "shard int, k int, w binary")
    weights = np.zeros((len(langs), BUCKETS))
    for r in trained.groupBy("k").applyInPandas(_merge, "k int, w binary").collect():  # a row for each language
        weights[r["k"]] = np.frombuffer(zlib.decompress(bytes(r["w"])))
    model = Model(langs, idf, weights, common=df >= max(2, COMMON * n_docs))
    model_ = spark.sparkContext.broadcast(model)
    kept = picked.where(F.col("fold") < SHARDS).mapInPandas(partial(_sample_logits, model=model_), "lang string, logits array<double>, cover double").collect()
    if kept:
        model.least_cover = SLACK * min(r["cover"] for r in kept)
        model.temperature = temperature(np.array([r["logits"] for r in kept]), np.array([langs.index(r["lang"]) for r in kept]))
    return model


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Documents of the fold that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


PREDICTION = "struct<lang_pred:string,score:double,known:boolean>"


def prediction(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """``lang_pred``, ``score`` and whether the text is of a ``known`` language: not if it has no letter, or too few common n-grams.

    The bound for these comes from the calibration fold: ``SLACK`` of the least share that a labelled text has there, whatever the number of languages.
    Only texts with a letter go to Python.
    """
    model_ = spark.sparkContext.broadcast(model)

    def predict(texts: pa.Array) -> pa.Array:
        m, parts = model_.value, []
        for batch, some in chunks([pa.RecordBatch.from_arrays([texts.cast(pa.binary())], names=["text"])], limit=PREDICT_BYTES):
            here = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            lang, score, known = np.full(len(some), UNKNOWN, object), np.zeros(len(some)), here.copy()
            if here.any() and m is not None:
                logits, cover = m.logits([t.decode("utf-8", "replace") for t, k in zip(some, here, strict=True) if k])
                p = m.probabilities(logits)
                lang[here], score[here], known[here] = np.array(m.langs, object)[p.argmax(axis=1)], p.max(axis=1), cover >= m.least_cover
            parts.append(pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(known)], names=["lang_pred", "score", "known"]))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("known", pa.bool_())]))

    return F.arrow_udf(predict, PREDICTION)(F.when(has_letter(text), text.cast("string")))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred`` and ``score`` (columns of these names are replaced).

    ``score`` is the calibrated probability of ``lang_pred``, and of two equal ones the first language in order is it.  A null text, one without a
    letter, or any text when nothing could be learned gets ``und`` and score 0.  Only the text is looked at; rows that repeat an id or a text are
    rows like any other.
    """
    rows = docs.drop("lang_pred", "score").withColumn("__language", prediction(F.col("text"), model, docs.sparkSession))
    return rows.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")), "__language.lang_pred", "__language.score")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
