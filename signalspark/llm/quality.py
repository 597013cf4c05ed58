"""Operator 11: quality classification by a generalised additive model with pairwise interactions.

*Features.*  Numbers that whole texts are described by (``FEATURES``): length, words, lines, shares of kinds of characters, repetition of words,
word pairs and lines.
*Model.*  Each feature has a table with a value for each of its bins, each chosen pair of features one for each pair of coarse bins; a text's log odds
are the intercept plus the values of its bins.  So a score is bin look-ups and additions.
*Training.*  The labelled documents are sampled to about ``SAMPLE`` (the documented bound; equal parts of both labels, whole texts) and weighted back
to their numbers.  ``BAGS`` tasks each leave out one part of the sample and boost cyclically: round after round, each feature in turn gets a tree of
three leaves on its bins, fitted to what the model leaves over, a small step of which is added to its table.  The bags' tables are
averaged.  Then every pair of features is tried by the best cross of two cuts, and the ``PAIRS`` best are boosted in the same way by trees of two levels,
on top of the averaged tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import ODD, U64, chunks, join_ids, mix, read_table, split_words, stored

SAMPLE = 8000
BAGS = 4
ROUNDS, PAIR_ROUNDS = 150, 60
STEP, RIDGE = 0.15, 1.0
#: Bins of a feature, and coarse bins of a feature in a pair.
BINS, COARSE = 32, 8
PAIRS = 6
#: Least weight of examples (of SAMPLE) in a leaf of a tree.
LEAST_LEAF = 5.0

#: Kinds of bytes: the shares of each are features.
KINDS = {
    "small": b"abcdefghijklmnopqrstuvwxyz",
    "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t",
    "line_feed": b"\r\n",
    "stop": b".,;:?",
    "exclamation": b"!",
    "quote": b"\"'()",
    "dash": b"-_/",
    "bar": b"|",
    "markup": b"<>{}[]=\\`~^",
    "sign": b"#$%&*+@",
    "other": bytes(range(128, 256)),
}
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "entropy",
    *KINDS,
    "distinct_words", "top_word", "same_as_before", "distinct_pairs",
    "words_in_line", "distinct_lines", "lines_ended",
)
#: Last bytes of lines that end a sentence or a clause.
LINE_END = frozenset(b".!?:;\"'")


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Byte x kind."""
    out = np.zeros((256, len(KINDS)))
    for k, members in enumerate(KINDS.values()):
        out[list(members), k] = 1
    return out


def _repetition(h: np.ndarray) -> tuple[float, float, float, float]:
    """Shares of distinct words, of the most frequent one, of words equal to the one before, and of distinct pairs of words."""
    n = len(h)
    if n < 2:
        return 1.0, 1.0, 0.0, 1.0
    x = np.sort(h)
    edge = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1], [True])))
    pairs = np.sort(mix(h[:-1] * U64(ODD[2]) + h[1:]))
    return (len(edge) - 1) / n, float(np.diff(edge).max()) / n, float((h[1:] == h[:-1]).mean()), float(1 + (pairs[1:] != pairs[:-1]).sum()) / (n - 1)


def features(texts: list[bytes]) -> np.ndarray:
    """Texts x ``FEATURES``.  A text without words has zeros for what only words have, and an empty one has zeros for all shares of bytes."""
    hist = np.array([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts], float).reshape(len(texts), 256)
    size = hist.sum(axis=1)
    share = hist / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    flat, starts = split_words(texts)
    n_words = np.diff(starts)
    repeated = np.array([_repetition(flat[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]).reshape(len(texts), 4)
    lines = np.zeros((len(texts), 3))
    for i, t in enumerate(texts):
        parts = [x for x in (p.strip() for p in t.split(b"\n")) if x]
        if parts:
            lines[i] = n_words[i] / len(parts), len(set(parts)) / len(parts), sum(p[-1] in LINE_END for p in parts) / len(parts)
    return np.column_stack([np.log1p(size), np.log1p(n_words), size / np.maximum(n_words, 1), entropy, share @ _kinds(), repeated, lines])


@dataclass
class Model:
    edges: list[np.ndarray]  #: of each feature: cuts between its bins
    intercept: float
    tables: list[np.ndarray]  #: of each feature: a value for each bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)  #: of each pair: coarse bins x coarse bins

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)])

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        if not self.edges:
            return out
        b = self.bins(x)
        for f, table in enumerate(self.tables):
            out += table[b[:, f]]
        for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[coarse(b[:, f], self.edges[f]), coarse(b[:, g], self.edges[g])]
        return out


def coarse(bins: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Coarse bin of each bin: as many bins in each as can be."""
    return bins * COARSE // max(len(edges) + 1, COARSE)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def cuts(x: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Cuts at weighted quantiles, BINS - 1 at most; equal values share a bin."""
    order = np.argsort(x, kind="stable")
    at = np.cumsum(weight[order]) / weight.sum()
    picked = x[order][np.minimum(np.searchsorted(at, np.arange(1, BINS) / BINS), len(x) - 1)]
    return np.unique(picked[picked > x.min()])


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place (bins before it go left) of the best cut of a row of bins with sums of gradients, curvatures and weights; (0, 0) if none."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl, nl = (np.cumsum(v)[:-1] for v in (g, h, n))
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    gain[(nl < LEAST_LEAF) | (n.sum() - nl < LEAST_LEAF)] = 0
    k = int(gain.argmax())
    return (float(gain[k]), k + 1) if gain[k] > 1e-12 else (0.0, 0)


def small_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Values of a tree of up to three leaves over a row of bins."""
    leaves = [(0, len(g))]
    for _ in range(2):
        tried = [(best_cut(g[a:b], h[a:b], n[a:b]), a, b) for a, b in leaves]
        (gain, k), a, b = max(tried, key=lambda t: t[0][0])
        if not k:
            break
        leaves = [x for x in leaves if x != (a, b)] + [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts one side of a table of bins, then each half on the other side."""
    best = (0.0, np.zeros(g.shape))
    for turned in (False, True):
        a = [v.T if turned else v for v in (g, h, n)]
        for k in range(1, a[0].shape[0]):
            gain, out = -_gain(g.sum(), h.sum()), np.zeros(a[0].shape)
            for half in (slice(0, k), slice(k, None)):
                row = [v[half].sum(axis=0) for v in a]
                if row[2].sum() < LEAST_LEAF:
                    gain = -np.inf
                    break
                more, j = best_cut(*row)
                gain += _gain(row[0].sum(), row[1].sum()) + more
                for part in (slice(0, j), slice(j, None)) if j else (slice(None),):
                    out[half, part] = -row[0][part].sum() / (row[1][part].sum() + RIDGE)
            if gain > best[0]:
                best = (float(gain), out.T if turned else out)
    return best


def boost_features(b: np.ndarray, y: np.ndarray, w: np.ndarray, sizes: list[int], intercept: float) -> list[np.ndarray]:
    """Tables of the features, cyclically boosted."""
    tables, score = [np.zeros(s) for s in sizes], np.full(len(y), intercept)
    held = [np.bincount(b[:, f], w, sizes[f]) for f in range(len(sizes))]
    for _ in range(ROUNDS):
        for f, size in enumerate(sizes):
            p = sigmoid(score)
            values = STEP * small_tree(np.bincount(b[:, f], w * (p - y), size), np.bincount(b[:, f], w * p * (1 - p), size), held[f])
            tables[f] += values
            score += values[b[:, f]]
    return tables


def _pair_sums(c: np.ndarray, f: int, g: int, v: np.ndarray) -> np.ndarray:
    return np.bincount(c[:, f] * COARSE + c[:, g], v, COARSE * COARSE).reshape(COARSE, COARSE)


def pair_gains(c: np.ndarray, y: np.ndarray, w: np.ndarray, score: np.ndarray) -> dict[tuple[int, int], float]:
    """What the best tree over each pair of features would gain on top of ``score``."""
    p = sigmoid(score)
    grad, curv = w * (p - y), w * p * (1 - p)
    return {(f, g): pair_tree(*(_pair_sums(c, f, g, v) for v in (grad, curv, w)))[0] for f, g in combinations(range(c.shape[1]), 2)}


def boost_pairs(c: np.ndarray, y: np.ndarray, w: np.ndarray, score: np.ndarray, pairs: list[tuple[int, int]]) -> list[np.ndarray]:
    """Tables of the pairs, cyclically boosted on top of ``score``."""
    tables, score = [np.zeros((COARSE, COARSE)) for _ in pairs], score.copy()
    held = [_pair_sums(c, f, g, w) for f, g in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(pairs):
            p = sigmoid(score)
            values = STEP * pair_tree(_pair_sums(c, f, g, w * (p - y)), _pair_sums(c, f, g, w * p * (1 - p)), held[k])[1]
            tables[k] += values
            score += values[c[:, f], c[:, g]]
    return tables


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        x = features(texts)
        at = batch.schema.names.index("text")
        rest = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if i != at]
        yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(list(x), pa.list_(pa.float64()))], names=[*(n for n, _ in rest), "x"])


def _example_arrays(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = rows.sort_values(["doc_id", "label"])
    return np.array(rows["x"].tolist()).reshape(len(rows), len(FEATURES)), rows["label"].to_numpy(float), rows["weight"].to_numpy(float)


def _coarse_bins(m: Model, b: np.ndarray) -> np.ndarray:
    return np.column_stack([coarse(b[:, f], e) for f, e in enumerate(m.edges)])


def _bag_features(rows: pd.DataFrame, model) -> pd.DataFrame:
    m = model.value
    x, y, w = _example_arrays(rows)
    tables = boost_features(m.bins(x), y, w, [len(e) + 1 for e in m.edges], m.intercept)
    return pd.DataFrame({"term": range(len(tables)), "v": pd.Series([t.tolist() for t in tables], dtype=object)})


def _bag_gains(rows: pd.DataFrame, model) -> pd.DataFrame:
    m = model.value
    x, y, w = _example_arrays(rows)
    gains = pair_gains(_coarse_bins(m, m.bins(x)), y, w, m.log_odds(x))
    return pd.DataFrame({"f": [f for f, _ in gains], "g": [g for _, g in gains], "gain": list(gains.values())})


def _bag_pairs(rows: pd.DataFrame, model) -> pd.DataFrame:
    m = model.value
    x, y, w = _example_arrays(rows)
    tables = boost_pairs(_coarse_bins(m, m.bins(x)), y, w, m.log_odds(x), m.pairs)
    return pd.DataFrame({"term": range(len(tables)), "v": pd.Series([t.ravel().tolist() for t in tables], dtype=object)})


def _averages(rows: DataFrame) -> dict[int, np.ndarray]:
    """Mean of each term's values over the bags: at most a term of BINS or COARSE^2 values for each feature and pair."""
    out: dict[int, list[list[float]]] = {}
    for r in rows.collect():
        out.setdefault(r["term"], []).append(r["v"])
    return {k: np.mean(sorted(v), axis=0) for k, v in out.items()}


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of ``labels (doc_id, quality)`` from the texts of ``docs (doc_id, text)``.

    Labels other than 0 and 1 and rows without an id are left out.  An id with both labels is an example of either; of texts that repeat an
    id, the one with the least features stands for all, so a repeated id doesn't grow the sample.  Without examples of both labels the
    score is the same for every text: the share of label 1, smoothed.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).distinct()
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = totals.get(1, 0), totals.get(0, 0)
    prior = float(np.log((ones + 0.5) / (zeros + 0.5)))
    if not ones or not zeros:
        return Model([], prior, [])
    # Both labels fill half of the sample on average, and an example weighs as many documents as it stands for.
    share = {k: min(1.0, sample / 2 / n) for k, n in totals.items()}
    of = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    scale = min(1.0, sample / (ones + zeros))
    picked = stored(known.where(draw < of).withColumn("weight", scale / of), "quality-ids")
    texts = join_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")), picked, "doc_id", "inner", 4 * sample)
    described = texts.mapInArrow(_describe, "doc_id long, label int, weight double, x array<double>")
    examples = stored(described.groupBy("doc_id", "label", "weight").agg(F.min("x").alias("x")), "quality-sample")
    rows = examples.toPandas()  # about ``sample`` rows of numbers
    if not {0, 1} <= set(rows["label"]):
        return Model([], prior, [])
    x, _, w = _example_arrays(rows)
    model = Model([cuts(x[:, f], w) for f in range(len(FEATURES))], prior, [np.zeros(BINS) for _ in FEATURES])
    bags = examples.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("bag")), F.lit(BAGS))).withColumn("bag", F.explode(F.array(*map(F.lit, range(BAGS))))).where("part <> bag")
    bags = bags.groupBy("bag")

    def shared() -> object:
        return spark.sparkContext.broadcast(model)

    found = _averages(bags.applyInPandas(partial(_bag_features, model=shared()), "term int, v array<double>"))
    model.tables = [found[f] for f in range(len(FEATURES))]
    gains = bags.applyInPandas(partial(_bag_gains, model=shared()), "f int, g int, gain double").groupBy("f", "g").agg(F.sum("gain").alias("gain"))
    model.pairs = [(r["f"], r["g"]) for r in gains.where("gain > 0").orderBy(F.desc("gain"), "f", "g").limit(PAIRS).collect()]
    model.pair_tables = [np.zeros((COARSE, COARSE))] * len(model.pairs)
    if model.pairs:
        found = _averages(bags.applyInPandas(partial(_bag_pairs, model=shared()), "term int, v array<double>"))
        model.pair_tables = [found[k].reshape(COARSE, COARSE) for k in range(len(model.pairs))]
    return model


def _score(batches: Iterable[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        score = sigmoid(model.value.log_odds(features(texts)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every row: the probability of label 1 and whether it is 0.5 or more.

    Only the text is looked at.  A null text counts as empty; empty and blank texts get the score of their bins like any
    other.  Rows without an id and rows that repeat one are scored too.  Further columns are ignored.
    """
    model_ = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(partial(_score, model=model_), "doc_id long, score double, predicted int")


def held_out(doc_id: Column) -> Column:
    """Documents of the fold that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs, read_table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id"))))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
