"""Operator 6: near-duplicate vectors by sorted projection passes.

Equal vectors form a class.  In each pass, classes are ordered by the concatenated signs of random projections of their unit vectors less the mean of all
(a common direction would give most of them the same signs), and each is compared with its ``WINDOW``
successors by exact cosine in double precision.  Vectors at a small angle agree in long prefixes of some pass.
The number of passes follows from the counted classes and their spread about the mean (``passes_for``), so the expected recall doesn't fall with size.
The order is a range partitioning, so one value of the key, split by a hash of the vector's id, can be several tasks; the first and last ``WINDOW``
rows of neighbouring partitions are compared in a second step.

Pairs found are united across passes.  All pairs within a component are then compared exactly, in tiles of ``TILE`` classes, to count
each vector's links: the window bounds the search, not the links reported for what it found.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import read_table, stored
from signalspark.llm.components import connected_components

THRESHOLD = 0.95
#: Least number of passes, and the expected recall at the threshold from which the number for larger tables is derived.
PASSES, RECALL = 12, 0.92
KEY_BITS = 40
WINDOW = 32
TILE = 1024
TIE_BITS = 22
#: Bytes of vectors in a sorted partition of the passes.
PARTITION_BYTES = 64 << 20

SORTED = "pass int, dim int, key long, cls long, unit binary"
FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("edge", pa.int32()), ("last", pa.bool_()), ("pass", pa.int32()), ("dim", pa.int32()), ("cls", pa.int64()), ("unit", pa.binary())])


@lru_cache(maxsize=64)
def _planes(number: int, dim: int) -> np.ndarray:
    return np.random.default_rng([97, number, dim]).standard_normal((dim, KEY_BITS))


def passes_for(n: int, spread: float, threshold: float, window: int, least: int) -> int:
    """Passes after which a pair at ``threshold`` among ``n`` vectors has been within the window with probability ``RECALL``.

    ``spread`` is the mean square distance of the unit vectors from their mean.  A pair that agrees in log2(n / window) bits is in the window,
    if the vectors about the mean have no preferred direction; each bit agrees with probability 1 - angle / pi, the angle seen from the mean.
    """
    bits = max(0.0, math.log2(max(n, 1) / window))
    agree = 1 - math.acos(max(0.0, 1 - (1 - threshold) / max(spread, 1e-9))) / math.pi
    together = min(agree**bits, 1 - 1e-9)
    return max(least, math.ceil(math.log(1 - RECALL) / math.log1p(-together)))


def _by_dim(vectors: list) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Length, places and unit vectors of each length."""
    vectors = [np.array(v, np.float64) for v in vectors]
    dims = np.array([len(v) for v in vectors])
    for dim in np.unique(dims):
        of = np.flatnonzero(dims == dim)
        v = np.stack([vectors[i] for i in of])
        v /= np.abs(v).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        yield int(dim), of, v


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and sum of a task's unit vectors of each length."""
    total: dict[int, list] = {}
    for b in batches:
        for dim, of, v in _by_dim(b.column(0).to_pylist()):
            t = total.setdefault(dim, [0, np.zeros(dim)])
            t[0] += len(of)
            t[1] += v.sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([n for n, _ in total.values()], pa.int64()), pa.array([t.tobytes() for _, t in total.values()], pa.binary())], names=["dim", "n", "total"])


def _add_sums(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(t) for t in rows["total"])
    return pd.DataFrame({"dim": [rows["dim"].iloc[0]], "n": [rows["n"].sum()], "total": [total.tobytes()]})


def _plan(classes: DataFrame, threshold: float, window: int, passes: int) -> dict[int, tuple[np.ndarray, int]]:
    """Mean and number of passes for each length with more vectors than a window holds."""
    sums = classes.select("embedding").mapInArrow(_sums, "dim int, n long, total binary").groupBy("dim").applyInPandas(_add_sums, "dim int, n long, total binary")
    out = {}
    for r in sums.where(F.col("n") > window).collect():
        mean = np.round(np.frombuffer(bytes(r["total"])) / r["n"], 9)  # the order of the sum doesn't show
        out[r["dim"]] = mean, passes_for(r["n"], 1 - float(mean @ mean), threshold, window, passes)
    return out


def _keys(batches: Iterable[pa.RecordBatch], passes: int, plan) -> Iterator[pa.RecordBatch]:
    weights = (1 << np.arange(KEY_BITS - 1, -1, -1)).astype(np.int64)
    for b in batches:
        cls, tie = b.column(0).to_numpy(), b.column(1).to_numpy()
        for dim, of, v in _by_dim(b.column(2).to_pylist()):
            blobs = [x.tobytes() for x in v]
            mean, number = plan.value.get(dim, (0.0, passes))
            for p in range(number):
                key = (((v - mean) @ _planes(p, dim) > 0) @ weights) << TIE_BITS | tie[of]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(of), p, np.int32)), pa.array(np.full(len(of), dim, np.int32)), pa.array(key), pa.array(cls[of]), pa.array(blobs, pa.binary())],
                    names=["pass", "dim", "key", "cls", "unit"],
                )


def _links(cls: np.ndarray, unit: np.ndarray, new: int, threshold: float, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at most ``window`` apart whose second is at place ``new`` or later."""
    a, b = [], []
    for o in range(1, min(window, len(cls) - 1) + 1):
        start = max(o, new)
        near = np.flatnonzero(np.einsum("ij,ij->i", unit[start - o : len(cls) - o], unit[start:]) >= threshold) + start
        a.append(cls[near - o])
        b.append(cls[near])
    return (np.concatenate(a), np.concatenate(b)) if a else (cls[:0], cls[:0])


def _found(a=(), b=(), edge=(), last=(), pass_=(), dim=(), cls=(), unit=()) -> pa.RecordBatch:
    n = len(a) + len(cls)
    cols = (a, b, edge, last, pass_, dim, cls, unit)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) if len(c) else pa.nulls(n, f.type) for c, f in zip(cols, FOUND, strict=True)], schema=FOUND)


def _slide(batches: Iterable[pa.RecordBatch], threshold: float, window: int) -> Iterator[pa.RecordBatch]:
    """Links of one sorted partition; its first and last rows for the neighbours."""
    part = TaskContext.get().partitionId()
    seen: list[tuple] = []  # the first rows
    tail: list[tuple] = []  # the last rows so far
    for b in batches:
        rows = list(zip(*(c.to_pylist() for c in b.columns), strict=True))
        if len(seen) < window:
            seen += rows[: window - len(seen)]
        rows, known = tail + rows, len(tail)
        at = 0
        while at < len(rows):  # runs of equal pass and dimension
            end = at
            while end < len(rows) and rows[end][:2] == rows[at][:2]:
                end += 1
            a, c = _links(np.array([r[3] for r in rows[at:end]]), np.stack([np.frombuffer(r[4]) for r in rows[at:end]]), max(0, known - at), threshold, window)
            if len(a):
                yield _found(a=a, b=c)
            at = end
        tail = rows[-window:]
    for edge, last, rows in ((part - 1, False, seen), (part, True, tail)):
        if rows:
            yield _found(edge=[edge] * len(rows), last=[last] * len(rows), pass_=[r[0] for r in rows], dim=[r[1] for r in rows], cls=[r[3] for r in rows], unit=[r[4] for r in rows])


def _edges(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links between the last rows of a partition and the first of the next."""
    out = []
    for _, run in rows.groupby(["pass", "dim"]):
        x, y = run[run["last"]], run[~run["last"]]
        if len(x) and len(y):
            cos = np.stack([np.frombuffer(v) for v in x["unit"]]) @ np.stack([np.frombuffer(v) for v in y["unit"]]).T
            i, j = np.nonzero(cos >= threshold)
            out.append(pd.DataFrame({"a": x["cls"].to_numpy()[i], "b": y["cls"].to_numpy()[j]}))
    return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")


def _count(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links of the classes of one tile pair, copies counted each."""
    lo, hi = rows["lo"].iloc[0], rows["hi"].iloc[0]
    sides = [rows[rows["tile"] == t] for t in ([lo] if lo == hi else [lo, hi])]
    unit = [np.stack([np.frombuffer(v) for v in s["unit"]]) for s in sides if len(s)]
    if len(unit) < len(sides):
        return pd.DataFrame({"cls": [], "links": []}, dtype="int64")
    near = unit[0] @ unit[-1].T >= threshold
    if lo == hi:
        np.fill_diagonal(near, False)
        out = [(sides[0], near @ sides[0]["copies"].to_numpy())]
    else:
        out = [(sides[0], near @ sides[1]["copies"].to_numpy()), (sides[1], near.T @ sides[0]["copies"].to_numpy())]
    return pd.concat([pd.DataFrame({"cls": s["cls"].to_numpy(), "links": n}) for s, n in out])


def near_duplicate_vectors(vectors: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors (vec_id, embedding)``.

    Vectors that are null, empty or zero, or hold a null or non-finite component, and rows with a null id, link with nothing and are their
    own component (``kept`` is null for a null id).  Vectors of different lengths don't link.  Rows that repeat an id are vectors of their own;
    a component is called by its smallest id, so two of them can have one name where an id repeats.  Other columns are ignored.
    ``passes`` is the least number of passes; larger tables get more.
    """
    rows = stored(vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")), "vectors")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("good", good).withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64("embedding", F.lit(1)))
    classes = rows.where("good").groupBy("h1", "h2").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    # Ids can repeat, so classes are numbered; the numbers hold once they are written.
    classes = stored(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    tie = F.pmod("h2", F.lit(1 << TIE_BITS)).alias("tie")
    plan = rows.sparkSession.sparkContext.broadcast(_plan(classes, threshold, window, passes))
    keyed = stored(classes.select("cls", tie, "embedding").mapInArrow(partial(_keys, passes=passes, plan=plan), SORTED), "keyed")
    kept_bytes = keyed.agg(F.sum(24 + 8 * F.col("dim").cast("long"))).first()[0] or 0
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-kept_bytes // PARTITION_BYTES))
    ordered = keyed.repartitionByRange(n, "pass", "dim", "key", "cls").sortWithinPartitions("pass", "dim", "key", "cls")
    found = stored(ordered.mapInArrow(partial(_slide, threshold=threshold, window=window), "a long, b long, edge int, last boolean, pass int, dim int, cls long, unit binary"), "found")
    across = found.where("cls is not null").groupBy("edge").applyInPandas(partial(_edges, threshold=threshold), "a long, b long")
    labels = stored(connected_components(found.where("cls is null").select("a", "b").union(across)).toDF("cls", "component"), "labels")
    tiles = labels.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    units = keyed.where("pass = 0").select("cls", "unit")
    members = labels.join(tiles, "component").join(units, "cls").join(classes.select("cls", "copies"), "cls").withColumn("tile", F.pmod(F.xxhash64("cls", F.lit("tile")), F.col("tiles")).cast("int"))
    paired = members.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).withColumn("lo", F.least("tile", "other")).withColumn("hi", F.greatest("tile", "other"))
    links = paired.drop("other", "tiles").groupBy("component", "lo", "hi").applyInPandas(partial(_count, threshold=threshold), "cls long, links long")
    links = links.groupBy("cls").agg(F.sum("links").alias("links"))
    names = labels.join(classes.select("cls", "least_id"), "cls").groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = labels.join(names, "component").select("cls", "component_id")
    per_class = stored(classes.select("h1", "h2", "cls", "least_id", "copies").join(links, "cls", "left").join(named, "cls", "left").drop("cls"), "per-class")
    out = rows.join(per_class.withColumn("good", F.lit(True)), ["h1", "h2", "good"], "left")
    component = F.coalesce("component_id", "least_id", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("copies") - 1, F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))
