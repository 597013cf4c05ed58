"""Operator 3: Jaccard self-join of documents on word shingles through a token-group matrix.

1. Documents with equal shingle sets form a class (two 64-bit sums over the set, and its size); one of each class goes on.
2. *Groups.*  Classes that share one of three minimum hashes are compared by the minima of ``BINS`` bins of their hashes, 64 bytes for a class: each takes
   the leader that it seems to be most similar to, somewhat under the threshold too.  Cells of one minimum hash are split by a hash of the document
   into parts of at most ``CELL`` expected members, so a hot one is many tasks.  A group is a family around such a document, its centre.  Any
   partition into groups gives right results; similar documents in one group make the matrix small.
3. *Matrix.*  All tokens have one global order, rarest first by a count sketch over all documents.  With t = threshold, a set
   of n tokens keeps its first n - ceil(t n) + 3 tokens.  Two sets that reach t share at least 3 of these (the one
   whose kept tokens end first has at most ceil(t n) - 3 common tokens beyond them, and at least ceil(t n) are common).
   The matrix holds, for each token and group, the sizes of the group's sets that keep the token: the union of its members.
4. *Bound.*  A set's kept tokens are looked up.  A group that shares fewer of them than a partner of its members' sizes must (``least_hits``: at least 3, and
   more the closer the sizes are) can't hold a partner.
5. *Open.*  The members of a group and the sets that it qualifies for are compared exactly with its centre.  What sets them apart from the centre
   is looked up within the group (``_pairs_of_families``): so many near copies that don't reach the threshold open few pairs.  Pairs that are still
   apart are compared exactly.
6. The links give the components.

The sketch only decides the order, so its errors cost time, not links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalspark.llm.common import ODD, U64, as_long, chunks, count_rows, gram_hashes, join_ids, mix, read_table, split_words, stored, sum_counts
from signalspark.llm.components import connected_components

#: log2 of the sketch's counters (4 bytes each, broadcast).
SKETCH_BITS = 20
#: Expected members of a cell of a group.
CELL = 256
#: Matrix matches a partner must have.
NEED = 3
ROUNDS = 3

#: Bins of the minima by which the similarity of two sets is guessed, and how far under the threshold a guess may be.
BINS, DOUBT = 32, 0.15
#: Steps from a leader to the leader that it took itself.
JUMPS = 2
#: Value of a bin without a hash.
EMPTY = (1 << 16) - 1
_BIN_STARTS = np.arange(BINS, dtype=U64) << U64(64 - (BINS - 1).bit_length())

PASS1 = "doc_id long, n long, s1 long, s2 long, m0 long, m1 long, m2 long, minima binary, part int, counts binary"
PASS2 = "doc_id long, n long, kept array<long>, tokens binary"


def shingle_sets(texts: list[bytes], k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes; fewer than k words: the sequence as one; no word: empty."""
    flat, starts = split_words(texts)
    grams = gram_hashes(flat, k)
    for s, e in zip(starts[:-1], starts[1:], strict=True):
        if e - s >= k:
            x = np.sort(grams[s : e - k + 1])
            yield x[np.concatenate(([True], x[1:] != x[:-1]))]
        elif e > s:
            yield gram_hashes(np.append(flat[s:e], U64(e - s)), e - s + 1)
        else:
            yield np.empty(0, U64)


def _first_pass(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << SKETCH_BITS, np.int64)
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n", "s1", "s2", "m0", "m1", "m2")), ("minima", pa.binary()), ("part", pa.int32()), ("counts", pa.binary())])
    for batch, texts in chunks(batches):
        rows = np.zeros((len(texts), 6), np.int64)
        sets = list(shingle_sets(texts, k))
        for i, x in enumerate(sets):
            if len(x):
                other = (x ^ (x >> U64(29))) * U64(ODD[3])
                rows[i] = as_long(np.array([len(x), x.sum(), other.sum(), (x * U64(ODD[0])).min(), (x * U64(ODD[1])).min(), (x * U64(ODD[4])).min()], U64))
        total += np.bincount((np.concatenate(sets) & U64((1 << SKETCH_BITS) - 1)).astype(np.int64), minlength=1 << SKETCH_BITS)
        none = pa.nulls(len(texts))
        minima = pa.array([bin_minima(x).tobytes() for x in sets], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(rows[:, j]) for j in range(6)), minima, none.cast(pa.int32()), none.cast(pa.binary())], schema=schema)
    if total.any():
        part, counts = count_rows(total)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(part), pa.int64()) for _ in range(7)), pa.nulls(len(part), pa.binary()), part, counts], schema=schema)


def _sketch(rows: DataFrame) -> np.ndarray:
    return np.minimum(sum_counts(rows.where("counts is not null"), 1 << SKETCH_BITS), 2**32 - 1).astype(np.uint32)


def required(n, num: int, den: int):
    """ceil(n num / den): common tokens that a partner of a set of n must have at least."""
    return -(-n * num // den)


def least_hits(n: str, n_min: str, n_max: str, num: int, den: int) -> Column:
    """Kept tokens that a set of ``n`` must share with one of ``n_min`` to ``n_max`` tokens (columns) to reach num / den with it.

    Sets of n and m that reach t = num / den have ceil(t (n + m) / (1 + t)) tokens in common.  At most ceil(t n) - NEED of these are not among the kept
    tokens of the set whose kept tokens end first (or the same with m); the others are kept by both.  The number grows with m up to n and falls
    from there, so that of a range is that at one of its possible ends, there without the roundings.
    """
    size = F.col(n)
    lo, hi = F.greatest(F.col(n_min), F.ceil(size * num / den)), F.least(F.col(n_max), F.floor(size * den / num))
    exact = F.ceil((size + lo) * num / (num + den)) - F.greatest(F.ceil(F.greatest(size, lo) * num / den) - NEED, F.lit(0))
    rough = lambda m: (size + m) * num / (num + den) - F.greatest(F.greatest(size, m) * num / den + 1 - NEED, F.lit(0))
    return F.when(lo == hi, exact).otherwise(F.least(rough(lo), rough(hi)))


def _second_pass(batches: Iterable[pa.RecordBatch], k: int, num: int, den: int, sketch) -> Iterator[pa.RecordBatch]:
    """Kept tokens of each set, and the whole set where it is marked."""
    counts = sketch.value
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("kept", pa.list_(pa.int64())), ("tokens", pa.binary())])
    for batch, texts in chunks(batches):
        whole = batch.column(batch.schema.get_field_index("whole")).to_pylist()
        size, kept, tokens = [], [], []
        for x, w in zip(shingle_sets(texts, k), whole, strict=True):
            keep = len(x) - required(len(x), num, den) + NEED
            rare = counts[(x & U64((1 << SKETCH_BITS) - 1)).astype(np.int64)].astype(U64) << U64(32) | (mix(x) >> U64(32))
            # Ties of the 64-bit order (equal counter and equal half of the mixed hash) fall to the token's own order.
            order = np.argsort(rare, kind="stable")[:keep]
            size.append(len(x))
            kept.append(as_long(x[order]))
            tokens.append(x.tobytes() if w else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(kept, pa.list_(pa.int64())), pa.array(tokens, pa.binary())], schema=schema)


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct values."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    if min(len(x), len(y)) * den < max(len(x), len(y)) * num:
        return False
    both = common(x, y)
    return both * den >= (len(x) + len(y) - both) * num


def bin_minima(x: np.ndarray) -> np.ndarray:
    """The least hash of a set in each of ``BINS`` bins (16 bits of it; ``EMPTY`` where there is none): sets share about as many as they are similar."""
    y = np.sort(mix(x))
    at = np.searchsorted(y, _BIN_STARTS)
    has = np.diff(np.append(at, len(y))) > 0
    out = np.full(BINS, EMPTY, np.uint16)
    out[has] = (y[at[has]] >> U64(32)).astype(np.uint16) & np.uint16(EMPTY - 1)
    return out


def _stars(docs: np.ndarray, minima: np.ndarray, least: float) -> Iterator[tuple[int, int, float]]:
    """Star clusters of one cell by bin minima: each member, the leader of smaller id that it seems most similar to, and how similar; without one it leads."""
    leaders: list[int] = []
    for i, x in enumerate(minima):
        y = minima[leaders]
        filled = (y != EMPTY) | (x != EMPTY)
        alike = ((y == x) & filled).sum(axis=1) / np.maximum(filled.sum(axis=1), 1)
        best = int(alike.argmax()) if leaders else 0
        if leaders and alike[best] >= least:
            yield docs[i], docs[leaders[best]], alike[best]
        else:
            leaders.append(i)


def _cell_stars(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Star clusters of the cells, whose rows come one after another."""

    def clusters(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        cell, docs = (table.column(c).to_numpy() for c in ("cell", "doc_id"))
        minima = np.frombuffer(b"".join(table.column("minima").to_pylist()), np.uint16).reshape(len(docs), BINS)
        edges = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1], [True])))
        pairs = [p for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1 for p in _stars(docs[a:b], minima[a:b], least)]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "alike"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = batch.column(0).to_numpy()
        cut = int(np.append(np.flatnonzero(cell != cell[-1]), -1).max()) + 1  # where the batch's last cell begins
        if cut or (held and held[-1].column(0)[held[-1].num_rows - 1].as_py() != cell[0]):
            yield clusters([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield clusters(held)


def _verify(batches: Iterable[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        c = {n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)}
        ok = [linked(np.frombuffer(x, U64), np.frombuffer(y, U64), num, den) for x, y in zip(c["ta"], c["tb"], strict=True)]
        yield pa.RecordBatch.from_pydict({n: [v for v, good in zip(c[n], ok, strict=True) if good] for n in ("a", "b")}, pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _ends(pairs: DataFrame) -> DataFrame:
    """The documents in pairs ``(a, b)``."""
    return pairs.select(F.col("a").alias("doc_id")).distinct().union(pairs.select(F.col("b").alias("doc_id")).distinct()).distinct()


def _families(open_: DataFrame, seen: DataFrame, num: int, den: int) -> DataFrame:
    """``(a, b)``: each document that seems to be near another one, and the document that its family stands around."""
    each = open_.select("doc_id", F.explode(F.array(*(F.struct(F.lit(r).alias("r"), F.col(f"m{r}").alias("m")) for r in range(ROUNDS)))).alias("h")).select("doc_id", "h.*")
    shared = stored(each.groupBy("r", "m").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    cells = each.join(shared, ["r", "m"]).select("doc_id", F.xxhash64("r", "m", F.pmod(F.xxhash64("doc_id", "r"), F.ceil(F.col("size") / CELL))).alias("cell"))
    members = join_ids(seen.select("doc_id", "minima"), stored(cells, "cells"), "doc_id", "inner").select("cell", "doc_id", "minima")
    pairs = members.repartition("cell").sortWithinPartitions("cell", "doc_id").mapInArrow(partial(_cell_stars, least=num / den - DOUBT), "a long, b long, alike double")
    best = F.max(F.struct(F.col("alike"), (-F.col("b")).alias("b"))).alias("best")
    near = stored(pairs.where("a <> b").groupBy("a").agg(best).select("a", (-F.col("best.b")).alias("b")), "likely")
    for _ in range(JUMPS):  # a leader may itself have taken one: go on to that
        near = stored(near.join(near.toDF("b", "c"), "b", "left").select("a", F.coalesce("c", "b").alias("b")), "families")
    return near


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of the sets of a and b, of what they have in common, and what differs: tokens of a alone as they are, of b alone inverted."""
    for batch in batches:
        sizes, both, delta = [], [], []
        ta, tb, more = (batch.column(batch.schema.get_field_index(c)) for c in ("ta", "tb", "more"))
        for x, y, m in zip(ta, tb, more.to_pylist(), strict=True):
            x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
            own = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] != x
            sizes.append((len(x), len(y)))
            both.append(int(len(x) - own.sum()))
            delta.append(as_long(np.concatenate((x[own], ~y[x[np.minimum(np.searchsorted(x, y), len(x) - 1)] != y]))) if m else [])
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "home")]
        yield pa.RecordBatch.from_arrays([*keep, *(pa.array([s[k] for s in sizes], pa.int64()) for k in (0, 1)), pa.array(both, pa.int64()), pa.array(delta, pa.list_(pa.int64()))], names=["a", "b", "home", "n", "m", "both", "delta"])


COMPARED = "a long, b long, home boolean, n long, m long, both long, delta array<long>"


def _pairs_of_families(compared: DataFrame, near: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of documents, still apart, that may reach the threshold, of those that were compared with the same family's centre.

    A of n tokens lacks M of the centre's m and has some that the centre lacks; so does C.  A and C have (m - |M| - |M'| + what both lack
    + what both have beside) tokens in common; to reach t they need ceil(t / (1 + t) (n + n')).  So the tokens that set them apart from the centre
    must have at least r = ceil(t / (1 + t) (n + n')) - m + |M| + |M'| in common; where r < 1, both reach t with the centre itself.  Of d such tokens
    of a document, its d - r + 1 rarest in the family are looked up, r for the family's most fitting partner.
    """
    share = num / (num + den)
    lacks = F.col("m") - F.col("both")
    apart = 1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))
    rows = compared.where(F.size("delta") > 0).join(near.toDF("a", "c"), "a", "left").withColumn("c", F.coalesce("c", "a")).withColumn("apart", apart)
    family = rows.groupBy("b").agg(F.max(F.when(F.col("home"), F.col("apart"))).alias("radius"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(share * F.col("n") + lacks).alias("least"))
    need = F.greatest(F.ceil(share * F.col("n") - F.col("m") + lacks + F.col("least") - 1e-6), F.lit(1))
    rows = rows.join(family, "b").where((F.col("lo") < F.col("hi")) & (F.col("apart") <= F.col("radius") + (1 - num / den) + 1e-9))
    tokens = stored(rows.select("b", "a", "home", "c", F.size("delta").alias("d"), need.alias("need"), "n", "m", lacks.alias("lacks"), F.explode("delta").alias("token")), "deltas")
    often = tokens.groupBy("b", "token").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    own = Window.partitionBy("b", "a")  # the tokens of one document
    ranked = tokens.join(often, ["b", "token"]).withColumn("rank", F.row_number().over(own.orderBy("often", "token"))).withColumn("shared", F.count(F.lit(1)).over(own))
    looked = stored(ranked.where("rank + d - shared <= d - need + 1").select("b", "token", "a", "home", "c", "need", "n", "m", "lacks"), "looked")
    other = looked.drop("m").toDF("b", "token", *(f"{x}2" for x in ("a", "home", "c", "need", "n", "lacks")))
    pairs = looked.join(other, ["b", "token"]).where("a < a2 and c <> c2 and (home or home2)")
    # The one of the two whose looked-up tokens end first has need - 1 more; all others that both have are among those looked up.
    enough = F.count(F.lit(1)) + F.max(F.greatest("need", "need2")) - 1 >= F.max(F.ceil((F.col("n") + F.col("n2")) * num / (num + den)) - F.col("m") + F.col("lacks") + F.col("lacks2"))
    return pairs.groupBy("b", "a", "a2").agg(enough.alias("enough")).where("enough").select("a", F.col("a2").alias("b")).distinct()


def similar_documents(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Components of the documents whose shingle sets have a Jaccard similarity of at least num / den (over 1 / 2).

    ``docs``: ``doc_id`` (integer) and ``text``; more columns are ignored.  Words are runs of bytes other than space
    and x09-x0D with A-Z lower-cased; a set holds the distinct shingles of k words of the whole text, or the whole sequence
    as one where there are fewer words.  Null, empty and blank texts have the empty set and link with nothing.  Rows
    with a null ``doc_id`` are left out; one that is repeated with other texts is one document that links wherever one of its texts does.  Returns ``doc_id, n_shingles, component_id`` for each document.
    """
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    first = stored(docs.mapInArrow(partial(_first_pass, k=k), PASS1), "first")
    seen = first.where("doc_id is not null").drop("part", "counts")
    classes = stored(
        seen.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("doc_id"), *(F.min(f"m{r}").alias(f"m{r}") for r in range(ROUNDS))),
        "classes",
    )
    # Sets that differ and reach t = num / den share at least t / (1 - t) tokens.
    open_ = classes.where(F.col("n") >= max(NEED, required(num, 1, den - num)))
    families = _families(open_, seen, num, den)
    wanted = stored(_ends(families).withColumn("whole", F.lit(True)), "wanted")
    gone = stored(seen.select("doc_id").join(open_.select("doc_id"), "doc_id", "left_anti").distinct(), "gone")
    sketch = spark.sparkContext.broadcast(_sketch(first))
    second = partial(_second_pass, k=k, num=num, den=den, sketch=sketch)
    texts = join_ids(docs, wanted, "doc_id", "left")
    sets = stored(join_ids(texts.mapInArrow(second, PASS2), gone, "doc_id", "left_anti"), "sets")  # copies and tiny sets have no links of their own
    whole = sets.where("tokens is not null").select("doc_id", "tokens")

    kept = join_ids(sets.select("doc_id", "n", "kept"), families.toDF("doc_id", "gid"), "doc_id", "left").select("doc_id", "n", F.coalesce("gid", "doc_id").alias("gid"), F.explode("kept").alias("token"))
    several = stored(kept.groupBy("token").agg(F.min("gid").alias("lo"), F.max("gid").alias("hi")).where("lo <> hi").select("token"), "several")
    kept = stored(kept.join(several, "token"), "kept")
    matrix = kept.groupBy("token", "gid").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max")).toDF("token", "group", "n_min", "n_max")
    fits = (F.col("n") * den >= F.col("n_min") * num) & (F.col("n_max") * den >= F.col("n") * num)
    opened = kept.join(matrix, "token").where((F.col("gid") > F.col("group")) & fits).groupBy("doc_id", "n", "group")
    opened = opened.agg(F.count(F.lit(1)).alias("hits"), F.min("n_min").alias("n_min"), F.max("n_max").alias("n_max")).where(F.col("hits") >= least_hits("n", "n_min", "n_max", num, den))
    entries = families.withColumn("home", F.lit(True)).union(opened.select("doc_id", "group", F.lit(False)).distinct())
    several_homes = families.groupBy("b").agg(F.lit(True).alias("more"))
    entries = stored(entries.join(several_homes, "b", "left").select("a", "b", "home", F.coalesce("more", F.lit(False)).alias("more")).where("a <> b"), "leaders")

    def with_sets(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with both sets; those that aren't at hand are made again from the texts."""
        lacking = stored(_ends(pairs).join(wanted, "doc_id", "left_anti"), "lacking")
        more = join_ids(docs, lacking, "doc_id", "inner").withColumn("whole", F.lit(True)).mapInArrow(second, PASS2).select("doc_id", "tokens")
        both = whole.union(stored(more, "more"))
        return pairs.join(both.toDF("a", "ta"), "a").join(both.toDF("b", "tb"), "b")

    compared = stored(with_sets(entries).select("a", "b", "home", "more", "ta", "tb").mapInArrow(_compare, COMPARED), "compared")
    links = compared.where((F.col("both") * (num + den) >= (F.col("n") + F.col("m")) * num) & (F.col("a") != F.col("b"))).select("a", "b")
    near = connected_components(links).toDF("a", "c")
    pairs = stored(_pairs_of_families(compared, near, num, den), "pairs")
    verified = with_sets(pairs).select("a", "b", "ta", "tb").mapInArrow(partial(_verify, num=num, den=den), "a long, b long")
    links = stored(links.union(verified), "links")
    labels = connected_components(links).toDF("doc_id", "component_id")
    named = stored(classes.join(labels, "doc_id", "left").select("n", "s1", "s2", F.coalesce("component_id", "doc_id").alias("component_id")), "named")
    return seen.join(named, ["n", "s1", "s2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(read_table(spark, sf_dir, "documents"), 3, 90, 100)
