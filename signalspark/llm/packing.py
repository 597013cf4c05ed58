"""Operator 8: packing of token sequences by the linear grouping scheme, then best fit.

1. Documents are cut into pieces of at most ``CAPACITY`` tokens.  Pieces above ``SMALL`` tokens are large.
2. Large pieces, ordered by length, are cut into ``GROUPS`` groups of equal cardinality; within a group lengths count as the group's largest.
3. Few sizes are left, so configurations (how many of each group fill a sequence) are found on the driver from the
   group sizes alone: for the largest size left, the best bounded subset sum of the others, used as often as it lasts.
4. Actual pieces take the places of their group's size; a sequence's real room is what they leave.
5. Small pieces go, longest first, to the sequences with the least room that holds them (best fit), again planned on counts by
   length and by room, and new sequences take the rest.

The driver sees only counts by length (at most ``CAPACITY`` + 1 of them), never rows.  Rows find their place by their rank among the rows of
equal length, which is summed from ranks within the tasks that made them, so one frequent length is no single task's work.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalspark.llm.common import chunks, read_table, stored
from signalspark.llm.token_ids import encoder

CAPACITY = 2048
SMALL = 128
GROUPS = 256
#: Id that ends each document.
END_ID = 0

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


def _pieces(batches: Iterable[pa.RecordBatch], vocabulary: str, capacity: int) -> Iterator[pa.RecordBatch]:
    enc, end, step = encoder(vocabulary), np.array([END_ID], "<u4").tobytes(), 4 * capacity
    for batch, texts in chunks(batches):
        rows: list[list] = [[], [], [], [], []]
        for doc, ids in zip(batch.column(0).to_pylist(), enc.encode(texts), strict=True):
            ids += end
            for k, at in enumerate(range(0, len(ids), step)):
                cut = ids[at : at + step]
                for col, v in zip(rows, (doc, k, at // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(rows, PIECE, strict=True)], schema=PIECE)


def _local_ranks(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and the rank of each row among the task's rows of equal key."""
    part, seen = TaskContext.get().partitionId(), defaultdict(int)
    for b in batches:
        keys = b.column(b.schema.get_field_index(key)).to_pylist()
        ranks = []
        for k in keys:
            ranks.append(seen[k])
            seen[k] += 1
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(keys), pa.int32()), pa.array(ranks, pa.int64())], names=[*b.schema.names, "part", "local_rank"])


def ranked(df: DataFrame, key: str, name: str) -> tuple[DataFrame, dict[int, int]]:
    """``df`` with ``rank`` (0, 1, ... among rows of equal key) and the rows of each key; keys are few, rows are not."""
    schema = ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", part int, local_rank long"
    rows = stored(df.mapInArrow(partial(_local_ranks, key=key), schema), name)
    counts = stored(rows.groupBy(key, "part").agg(F.count(F.lit(1)).alias("n")), f"{name}-counts")
    before = counts.select(key, "part", (F.sum("n").over(Window.partitionBy(key).orderBy("part")) - F.col("n")).alias("before"))
    totals = {r[key]: r["n"] for r in counts.groupBy(key).agg(F.sum("n").alias("n")).collect()}
    return rows.join(before, [key, "part"]).withColumn("rank", F.col("before") + F.col("local_rank")).drop("part", "local_rank", "before"), totals


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """``[({group: pieces in a sequence}, sequences), ...]`` that use all of ``counts``; sizes in descending order."""
    left, plan = list(counts), []
    for g, size in enumerate(sizes):
        while left[g]:
            room = capacity - size
            reach, masks = 1, []
            for i in range(g, len(sizes)):  # bit s of reach: the sum s can be had from the groups so far
                masks.append(reach)
                if sizes[i] <= room:
                    more = reach
                    for _ in range(min(left[i] - (i == g), room // sizes[i])):
                        more = reach | more << sizes[i]
                    reach = more & ((1 << (room + 1)) - 1)
            total = reach.bit_length() - 1
            use: dict[int, int] = defaultdict(int, {g: 1})
            for i in range(len(sizes) - 1, g - 1, -1):
                while not masks[i - g] >> total & 1:
                    total -= sizes[i]
                    use[i] += 1
            times = min(left[i] // n for i, n in use.items())
            for i, n in use.items():
                left[i] -= n * times
            plan.append((dict(use), times))
    return plan


def place_large(totals: dict[int, int], capacity: int, groups: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], dict[int, int], int]:
    """Places of the large pieces: ``{group: [(first, each, times, sequence), ...]}``, ``{length: rank of its first piece}``, sequences.

    The group of the piece of rank r (longest first) is r // ceil(pieces / groups); from place ``first`` on, ``each`` pieces go
    to each of ``times`` sequences.
    """
    base, n, sizes = {}, 0, []
    for length in sorted(totals, reverse=True):
        base[length] = n
        n += totals[length]
    if not n:
        return {}, base, 0
    card = -(-n // groups)
    starts = sorted((b, length) for length, b in base.items())
    ranks = [b for b, _ in starts]
    for first in range(0, n, card):
        sizes.append(starts[bisect_right(ranks, first) - 1][1])
    counts = [min(card, n - first) for first in range(0, n, card)]
    places, used, sequence = defaultdict(list), [0] * len(sizes), 0
    for use, times in configurations(sizes, counts, capacity):
        for g, each in use.items():
            places[g].append((used[g], each, times, sequence))
            used[g] += each * times
        sequence += times
    return dict(places), base, sequence


def place_small(small: dict[int, int], room: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Best fit on counts: ``{length: [(first, room class, bin, each), ...]}`` and the number of new sequences.

    From rank ``first`` on, ``each`` pieces go to each bin of the class (a sequence's room before any small piece; -1: a new
    sequence), from number ``bin`` on.
    """
    bins: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room now -> (class, first bin, bins)
    for r, n in room.items():
        bins[r].append((r, 0, n))
    plan: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    opened = 0
    for s in sorted(small, reverse=True):
        rank, left = 0, small[s]

        def put(now: int, cls: int, first: int, n: int) -> None:
            nonlocal rank, left
            each = now // s
            full = min(n, left // each)
            plan[s].append((rank, cls, first, each))
            if full:
                bins[now - each * s].append((cls, first, full))
            taken = full * each
            if full < n and left > taken:  # the last bin takes fewer
                bins[now - (left - taken) * s].append((cls, first + full, 1))
                full, taken = full + 1, left
            if full < n:
                bins[now].append((cls, first + full, n - full))
            rank, left = rank + taken, left - taken

        for now in [r for r in sorted(bins) if r >= s]:
            waiting = bins.pop(now)
            while waiting and left:
                put(now, *waiting.pop())
            bins[now] += waiting
            if not left:
                break
        if left:
            need = -(-left // (capacity // s))
            first, opened = opened, opened + need
            put(capacity, -1, first, need)
    return dict(plan), opened


def _seat_large(batches: Iterable[pa.RecordBatch], places, base, card) -> Iterator[pa.RecordBatch]:
    firsts = {g: [p[0] for p in ps] for g, ps in places.items()}
    for b in batches:
        length, rank = b.column(b.schema.get_field_index("length")).to_pylist(), b.column(b.schema.get_field_index("rank")).to_pylist()
        seats = []
        for n, r in zip(length, rank, strict=True):
            g, j = divmod(base[n] + r, card)
            first, each, _, sequence = places[g][bisect_right(firsts[g], j) - 1]
            seats.append(sequence + (j - first) // each)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(seats, pa.int64())], names=[*b.schema.names, "sequence_id"])


def _seat_small(batches: Iterable[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    firsts = {s: [p[0] for p in ps] for s, ps in plan.items()}
    for b in batches:
        length, rank = b.column(b.schema.get_field_index("length")).to_pylist(), b.column(b.schema.get_field_index("rank")).to_pylist()
        classes, bins = [], []
        for n, r in zip(length, rank, strict=True):
            first, cls, at, each = plan[n][bisect_right(firsts[n], r) - 1]
            classes.append(cls)
            bins.append(at + (r - first) // each)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(classes, pa.int64()), pa.array(bins, pa.int64())], names=[*b.schema.names, "room", "bin"])


def _with(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"{c} {t}" for c, t in df.dtypes), *more])


def pack_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", capacity: int = CAPACITY, small: int = SMALL, groups: int = GROUPS) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``capacity`` tokens.

    A document is the ids of its whole text and then id 0; a null or empty text is that id alone.  Only documents above
    ``capacity`` are cut.  Rows of ``docs (doc_id, text, ...)`` are packed each for itself, repeated and null ids too; other columns are
    ignored.  Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``; offsets in a sequence start at 0
    without gaps (longest piece first).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    pieces = rows.mapInArrow(partial(_pieces, vocabulary=vocabulary, capacity=capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces, totals = ranked(pieces, "length", "pieces")
    big = {n: c for n, c in totals.items() if n > small}
    places, base, sequences = place_large(big, capacity, groups)
    card = max(1, -(-sum(big.values()) // groups))
    large = pieces.where(F.col("length") > small)
    large = stored(large.mapInArrow(partial(_seat_large, places=places, base=base, card=card), _with(large, "sequence_id long")).drop("rank"), "large")
    room, rooms = ranked(large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("room")), "room", "rooms")
    plan, _ = place_small({n: c for n, c in totals.items() if n <= small}, rooms, capacity)
    plan = spark.sparkContext.broadcast(plan)  # at most small * capacity entries
    few = pieces.where(F.col("length") <= small)
    few = few.mapInArrow(lambda bs: _seat_small(bs, plan.value), _with(few, "room long", "bin long")).drop("rank")
    few = few.join(room.select("room", F.col("rank").alias("bin"), "sequence_id"), ["room", "bin"], "left")
    few = few.withColumn("sequence_id", F.coalesce("sequence_id", F.lit(sequences) + F.col("bin"))).drop("room", "bin")
    seats = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return large.unionByName(few).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.coalesce(F.sum("length").over(seats), F.lit(0)).alias("offset"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
