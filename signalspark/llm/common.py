"""Helpers shared by the operators: stored intermediate tables, checked broadcasts, text batches, word hashes."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.session import scratch_dir

#: Rows of ids (8 to 40 bytes each) that may be broadcast; beyond it the same join is shuffled.
BROADCAST_IDS = 500_000
#: Bytes of text that a task takes apart at a time.
CHUNK_BYTES = 2 << 20
#: Bytes that are hashed at a time.
BLOCK_BYTES = 1 << 20
#: Entries of a worker's memo of words; it is emptied when full.
MEMO_WORDS = 200_000

T = TypeVar("T")
U64 = np.uint64
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_dir(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Send at most ``rows`` rows at a time to the session's Python workers, if that is fewer than it does: for jobs whose rows are whole texts.

    A batch is in memory twice over in the JVM and again in the worker, for each core of an executor.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def join_ids(df: DataFrame, ids: DataFrame, key: str, how: str, max_rows: int = BROADCAST_IDS) -> DataFrame:
    """Join ``df`` with a stored table of small rows; broadcast only when its counted rows are at most ``max_rows``."""
    if ids.limit(max_rows + 1).count() <= max_rows:
        ids = F.broadcast(ids)
    else:
        ids = ids.hint("merge")
    return df.join(ids, key, how)


#: glibc's function that gives free pages back, where there is one.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: The memo that a worker keeps between tasks: {arguments: (the task that last asked for it, memo)}.
_MEMO: dict[tuple, tuple] = {}


def _task() -> int | None:
    context = TaskContext.get()
    return context and context.taskAttemptId()


def worker_memo(make: Callable[..., T], *args) -> T:
    """``make(*args)``, kept for the worker's next tasks until one of them asks for another, or calls ``chunks`` without asking for it."""
    key = (make, *args)
    if key not in _MEMO:
        _MEMO.clear()
        _MEMO[key] = None, make(*args)
    _MEMO[key] = _task(), _MEMO[key][1]
    return _MEMO[key][1]


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches holding about ``limit`` bytes of text at most (one row at least), null as b''.

    A batch is cut before its texts become Python objects, so a task holds the objects of one slice at a time.
    """
    if not any(task == _task() for task, _ in _MEMO.values()):
        _MEMO.clear()  # of an operator that ran in this worker earlier
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            upto = (ends[start - 1] if start else 0) + limit
            stop = max(start + 1, int(np.searchsorted(ends, upto, side="right")))
            part = column.slice(start, stop - start)
            yield batch.slice(start, stop - start), [v or b"" for v in part.to_pylist()]
            start = stop
        # Several workers share an executor's memory, so what is free goes back.
        pa.default_memory_pool().release_unused()
        if _TRIM is not None:
            _TRIM(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and fold twice)."""
    x = (x ^ (x >> U64(31))) * U64(ODD[0])
    x = (x ^ (x >> U64(29))) * U64(ODD[1])
    return x ^ (x >> U64(32))


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Bytes as they are compared: A-Z lower-cased, white space as one kind.
_COMPARED = bytes(32 if _SPACE[c] else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The first n bytes of a little-endian number of 8.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], U64)
#: Bytes of the longest word that is hashed 8 at a time beside others; longer ones are hashed by themselves.
LONG_WORD = 64


def _words(compared: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes, which end in a space, start and end."""
    word = np.frombuffer(compared, np.uint8) != 32
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.append(0, edge)
    return edge[::2], edge[1::2]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end."""
    return _words(text.translate(_COMPARED) + b" ")


def _hash_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of some bytes, and where they start."""
    text = block.translate(_COMPARED) + b" " * 8
    raw = np.frombuffer(text, np.uint8)
    begin, end = _words(text)
    size = end - begin
    eights = np.ndarray((len(raw) - 7,), "<u8", text, strides=(1,))
    h = mix((eights[begin] & _FIRST_BYTES[np.minimum(size, 8)]) + size.astype(U64) * U64(ODD[4]))
    more, done = np.flatnonzero((size > 8) & (size <= LONG_WORD)), 8
    while len(more):
        part = eights[begin[more] + done] & _FIRST_BYTES[np.minimum(size[more] - done, 8)]
        h[more] = mix((h[more] ^ part) * U64(ODD[3]) + U64(done))
        done += 8
        more = more[size[more] > done]
    for i in np.flatnonzero(size > LONG_WORD):
        h[i] = xxhash.xxh3_64_intdigest(text[begin[i] : begin[i] + size[i]])
    return h, begin


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words start (one more entry than texts).

    A word is a run of bytes other than space and x09-x0D; A-Z are lower-cased.
    """
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    hashes, begins, at = [], [], 0
    while at < len(raw):
        end = at + BLOCK_BYTES
        while end < len(raw):  # cut at white space
            gaps = np.flatnonzero(_SPACE[raw[end : end + BLOCK_BYTES]])
            if len(gaps):
                end += int(gaps[0])
                break
            end += BLOCK_BYTES
        h, begin = _hash_block(joined[at:end])
        hashes.append(h)
        begins.append(begin + at)
        at = end
    flat = np.concatenate(hashes) if hashes else np.empty(0, U64)
    where = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return flat, np.searchsorted(np.concatenate(begins) if begins else np.empty(0, np.int64), where).astype(np.int64)


def gram_hashes(flat: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes; entry i covers words i to i + k - 1."""
    n = len(flat) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    acc = np.zeros(n, U64)
    for j in range(k):
        acc = acc * U64(ODD[2]) + flat[j : j + n]
    return mix(acc)


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Counters in one row of a task's counts, and slots of the first round of their sum.
COUNTS_ROW, COUNTS_SLOTS = 1 << 14, 256


def count_rows(total: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """``part`` and ``counts`` columns that hold a task's counters (a multiple of COUNTS_ROW of them) for ``sum_counts``."""
    parts = total.astype(np.int64).reshape(-1, COUNTS_ROW)
    return pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())


def _add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in rows["counts"])
    return pd.DataFrame({"part": [rows["part"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})


def sum_counts(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of the tasks' counters in two rounds; the driver gets ``size`` numbers whatever the input."""
    slot = F.pmod(F.xxhash64("counts"), F.lit(COUNTS_SLOTS)).alias("slot")
    first = rows.select("part", "counts").groupBy("part", slot).applyInPandas(_add_counts, "part int, counts binary")
    out = np.zeros((size // COUNTS_ROW, COUNTS_ROW), np.int64)
    for r in first.groupBy("part").applyInPandas(_add_counts, "part int, counts binary").collect():
        out[r["part"]] = np.frombuffer(zlib.decompress(bytes(r["counts"])), np.int64)
    return out.ravel()
