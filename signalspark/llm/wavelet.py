"""Operator 10: token ids in wavelet-matrix files.

A file holds the ids of consecutive documents as bit planes, highest bit first.  Each plane stores one bit of every id, in the
order made by the planes before it: ids with a 0 there keep their order in front, those with a 1 follow.  With counts of ones before each
``BLOCK`` bits, a token is read, counted up to a position or found by occurrence in one step for each plane.

``write_ids`` encodes the texts where they are read and stores their ids, so that ids and not texts are sorted by document with a range
partitioning; a task makes a file of its range whenever ``FILE_IDS`` ids are full (a document stays in one file).  A file is one row of a
Parquet folder; Spark's commit keeps the folder whole when executors are lost.  Its bytes are a header, the documents' ids and
lengths, each plane's counts of ones, and the planes in zstandard-compressed chunks of ``CHUNK`` bits: a lookup inflates the chunks
that it touches only.  ``count_token`` and ``find_token`` ask all files of a folder.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalspark.llm.common import chunks, read_table, stored
from signalspark.llm.token_ids import encoder, id_code
from signalspark.session import scratch_dir

#: Ids after which a file is closed at the next end of a document.
FILE_IDS = 1 << 20
#: Id appended to each document.
END_ID = 2
#: Bits between two entries of a plane's rank directory, and bits of a plane that are compressed together.
BLOCK, CHUNK = 4096, 1 << 17
#: Bytes of ids for which a range of documents is made.
RANGE_BYTES = 8 << 20
#: Entries of a generation of the encoder's memo, and bytes it cuts at a time: more than by default, as no other stage shares the workers.
MEMO_ENTRIES, ENCODED_BYTES = 500_000, 2 << 20
MAGIC = b"WMX2"


class WaveletMatrix:
    """Ids as bit planes, each cut into chunks, with the ones before each block of each plane.

    ``chunk(k, c)`` gives the bytes of chunk c of plane k.
    """

    def __init__(self, n: int, ones: list[np.ndarray], chunk: Callable[[int, int], np.ndarray]):
        self.n, self.ones, self.chunk = n, ones, chunk
        self.zeros = [n - int(o[-1]) for o in ones]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        planes, ones, a = [], [], ids
        for bit in range(max(1, int(ids.max(initial=0)).bit_length()) - 1, -1, -1):
            one = (a >> a.dtype.type(bit) & a.dtype.type(1)).astype(bool)
            planes.append(np.packbits(one, bitorder="little"))
            padded = np.zeros(-(-len(a) // BLOCK) * BLOCK // 8, np.uint8)
            padded[: len(planes[-1])] = planes[-1]
            each = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.int64)
            ones.append(np.concatenate(([0], np.cumsum(each))))
            a = np.concatenate((a.take(np.flatnonzero(~one)), a.take(np.flatnonzero(one))))
        return cls(len(ids), ones, lambda k, c: planes[k][c * CHUNK // 8 : (c + 1) * CHUNK // 8])

    @property
    def chunks(self) -> int:
        """Chunks of each plane."""
        return -(-self.n // CHUNK)

    def decode(self) -> np.ndarray:
        """All ids: the planes undone from the last to the first."""
        out = np.zeros(self.n, np.uint16 if len(self.ones) <= 16 else np.uint32)
        for k in range(len(self.ones) - 1, -1, -1):
            plane = np.concatenate([np.empty(0, np.uint8), *(self.chunk(k, c) for c in range(self.chunks))])
            one = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            before = np.empty_like(out)
            before[np.flatnonzero(~one)] = out[: self.zeros[k]]
            before[np.flatnonzero(one)] = out[self.zeros[k] :] | out.dtype.type(1 << (len(self.ones) - 1 - k))
            out = before
        return out

    def _rank(self, k: int, i: int) -> int:
        """Ones among the first i bits of plane k."""
        at = i // BLOCK
        n, rest = int(self.ones[k][at]), i - at * BLOCK
        if rest:
            first = at * BLOCK % CHUNK // 8
            n += int(np.unpackbits(self.chunk(k, at * BLOCK // CHUNK)[first : first + BLOCK // 8], count=rest, bitorder="little").sum())
        return n

    def _select(self, k: int, bit: int, places: np.ndarray) -> np.ndarray:
        """Positions of the bits of plane k that are the j-th (from 0) ``bit`` of it, for each j of ``places`` (ascending)."""
        ends = np.minimum(np.arange(self.chunks + 1) * CHUNK, self.n)
        seen = self.ones[k][-(-ends // BLOCK)]
        seen = seen if bit else ends - seen
        cuts, out = np.searchsorted(places, seen), []
        for c in np.flatnonzero(cuts[1:] > cuts[:-1]):
            bits = np.unpackbits(self.chunk(k, int(c)), count=int(ends[c + 1] - ends[c]), bitorder="little")
            out.append(ends[c] + np.flatnonzero(bits == bit)[places[cuts[c] : cuts[c + 1]] - seen[c]])
        return np.concatenate([np.empty(0, np.int64), *out])

    def __getitem__(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(len(self.ones)):
            before = self._rank(k, i)
            one = int(self.chunk(k, i // CHUNK)[i % CHUNK // 8]) >> (i % 8) & 1
            value = value << 1 | one
            i = self.zeros[k] + before if one else i - before
        return value

    def _span(self, token: int, start: int, end: int) -> tuple[int, int]:
        if token < 0 or token >> len(self.ones):
            return 0, 0
        for k in range(len(self.ones)):
            a, b = self._rank(k, start), self._rank(k, end)
            if token >> (len(self.ones) - 1 - k) & 1:
                start, end = self.zeros[k] + a, self.zeros[k] + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of a token in positions start to end - 1."""
        a, b = self._span(token, start, self.n if end is None else end)
        return b - a

    def positions(self, token: int, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Positions of the occurrences first to stop - 1 (all by default) of a token, ascending."""
        a, b = self._span(token, 0, self.n)
        places = np.arange(a + first, b if stop is None else min(b, a + stop))
        for k in range(len(self.ones) - 1, -1, -1):
            one = token >> (len(self.ones) - 1 - k) & 1
            places = self._select(k, one, places - self.zeros[k] if one else places)
        return places

    def find(self, token: int, j: int) -> int:
        """Position of the j-th (from 0) occurrence of a token; -1 if there are fewer."""
        at = self.positions(token, j, j + 1) if j >= 0 else ()
        return int(at[0]) if len(at) else -1


def to_file(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """Header, documents (0 and a flag for a null id), counts of ones, chunks of planes."""
    packer = zstandard.ZstdCompressor(level=1)
    m = WaveletMatrix.build(ids.astype(np.uint16) if ids.max(initial=0) < 1 << 16 else ids)
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array(lengths, "<i8").tobytes() + bytes(d is None for d in doc_ids)
    ones = np.array(m.ones, "<i8").tobytes()
    parts = [packer.compress(docs), packer.compress(ones), *(packer.compress(m.chunk(k, c).tobytes()) for k in range(len(m.ones)) for c in range(m.chunks))]
    return MAGIC + struct.pack(f"<qqII{len(parts)}q", len(ids), len(doc_ids), len(m.ones), len(parts), *map(len, parts)) + b"".join(parts)


def from_file(blob: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Documents' ids, their lengths and the matrix of a file, whose chunks are inflated as they are asked for."""
    if blob[:4] != MAGIC:
        raise ValueError("not a wavelet-matrix file")
    n, n_docs, n_planes, n_parts = struct.unpack_from("<qqII", blob, 4)
    ends = 28 + 8 * n_parts + np.cumsum([0, *struct.unpack_from(f"<{n_parts}q", blob, 28)])
    unpacker = zstandard.ZstdDecompressor()

    def part(i: int) -> bytes:
        return unpacker.decompress(blob[ends[i] : ends[i + 1]])

    head, per_plane = part(0), -(-n // CHUNK)
    docs = np.frombuffer(head, "<i8", 2 * n_docs)
    doc_ids = [None if null else int(d) for d, null in zip(docs[:n_docs], head[16 * n_docs :], strict=True)]
    ones = np.frombuffer(part(1), "<i8").reshape(n_planes, -1)

    @lru_cache(maxsize=4 * n_planes)
    def chunk(k: int, c: int) -> np.ndarray:
        return np.frombuffer(part(2 + k * per_plane + c), np.uint8)

    return doc_ids, docs[n_docs:], WaveletMatrix(n, list(ones), chunk)


def _encode(batches: Iterable[pa.RecordBatch], vocabulary: str, code: str) -> Iterator[pa.RecordBatch]:
    enc, end = encoder(vocabulary, code, MEMO_ENTRIES, ENCODED_BYTES), array(code, [END_ID])
    for batch, texts in chunks(batches):
        ids = [i + end.tobytes() for i in enc.encode(texts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) // end.itemsize for i in ids], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "n", "ids"])


def _write(batches: Iterable[pa.RecordBatch], code: str) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    docs, lengths, held, size, number = [], [], [], 0, 0

    def close() -> pa.RecordBatch:
        blob = to_file(docs, lengths, np.frombuffer(b"".join(held), f"<u{array(code).itemsize}"))
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(docs)], pa.int64()), pa.array([size], pa.int64()), pa.array([blob], pa.binary())], names=["part", "number", "n_docs", "n_ids", "file"])

    for batch, ids in chunks(batches, "ids"):
        for doc, n, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), ids, strict=True):
            docs.append(doc)
            lengths.append(n)
            held.append(i)
            size += n
            if size >= FILE_IDS:
                yield close()
                docs, lengths, held, size, number = [], [], [], 0, number + 1
    if docs:
        yield close()


def write_ids(docs: DataFrame, path: str, vocabulary: str = "word_bpe_49k.json", range_bytes: int = RANGE_BYTES) -> None:
    """Write the ids of all whole texts (null: empty), each followed by id 2, in ascending ``doc_id`` order to files at ``path``.

    Null ids come first; repeated ids stay repeated, in any order among themselves; other columns are ignored.
    """
    code = id_code(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    ids = stored(rows.mapInArrow(partial(_encode, vocabulary=vocabulary, code=code), "doc_id long, n long, ids binary"), "ids")
    size = (ids.agg(F.sum("n")).first()[0] or 0) * array(code).itemsize
    ranges = max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // range_bytes))
    files = ids.repartitionByRange(int(ranges), "doc_id").sortWithinPartitions("doc_id").mapInArrow(partial(_write, code=code), "part int, number int, n_docs long, n_ids long, file binary")
    files.write.option("compression", "none").parquet(path)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, blob in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part", "number", "file")), strict=True):
            doc_ids, lengths, matrix = from_file(blob)
            ids = memoryview(matrix.decode().astype("<u4").tobytes())
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(ids[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(doc_ids), pa.int32()), pa.array([number] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()), pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                names=["part", "number", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def _with_starts(files: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of files (``part, number, ...``) with ``first``, the ids in all files before theirs."""
    index = stored(files.select("part", "number", "n_ids"), "index")
    parts = index.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # One row for each range of documents passes through the window without a key.
    parts = parts.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    starts = index.join(parts, "part").select("part", "number", (F.col("base") + F.sum("n_ids").over(Window.partitionBy("part").orderBy("number")) - F.col("n_ids")).alias("first"))
    return rows.join(starts, ["part", "number"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone."""
    files = spark.read.parquet(path)
    docs = files.select("part", "number", "file").mapInArrow(_read, "part int, number int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return _with_starts(files, docs).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _count(batches: Iterable[pa.RecordBatch], token: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([from_file(blob)[2].count(token)], pa.int64())], names=["n"])


def count_token(spark: SparkSession, path: str, token: int) -> int:
    """Occurrences of a token in all files; 0 for an id that no document holds and for an empty folder."""
    each = spark.read.parquet(path).select("file").mapInArrow(partial(_count, token=token), "n long")
    return each.agg(F.sum("n")).first()[0] or 0


#: Occurrences that a task looks up at a time.
FOUND_ROWS = 1 << 16


def _find(batches: Iterable[pa.RecordBatch], token: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            doc_ids, lengths, matrix = from_file(blob)
            ends, docs = np.cumsum(lengths), pa.array(doc_ids, pa.int64())
            for first in range(0, matrix.count(token), FOUND_ROWS):
                at = matrix.positions(token, first, first + FOUND_ROWS)
                which = np.searchsorted(ends, at, side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), part, np.int32)), pa.array(np.full(len(at), number, np.int32)), docs.take(pa.array(which)), pa.array(at - (ends - lengths)[which]), pa.array(at)],
                    names=["part", "number", "doc_id", "offset", "at"],
                )


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``doc_id, offset, position`` of every occurrence of a token: its place in the document and among all ids, from 0."""
    files = spark.read.parquet(path)
    found = files.select("part", "number", "file").mapInArrow(partial(_find, token=token), "part int, number int, doc_id long, offset long, at long")
    return _with_starts(files, found).select("doc_id", "offset", (F.col("first") + F.col("at")).alias("position"))


def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "llm-wavelet")
    write_ids(read_table(spark, sf_dir, "documents"), path)
    return read_ids(spark, path)
