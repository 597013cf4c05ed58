"""Operator 13: resampling of documents by importance weights towards a target distribution, with bit-sliced aggregation.

*Features.*  A word is a run of digits, letters a-z (A-Z are lower-cased) and other characters than ASCII.  A text's features are all its runs of
1 to 3 words, joined by a space; a feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``.  The CRC of a run is put together
from those of its words, so each distinct word's bytes are looked at once.
*Gains.*  The buckets' counts over all documents and over all target texts are summed from the tasks' counters.  A bucket's gain is
the floor of 1000 times the logarithm of its smoothed share in the target over that in the documents.
*Bit slices.*  A document's ``BUCKETS`` counts are written as bit planes: plane j has the j-th bit of every count.  The gains are planes too, in
two's complement.  The weight is the sum, over pairs of planes, of the number of bits that both have, times the planes' power of
two (negative for the gains' sign plane): exact integers, whatever the text's length.
*Draw.*  Each weight gets Gumbel noise from a hash of the document's id, and the highest scores are drawn: a draw without replacement with
probabilities proportional to exp(weight / 1000).

Texts are taken apart in blocks of words, so a very long one needs no more memory than its own bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import COUNTS_ROW, chunks, count_rows, read_table, stored, sum_counts
from signalspark.llm.ranges import placed

BUCKETS = 10_000
#: Words of the longest feature.
LONGEST = 3
#: Drawn documents in a hundred of those that have enough words, and that number of words.
SHARE, LEAST_WORDS = 5, 20
SEED = 42
#: Documents whose counts a task holds at a time, and bytes of a block of a long text.
DOCS, BLOCK_BYTES = 64, 1 << 20
#: Entries of a worker's memo of words; it is emptied when full.
MEMO_WORDS = 400_000
#: Lengths of words for which the table of CRC shifts is kept; longer ones are shifted by powers of two.
SHIFTS = 128

SCORED = "doc_id long, n_words long, n_features long, weight long, score long"

#: Bytes to what they are in a word; all others part words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


@lru_cache(maxsize=1)
def _crc_shifts() -> tuple[np.ndarray, np.ndarray]:
    """Tables that carry a CRC over n bytes that follow: n below ``SHIFTS``, and n = 2^k.  Each has 4 x 256 entries, one for each byte of the CRC."""
    one = np.array([crc32(bytes([v])) ^ crc32(b"\0") for v in range(256)], np.uint32)  # what a byte of the CRC becomes
    start = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]).astype(np.uint32)
    small = [start]
    for _ in range(1, SHIFTS):
        small.append((small[-1] >> np.uint32(8)) ^ one[small[-1] & np.uint32(255)])
    powers = [small[1]]
    for _ in range(31):
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(small).reshape(SHIFTS, 1024), np.stack(powers)


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    t = table.reshape(4, 256)
    return t[0][crc & np.uint32(255)] ^ t[1][crc >> np.uint32(8) & np.uint32(255)] ^ t[2][crc >> np.uint32(16) & np.uint32(255)] ^ t[3][crc >> np.uint32(24)]


def shift_crc(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC's part in that of a text which goes on for ``size`` more bytes."""
    small, powers = _crc_shifts()
    flat, row = small.ravel(), np.minimum(size, SHIFTS - 1).astype(np.int64) * 1024
    out = flat[row + (crc & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= flat[row + 256 * k + (crc >> np.uint32(8 * k) & np.uint32(255))]
    for i in np.flatnonzero(size >= SHIFTS):
        one, left, k = crc[i : i + 1], int(size[i]), 0
        while left:
            one = _apply(powers[k], one) if left & 1 else one
            left, k = left >> 1, k + 1
        out[i] = one[0]
    return out


class Words(dict):
    """Numbers of words; by number, the CRC of the word, that of a space and the word, and the bytes of the latter."""

    def __init__(self) -> None:
        super().__init__()
        self.own, self.spaced, self.size = (np.empty(MEMO_WORDS, kind) for kind in (np.uint32, np.uint32, np.int64))

    def __missing__(self, word: bytes) -> int:
        n = len(self)
        if n == len(self.own):
            self.own, self.spaced, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.own, self.spaced, self.size))
        self.own[n], self.spaced[n], self.size[n] = crc32(word), crc32(b" " + word), len(word) + 1
        self[word] = n
        return n


@lru_cache(maxsize=1)
def _memo() -> Words:
    return Words()


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about ``BLOCK_BYTES`` bytes at a time."""
    clean = text.translate(WORD_BYTES)
    at = 0
    while at < len(clean):
        end = at + BLOCK_BYTES
        if end < len(clean):
            end = clean.rfind(b" ", at + 1, end) if clean.rfind(b" ", at + 1, end) > 0 else clean.find(b" ", end)
            end = end if end > 0 else len(clean)
        yield clean[at:end].split()
        at = end


def feature_buckets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of words: the bucket and the text of each feature, and each text's words in the block."""
    words, text_of, fresh = [], [], []  # of each segment: its words, text, and how many words of it were in the block before
    held = 0

    def features() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        memo = _memo()
        if len(memo) > MEMO_WORDS:
            memo.clear()
        sizes = np.array([len(w) for w in words])
        ids = np.fromiter((memo[w] for part in words for w in part), np.int64, int(sizes.sum()))
        own, spaced, size = memo.own[ids], memo.spaced[ids], memo.size[ids]
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.arange(len(ids)) - start
        text, old = np.repeat(text_of, sizes), np.repeat(fresh, sizes)
        buckets, of = [], []
        run = own
        for k in range(LONGEST):
            if k:
                longer = np.zeros_like(run)
                longer[1:] = shift_crc(run[:-1], size[1:]) ^ spaced[1:]
                run = longer
            whole = at >= np.maximum(k, old)
            buckets.append(run[whole] % np.uint32(BUCKETS))
            of.append(text[whole])
        counts = np.bincount(text_of, sizes - np.array(fresh), minlength=len(texts)).astype(np.int64)
        return np.concatenate(buckets).astype(np.int64), np.concatenate(of).astype(np.int64), counts

    for i, t in enumerate(texts):
        before: list[bytes] = []
        for block in _blocks(t):
            part = before + block
            words.append(part)
            text_of.append(i)
            fresh.append(len(before))
            held += len(part)
            before = part[1 - LONGEST :]
            if held > BLOCK_BYTES // 4:
                yield features()
                words, text_of, fresh, held = [], [], [], 0
    if held:
        yield features()


def _totals(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTS_ROW, np.int64)
    for _, texts in chunks(batches):
        for bucket, _, _ in feature_buckets(texts):
            total += np.bincount(bucket, minlength=COUNTS_ROW)
    if total.any():
        part, counts = count_rows(total)
        yield pa.RecordBatch.from_arrays([part, counts], names=["part", "counts"])


def bucket_totals(texts: DataFrame) -> np.ndarray:
    """Features in each bucket over all rows' ``text``."""
    assert BUCKETS <= COUNTS_ROW
    rows = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(_totals, "part int, counts binary")
    return sum_counts(rows, COUNTS_ROW)[:BUCKETS]


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS)))) of each bucket, in doubles."""
    every, wanted = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1) * every / ((s + 1) * wanted))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _slices(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of rows of integers: plane, row, 64 columns in a number."""
    pad = -values.shape[-1] % 64
    values = np.pad(values, [(0, 0)] * (values.ndim - 1) + [(0, pad)])
    return np.stack([np.packbits((values >> j & 1).astype(np.uint8), axis=-1).view(np.uint64) for j in range(bits)])


def gain_planes(gains: np.ndarray) -> np.ndarray:
    """Two's complement: the last plane counts negative."""
    bits = int(np.abs(gains).max(initial=0)).bit_length() + 1
    return _slices(gains & ((1 << bits) - 1), bits)


def weights(counts: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Sum of count times gain of each row of counts, from the planes of either."""
    planes = _slices(counts, max(1, int(counts.max(initial=0)).bit_length()))
    factor = np.left_shift(1, np.arange(len(gains)), dtype=np.int64)
    factor[-1] = -factor[-1]
    total = np.zeros(len(counts), np.int64)
    for j, plane in enumerate(planes):
        both = np.bitwise_count(plane[:, None, :] & gains[None]).sum(axis=2, dtype=np.int64)
        total += (both @ factor) << j
    return total


def noise(doc_id: int, seed: int) -> int:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    h = int(sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score(batches: Iterable[pa.RecordBatch], gains, seed: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in chunks(batches):
        for at in range(0, len(texts), DOCS):
            some = texts[at : at + DOCS]
            counts, n_words = np.zeros(len(some) * BUCKETS, np.int64), np.zeros(len(some), np.int64)
            for bucket, text, words in feature_buckets(some):
                counts += np.bincount(text * BUCKETS + bucket, minlength=len(counts))
                n_words += words
            counts = counts.reshape(len(some), BUCKETS)
            weight = weights(counts, gains.value)
            ids = batch.column(0).slice(at, len(some))
            score = [None if d is None else w + noise(d, seed) for d, w in zip(ids.to_pylist(), weight.tolist(), strict=True)]
            cols = [ids, *map(pa.array, (n_words, counts.sum(axis=1), weight)), pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_features", "weight", "score"])


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs (doc_id, text)``, towards the texts of ``target (text)``.

    Of the N rows with an id and ``least_words`` words, floor(N ``share`` / 100) are drawn: those of highest score, ties to the
    smaller id; ``rank`` is 1 for the first of them and null for the rest.  A null or wordless text has no
    features and weight 0.  A row without an id counts in the corpus and gets a weight, but neither score nor rank.  Rows that repeat an id are
    documents of their own with the same noise; where they tie wholly, their ranks follow each other in any order.  Further columns
    are ignored.  An empty target is all zeros; an empty corpus gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    gains = spark.sparkContext.broadcast(gain_planes(bucket_gains(bucket_totals(docs), bucket_totals(target))))
    scored = stored(docs.mapInArrow(partial(_score, gains=gains, seed=seed), SCORED), "scored")
    enough = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    names = ["doc_id", "n_features", "weight", "score"]
    able = stored(scored.where(enough).select(names), "able")
    drawn = able.count() * share // 100
    rank = F.col("place") + 1
    ranked = placed(able, [F.col("score").desc(), F.col("doc_id").asc()], "ranked").select(*names, F.when(rank <= drawn, rank).alias("rank"))
    return ranked.union(scored.where(~enough).select(*names, F.lit(None).cast("long").alias("rank")))


def drawn_documents(docs: DataFrame, target: DataFrame, **more) -> DataFrame:
    """The rows of ``docs``, all columns, whose id is drawn by ``resampled``."""
    ids = stored(resampled(docs, target, **more).where("rank is not null").select(F.col("doc_id").alias("drawn_id")).distinct(), "drawn")
    return docs.join(ids.hint("merge"), docs["doc_id"] == ids["drawn_id"], "left_semi")


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
