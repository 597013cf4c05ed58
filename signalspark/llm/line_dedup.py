"""Operator 7: deletion of repeated passages by winnowing over line hashes.

Web text is wrapped anyhow, and a repeated passage may start within a line, so lines are made by content: a line ends after each word
whose hash is divisible by 3 or that repeats the word before it, whatever the line feeds.  A gram is ``GRAM_LINES`` consecutive lines.  Each window
of ``MIN_WORDS`` words chooses, by its own words alone, the gram of least hash that it holds with the line end before it; a window with no such
gram (few distinct words) chooses the least of its grams of ``PLAIN`` words.  So two texts that share a run of ``MIN_WORDS`` words share a fingerprint
at the same place of it.

Fingerprints that occur more than once are joined with their earliest position (smallest document id, then position).  Each later
one is extended word by word both ways, over the windows that chose it; what agrees for ``MIN_WORDS`` words or more is deleted, and the spans join up to
the whole run.  Windows of a later place that don't agree with the earliest one may be equal to each other: they are hashed whole and looked up by that
hash, and all but the first place of each go.  (A place that agrees wholly with the earliest has no other windows than that one.)  So a word is
deleted if, and only if, some window of ``MIN_WORDS`` words that holds it stands at an earlier place too.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import BROADCAST_IDS, CHUNK_BYTES, ODD, U64, as_long, chunks, mix, read_table, split_words, stored, word_spans

MIN_WORDS = 50
GRAM_LINES = 3
#: Bits for each repeated fingerprint in the filter that tells the second pass which ones repeat, and log2 of its least and greatest
#: number of bits (8 MB).  A false hit costs a row, nothing else.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 16, 26

#: Words of a plain gram, for windows without a gram of lines.
PLAIN = 4

FINGERPRINT = pa.schema([("gram", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32())])


def line_grams(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First word, last word, hash of each gram of lines, in order, and the word from which on a window is sure to hold it; no gram crosses texts.

    A gram's first line follows a line end.  A window knows that end if it holds the end's word, and the word before where only that makes it an end.
    """
    ends = flat % U64(3) == 0
    own = ends.copy()
    again = flat[1:] == flat[:-1]
    again[starts[1:-1][(starts[1:-1] > 0) & (starts[1:-1] < len(flat))] - 1] = False
    ends[1:] |= again
    ends = np.flatnonzero(ends)
    if len(ends) <= GRAM_LINES:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, U64), np.empty(0, np.int64))
    first = ends[:-1] + 1  # line i: words first[i] to ends[i + 1]
    length = ends[1:] - ends[:-1]
    power = np.cumprod(np.concatenate(([U64(1)], np.full(int(length.max()), U64(ODD[1])))))
    at = np.arange(first[0], ends[-1] + 1)
    line = np.add.reduceat(flat[first[0] : ends[-1] + 1] * power[at - np.repeat(first, length)], first - first[0])
    n = len(line) - GRAM_LINES + 1
    acc = np.zeros(n, U64)
    for j in range(GRAM_LINES):
        acc = acc * U64(ODD[2]) + mix(line[j : j + n])
    g_first, g_last = first[:n], ends[GRAM_LINES:]
    # A gram's first line must follow a line end of the same text.
    text = np.searchsorted(starts, g_first - 1, side="right")
    same = text == np.searchsorted(starts, g_last, side="right")
    g_first = g_first[same]
    return g_first, g_last[same], mix(acc)[same], g_first - 2 + own[g_first - 1]


def _least(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the least of ``h[lo:hi]`` (the last of equal ones) for each range, from ranges of powers of two."""
    chosen = np.empty(len(lo), np.int64)
    if not len(lo):
        return chosen
    level = np.floor(np.log2(hi - lo)).astype(int)
    least = np.arange(len(h))
    for k in range(int(level.max()) + 1):
        of = level == k
        a, b = least[lo[of]], least[hi[of] - (1 << k)]
        chosen[of] = np.where(h[b] <= h[a], b, a)
        a, b = least[: -(1 << k)], least[1 << k :]
        least = np.where(h[b] <= h[a], b, a)
    return chosen


def fingerprints(flat: np.ndarray, starts: np.ndarray, size: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words and hashes of the grams that are chosen in some window of ``size`` words inside one text, and the first words of the first and last such window.

    Each window chooses by its own words alone, so equal windows choose the same place: the gram of lines of least hash, or the least of its plain
    grams of ``PLAIN`` words where it holds no gram of lines.
    """
    first, last, h, known = line_grams(flat, starts)
    # The grams in a window change only where a window loses a gram's line end or gains a gram's last word.
    at = np.concatenate((starts[:-1], known + 1, last - size + 1))
    at = np.sort(at[(at >= 0) & (at < starts[-1])])
    at = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
    end = starts[np.searchsorted(starts, at, side="right")] - size + 1 if len(at) else at
    upto = np.minimum(np.append(at[1:], starts[-1]), end)  # windows from at to upto - 1 hold the same grams
    at, upto = at[at < upto], upto[at < upto]
    lo = np.searchsorted(known, at)
    hi = np.searchsorted(last, at + size - 1, side="right")
    some = hi > lo
    chosen = _least(h, lo[some], hi[some])
    place, value, w0, w1 = first[chosen], h[chosen], at[some], upto[some] - 1
    at, length = at[~some], (upto - at)[~some]
    if len(at):
        bare = np.repeat(at - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))  # windows without a gram of lines
        n = size - PLAIN + 1
        step = np.zeros(len(flat) + 1, np.int32)
        np.add.at(step, bare, 1)
        np.add.at(step, bare + n, -1)
        grams = np.flatnonzero(np.cumsum(step))
        acc = np.zeros(len(grams), U64)
        for j in range(PLAIN):
            acc = acc * U64(ODD[3]) + flat[grams + j]
        acc = mix(acc)
        lo = np.searchsorted(grams, bare)
        chosen = _least(acc, lo, lo + n)
        place, value, w0, w1 = (np.concatenate(x) for x in ((place, grams[chosen]), (value, acc[chosen]), (w0, bare), (w1, bare)))
    # A place that is chosen in both ways is two fingerprints.
    order = np.lexsort((w0, value, place))
    place, value, w0, w1 = place[order], value[order], w0[order], w1[order]
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (value[1:] != value[:-1])))) if len(place) else np.empty(0, np.int64)
    if not len(new):
        return place, value, w0, w1
    return place[new], value[new], w0[new], np.maximum.reduceat(w1, new)


def _first_pass(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for _, texts in chunks(batches):
        flat, starts = split_words(texts)
        _, h, _, _ = fingerprints(flat, starts, size)
        yield pa.RecordBatch.from_arrays([pa.array(as_long(h))], names=["gram"])


def _second_pass(batches: Iterable[pa.RecordBatch], repeats, size: int) -> Iterator[pa.RecordBatch]:
    """Places of the fingerprints that the filter knows, with 16 bits of each word of the windows that chose them."""
    bits, mask = repeats.value, U64(8 * len(repeats.value) - 1)
    for batch, texts in chunks(batches):
        flat, starts = split_words(texts)
        at, h, w0, w1 = fingerprints(flat, starts, size)
        low = (h & mask).astype(np.int64)
        known = (bits[low >> 3] >> (low & 7).astype(np.uint8) & 1).astype(bool)
        at, h, w0, w1 = at[known], h[known], w0[known], w1[known]
        text = np.searchsorted(starts, at, side="right") - 1
        words = (mix(flat) >> U64(48)).astype("<u2").tobytes()
        before = [words[2 * a : 2 * p] for a, p in zip(w0.tolist(), at.tolist(), strict=True)]
        after = [words[2 * p : 2 * e] for p, e in zip(at.tolist(), (w1 + size).tolist(), strict=True)]
        docs = batch.column(0).take(pa.array(text))
        yield pa.RecordBatch.from_arrays(
            [pa.array(as_long(h)), docs, pa.array((at - starts[text]).astype(np.int32)), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
            names=["gram", "doc_id", "pos", "before", "after"],
        )


def _agree(x: list[bytes], y: list[bytes], backwards: bool, size: int) -> np.ndarray:
    """Words of each pair of contexts that agree from the gram on."""
    full = 2 * size
    pad = (lambda v: v.rjust(full, b"\0")) if backwards else (lambda v: v.ljust(full, b"\0"))
    same = np.frombuffer(b"".join(map(pad, x)), "<u2").reshape(-1, size) == np.frombuffer(b"".join(map(pad, y)), "<u2").reshape(-1, size)
    if backwards:
        same = same[:, ::-1]
    n = np.where(same.all(axis=1), size, same.argmin(axis=1))
    return np.minimum(n, [min(len(a), len(b)) // 2 for a, b in zip(x, y, strict=True)])


FOUND = "doc_id long, first int, last int, key long"


def _extend(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Spans of ``size`` words or more that agree with the earliest place; of the windows that don't, the hashes and the first words."""
    for b in batches:
        if not b.num_rows:
            continue
        col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        docs, pos = col["doc_id"].to_numpy(), col["pos"].to_numpy().astype(np.int64)
        before, after = col["before"].to_pylist(), col["after"].to_pylist()
        left = _agree(before, col["before0"].to_pylist(), True, size)
        right = _agree(after, col["after0"].to_pylist(), False, size)
        n_before, n_after = (np.array([len(x) for x in v]) // 2 for v in (before, after))
        long = left + right >= size
        yield _found(docs[long], (pos - left)[long], (pos + right)[long], None)
        # Of two places in all, the later one's other windows are nowhere else.
        part = np.flatnonzero(((left < n_before) | (right < n_after)) & (col["n"].to_numpy() > 2))
        if len(part):
            words = mix(np.frombuffer(b"".join(x for i in part for x in (before[i], after[i])), "<u2").astype(U64) + U64(ODD[4]))
            length = (n_before + n_after)[part]
            n = length - size + 1
            row = np.repeat(np.arange(len(n)), n)
            off = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            agreed = (off >= (n_before - left)[part][row]) & (off + size <= (n_before + right)[part][row])
            row, off = row[~agreed], off[~agreed]
            at = (np.cumsum(length) - length)[row] + off
            acc = np.zeros(len(at), U64)
            for j in range(size):
                acc = acc * U64(ODD[2]) + words[at + j]
            first = (pos - n_before)[part][row] + off
            yield _found(docs[part][row], first, first + size, as_long(mix(acc)))


def _found(docs: np.ndarray, first: np.ndarray, last: np.ndarray, key: np.ndarray | None) -> pa.RecordBatch:
    keys = pa.nulls(len(docs), pa.int64()) if key is None else pa.array(key)
    return pa.RecordBatch.from_arrays([pa.array(docs), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), keys], names=["doc_id", "first", "last", "key"])


def merged(group: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of spans [first, last) within each group (numbers from 0), touching ones joined; ordered by group, then place."""
    order = np.lexsort((first, group))
    base = group[order].astype(np.int64) << 32
    begin, end = base + first[order], np.maximum.accumulate(base + last[order])
    new = np.concatenate(([True], begin[1:] > end[:-1])) if len(begin) else np.empty(0, bool)
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(begin)) - 1 if len(at) else at
    return base[at] >> 32, begin[at] - base[at], end[stop] - base[at]


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        places = b.column(1)
        flat = places.flatten()
        first, last = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("first", "last"))
        doc, first, last = merged(np.repeat(np.arange(len(places)), places.value_lengths().to_numpy()), first, last)
        keep, count = np.unique(doc, return_counts=True)
        spans = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], names=["first", "last"])
        runs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), spans)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep)), runs], names=["doc_id", "runs"])


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, runs`` (array of word positions ``first`` to ``last`` - 1) of the documents that repeat an earlier run."""
    spark = docs.sparkSession
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    repeats = stored(texts.mapInArrow(partial(_first_pass, size=min_words), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "repeats")
    log2 = min(max((BITS_EACH * repeats.count()).bit_length(), LEAST_BITS), MOST_BITS)
    low = F.col("gram").bitwiseAND((1 << log2) - 1)
    masks = repeats.select(F.shiftright(low, 6).alias("at"), F.expr("shiftleft(1L, cast(gram & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("mask")).toArrow()
    words = np.zeros(1 << (log2 - 6), "<i8")
    words[masks["at"].to_numpy()] = masks["mask"].to_numpy()
    filter_ = spark.sparkContext.broadcast(words.view(np.uint8))
    places = stored(texts.mapInArrow(partial(_second_pass, repeats=filter_, size=min_words), "gram long, doc_id long, pos int, before binary, after binary"), "places")

    def earliest(rows: DataFrame, key: str, place: str) -> DataFrame:
        """Document and place where a repeated key stands first."""
        least = rows.groupBy(key).agg(F.min(F.struct("doc_id", place)).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
        return least.select(key, F.col("f.doc_id").alias("doc0"), F.col(f"f.{place}").alias("pos0"), "n")

    # Only the places' numbers are aggregated; the words around the earliest one come by a join, whose shuffle the next join uses too.
    is_first = lambda place: (F.col("doc_id") == F.col("doc0")) & (F.col(place) == F.col("pos0"))
    firsts = places.join(earliest(places, "gram", "pos"), "gram").where(is_first("pos")).groupBy("gram").agg(F.min(F.struct("doc0", "pos0", "before", "after", "n")).alias("f"))
    firsts = firsts.select("gram", "f.doc0", "f.pos0", F.col("f.before").alias("before0"), F.col("f.after").alias("after0"), "f.n")
    found = stored(places.join(firsts, "gram").where(~is_first("pos")).mapInArrow(partial(_extend, size=min_words), FOUND), "found")
    # A window that doesn't agree with the earliest place of its gram may stand at another place that doesn't: those are looked up by themselves.
    windows = found.where("key is not null")
    again = windows.join(earliest(windows, "key", "first"), "key").where(~is_first("first"))
    spans = found.where("key is null").select("doc_id", "first", "last").union(again.select("doc_id", "first", "last")).distinct()
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last")).alias("places"))
    return stored(by_doc.mapInArrow(_runs, "doc_id long, runs array<struct<first:int,last:int>>"), "runs")


def _cut(text: bytes, runs: list[dict]) -> bytes:
    """The text without the runs of words; a run goes with the white space after it, at the end with that before it."""
    begin, end = word_spans(text)
    out, at = [], 0
    for r in runs:
        s, e = r["first"], r["last"]
        if e < len(begin):
            out.append(text[at : begin[s]])
            at = begin[e]
        else:
            out.append(text[at : end[s - 1] if s else 0])
            at = len(text)
    return b"".join([*out, text[at:]])


def _cut_texts(texts: pa.Array, runs: pa.Array) -> pa.Array:
    """Texts without their runs, and the number of words deleted; null stays null.  About ``CHUNK_BYTES`` bytes are Python objects at a time."""
    kind, done, some, size = pa.struct([("text", pa.string()), ("n_deleted", pa.int64())]), [], [], 0
    for text, spans in zip(texts, runs, strict=True):
        if text.is_valid and spans.is_valid:
            cut = _cut(text.as_py().encode(), spans.as_py())
            some.append({"text": cut.decode(), "n_deleted": sum(r["last"] - r["first"] for r in spans.as_py())})
            size += len(cut)
        else:
            some.append(None)
        if size > CHUNK_BYTES:
            done.append(pa.array(some, kind))
            some, size = [], 0
    return pa.concat_arrays([*done, pa.array(some, kind)])


def without_runs(docs: DataFrame, min_words: int, n_deleted: str) -> DataFrame:
    """All rows and columns of ``docs``, the text without its repeated runs, and a column ``n_deleted`` (the name is given) of deleted words."""
    if min_words < MIN_WORDS:
        raise ValueError(f"fingerprints are sure for runs of {MIN_WORDS} words or more")
    runs = repeated_runs(docs, min_words)
    size = runs.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0]
    runs = runs.toDF("__run_doc", "__runs")
    runs = F.broadcast(runs) if size <= BROADCAST_IDS else runs.hint("merge")
    joined = docs.join(runs, F.col("doc_id") == F.col("__run_doc"), "left")
    # Only texts with runs go to Python.
    touched = F.when(F.col("__runs").isNotNull(), F.col("text"))
    cut = F.arrow_udf(_cut_texts, "struct<text:string,n_deleted:long>")(touched, F.col("__runs"))
    rows = joined.withColumn("__cut", cut)
    text = F.when(F.col("__cut").isNull(), F.col("text")).otherwise(F.col("__cut.text"))
    kept = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != n_deleted]
    return rows.select(*kept, F.coalesce("__cut.n_deleted", F.lit(0).cast("long")).alias(n_deleted))


def delete_repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of ``docs`` with ``text`` less its repeated runs, and ``n_deleted`` words (a column of that name is replaced; see ``without_runs``).

    Words are runs of characters other than space and x09-x0D and are compared with A-Z lower-cased.  ``doc_id`` is an integer; rows that repeat an id
    count as one document's text each and lose the same runs.  Null texts, null ids and texts under ``min_words`` words
    come back as they are.  Runs are at least ``min_words`` (not under ``MIN_WORDS``) long.
    """
    return without_runs(docs, min_words, "n_deleted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete_repeated(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
