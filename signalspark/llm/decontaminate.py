"""Operator 5: benchmark items in documents, also with other numbers, names and units, by template canonicalisation.

1. *Templates.*  A word loses its outer punctuation and becomes: ``<number>`` (digits), ``<unit>`` (a unit after a number), ``<name>`` (a capital
   letter where no sentence starts), else itself in lower case.  The placeholders are the slots.
2. *Windows.*  The hashes of ``WINDOW`` consecutive template words of all items are the table that the documents' windows are looked
   up in.  Windows of fewer than ``LITERALS`` words that aren't slots say too little; there the plain words are hashed instead.  Items shorter
   than a window are one window of their own length (under ``SHORTEST`` words: left out, they'd be found anywhere).
   An item's capital first word is a name where the item stands within a sentence, so its first window is looked up in both forms.
3. *Slots.*  Matched windows of one item and shift form a region.  Each value of the item's slots must stand for one value
   of the document's throughout; where it stands for several, only the places of the most frequent one count.
4. An item is in a document when at least ``COVER`` of its words are in consistent places, or when ``STRETCH`` consecutive ones are:
   a long item's question may be copied without its context.

The items' windows are looked up in blocks of ``BLOCK_WINDOWS`` (one block in practice), so what a task holds is bounded.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import MEMO_WORDS, U64, as_long, chunks, gram_hashes, read_table, stored

WINDOW = 6
LITERALS = 3
SHORTEST = 3
COVER = 0.6
STRETCH = 20
BLOCK_WINDOWS = 1_000_000

NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
#: Fixed value: units that count as such after a number.
UNITS = frozenset(
    "kg g mg lb lbs oz km m cm mm mi ft in yd l ml s sec secs second seconds min mins minute minutes h hr hrs hour hours day days "
    "week weeks month months year years mph kmh kb mb gb tb usd eur dollars dollar euros euro cents cent meter meters metre metres "
    "kilometer kilometers kilometre kilometres mile miles foot feet inch inches yard yards gram grams kilogram kilograms pound pounds "
    "ounce ounces liter liters litre litres gallon gallons percent degrees celsius fahrenheit watts volts".split()
)
OUTER = "\"'`“”‘’«»()[]{}<>.,;:!?…*_-–—"


def h64(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode())


NUMBER_HASH, UNIT_HASH, NAME_HASH = h64("\0number"), h64("\0unit"), h64("\0name")
#: What a word is by itself.
PLAIN, IS_NUMBER, IS_UNIT, IS_CAPITAL = 0, 1, 2, 3


class Words(dict):
    """word -> row of its plain hash, kind, and whether it ends a sentence."""

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.plain, self.kind, self.stops = array("Q"), bytearray(), bytearray()

    def __missing__(self, word: bytes) -> int:
        w = word.decode("utf-8", "replace")
        bare = w.strip(OUTER)
        low = bare.lower()
        self.plain.append(h64(low))
        self.kind.append(IS_NUMBER if NUMBER.match(bare) else IS_UNIT if low in UNITS else IS_CAPITAL if bare[:1].isupper() else PLAIN)
        self.stops.append(w.rstrip("\"'”’)]»")[-1:] in tuple(".!?:…"))
        self[word] = n = len(self.plain) - 1
        return n

    def templates(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Template hashes, plain hashes, whether a word is a slot, and where each text starts."""
        if len(self) > MEMO_WORDS:
            self.reset()
        lists = [t.split() for t in texts]
        starts = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=starts[1:])
        row = np.fromiter((self[w] for x in lists for w in x), np.int64, int(starts[-1]))
        plain, kind, stops = np.frombuffer(self.plain, U64)[row], np.frombuffer(self.kind, np.int8)[row], np.frombuffer(self.stops, bool)[row]
        begins = np.concatenate(([True], stops[:-1])) if len(row) else stops
        begins[starts[:-1][starts[:-1] < len(row)]] = True
        number = kind == IS_NUMBER
        after = np.concatenate(([False], number[:-1])) if len(row) else number
        after[starts[:-1][starts[:-1] < len(row)]] = False
        unit, name = (kind == IS_UNIT) & after, (kind == IS_CAPITAL) & ~begins
        template = np.where(number, U64(NUMBER_HASH), np.where(unit, U64(UNIT_HASH), np.where(name, U64(NAME_HASH), plain)))
        return template, plain, number | unit | name, starts


def window_hashes(template: np.ndarray, plain: np.ndarray, slot: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window: of its template, or of its plain words where it has too few literals."""
    h = gram_hashes(template, width)
    if not len(h):
        return h
    slots = np.cumsum(np.concatenate(([0], slot)))
    few = width - (slots[width:] - slots[:-width]) < min(LITERALS, width)
    return np.where(few, gram_hashes(plain, width) ^ U64(1), h)


def _item_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch, texts in chunks(batches):
        for item, text in zip(batch.column(0).to_pylist(), texts, strict=True):
            template, plain, slot, _ = words.templates([text])
            n = len(plain)
            if n >= SHORTEST:
                h = window_hashes(template, plain, slot, min(n, WINDOW))
                lead = None
                if text.split()[0].decode("utf-8", "replace").strip(OUTER)[:1].isupper():
                    template[0], slot[0] = NAME_HASH, True
                    lead = int(as_long(window_hashes(template[:WINDOW], plain[:WINDOW], slot[:WINDOW], min(n, WINDOW)))[0])
                    slot[0] = False
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item], pa.int64()), pa.array([n], pa.int32()), pa.array([as_long(h)], pa.list_(pa.int64())), pa.array([as_long(plain)], pa.list_(pa.int64())), pa.array([slot], pa.list_(pa.bool_())), pa.array([lead], pa.int64())],
                    names=["item_id", "n", "windows", "plain", "slot", "lead"],
                )


class Items:
    """A block of items as a task holds it."""

    def __init__(self, rows: list):
        self.ids = [r["item_id"] for r in rows]
        self.sizes = [r["n"] for r in rows]
        self.plain = [np.array(r["plain"], np.int64) for r in rows]
        self.slot = [np.array(r["slot"], bool) for r in rows]
        self.at: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, r in enumerate(rows):
            for q, h in enumerate(r["windows"]):
                self.at[min(r["n"], WINDOW)][h].append((k, q))
            if r["lead"] is not None:
                self.at[min(r["n"], WINDOW)][r["lead"]].append((k, 0))
        self.at = {w: dict(x) for w, x in self.at.items()}
        self.known = {}
        for w, x in self.at.items():
            bits = np.zeros(1 << 22, bool)
            bits[np.fromiter((h & ((1 << 22) - 1) for h in x), np.int64, len(x))] = True
            self.known[w] = bits

    def in_text(self, plain: np.ndarray, hits: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, bool]]:
        """(item, words covered, words, slots, renamed, longest stretch) of the items that ``hits`` (place, window width, hash) show in one text."""
        shifts: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for p, width, h in hits:
            for k, q in self.at[width][h]:
                shifts[k, p - q].append((q, width))
        covered: dict[int, set[int]] = defaultdict(set)
        renamed: set[int] = set()
        longest: dict[int, int] = defaultdict(int)
        for (k, shift), windows in shifts.items():
            places = sorted({q + j for q, width in windows for j in range(width)})
            values: dict[int, Counter] = defaultdict(Counter)
            for q in places:
                if self.slot[k][q]:
                    values[int(self.plain[k][q])][int(plain[q + shift])] += 1
            stands = {v: min(c.items(), key=lambda x: (-x[1], x[0]))[0] for v, c in values.items()}
            good = {q for q in places if not self.slot[k][q] or stands[int(self.plain[k][q])] == int(plain[q + shift])}
            covered[k] |= good
            run = 0
            for q in places:
                run = 0 if q not in good else run + 1 if q - 1 in good else 1
                longest[k] = max(longest[k], run)
            if any(self.slot[k][q] and self.plain[k][q] != plain[q + shift] for q in good):
                renamed.add(k)
        found = [k for k, c in covered.items() if len(c) >= COVER * self.sizes[k] or longest[k] >= STRETCH]
        return [(self.ids[k], len(covered[k]), self.sizes[k], int(self.slot[k].sum()), k in renamed, longest[k]) for k in found]


LEAK = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_covered", pa.int32()), ("n_words", pa.int32()), ("n_slots", pa.int32()), ("renamed", pa.bool_()), ("n_stretch", pa.int32())])


def _search(batches: Iterable[pa.RecordBatch], items) -> Iterator[pa.RecordBatch]:
    words, held = Words(), items.value
    for batch, texts in chunks(batches):
        template, plain, slot, starts = words.templates(texts)
        hits: dict[int, list] = defaultdict(list)
        for width, table in held.at.items():
            h = window_hashes(template, plain, slot, width)
            place = np.flatnonzero(held.known[width][(h & U64((1 << 22) - 1)).astype(np.int64)])
            text = np.searchsorted(starts, place, side="right") - 1
            inside = place + width <= starts[text + 1]
            for p, t, v in zip(place[inside].tolist(), text[inside].tolist(), as_long(h[place[inside]]).tolist(), strict=True):
                if v in table:
                    hits[t].append((p, width, v))
        rows = [(doc, *found) for t in sorted(hits) for doc in [batch.column(0)[t].as_py()] for found in held.in_text(as_long(plain), hits[t])]
        yield pa.RecordBatch.from_pylist([dict(zip(LEAK.names, r, strict=True)) for r in rows], schema=LEAK)


def benchmark_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, n_covered, n_words, n_slots, renamed, n_stretch`` (longest run of consistent words) for each item that each document contains.

    ``docs (doc_id, text)`` and ``benchmark (item_id, text)`` have integer ids; other columns are ignored.  Words are split at space and x09-x0D.  Null and
    empty texts contain nothing and null or short items are in nothing.  Repeated items are reported each; repeated rows of ``docs`` (and
    rows with a null id) once for each equal result.  ``renamed``: some slot has another value than in the item.
    Where an item's value stands for several values equally often, the one of smallest hash counts.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text"))
    items = stored(items.mapInArrow(_item_windows, "item_id long, n int, windows array<long>, plain array<long>, slot array<boolean>, lead long"), "items")
    windows = items.agg(F.sum(F.size("windows"))).first()[0] or 0
    blocks = max(1, -(-windows // BLOCK_WINDOWS))
    found = None
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "windows"), F.lit(blocks)) == k).collect()  # about BLOCK_WINDOWS windows
        held = spark.sparkContext.broadcast(Items(block))
        part = texts.mapInArrow(partial(_search, items=held), "doc_id long, item_id long, n_covered int, n_words int, n_slots int, renamed boolean, n_stretch int")
        found = part if found is None else found.union(part)
    return found.distinct()


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
