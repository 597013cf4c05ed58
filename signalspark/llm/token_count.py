"""Operator 4: token counts by byte-pair merging with a heap and a linked list; no identifiers are emitted.

A pre-token starts as one symbol for each UTF-8 byte, chained in a doubly linked list.  A heap holds the adjacent pairs that have a
merge rank; the pair of lowest rank (leftmost among equals) is popped and merged until no ranked pair is left.  Its
tokens are the initial symbols less the merges.  Counts of pre-tokens are remembered in a memo of bounded size.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import read_table

#: Fixed value: the pattern that splits text before merging (see the vocabulary files' package).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of the pre-token memo; it is emptied when full.
MEMO_ENTRIES = 500_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary: itself, or the next free one from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class BpeCounter(dict):
    """Counts tokens as the vocabulary file's library does, special strings inside texts counting as one token.

    As a dict: pre-token piece (str) -> its count, or -1 where it starts or ends with white space (or is empty), so that the
    text has to be split as a whole.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.symbols = [ids[c] for c in byte_letters()]
        self.base = 1 + max(ids.values())
        #: left * base + right -> rank * base + merged symbol
        self.merges = {ids[a] * self.base + ids[b]: rank * self.base + ids[a + b] for rank, (a, b) in enumerate(spec["model"]["merges"])}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.special_texts = special
        self.split = regex.compile(SPLIT)

    def merged_length(self, raw: bytes) -> int:
        """Tokens of one pre-token: its bytes less the merges."""
        n = len(raw)
        if n < 2:
            return n
        merges, base = self.merges, self.base
        symbol = [self.symbols[b] for b in raw]
        after = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        heap = [(m, i, symbol[i] * base + symbol[i + 1]) for i in range(n - 1) if (m := merges.get(symbol[i] * base + symbol[i + 1])) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            m, i, pair = heapq.heappop(heap)
            j = after[i] if symbol[i] >= 0 else -1
            if j < 0 or symbol[i] * base + symbol[j] != pair:
                continue  # one of its symbols has been merged since
            symbol[i], symbol[j] = m % base, -1
            left -= 1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                pair = symbol[i] * base + symbol[k]
                if (m := merges.get(pair)) is not None:
                    heapq.heappush(heap, (m, i, pair))
            h = before[i]
            if h >= 0:
                pair = symbol[h] * base + symbol[i]
                if (m := merges.get(pair)) is not None:
                    heapq.heappush(heap, (m, h, pair))
        return left

    def split_count(self, text: str) -> int:
        return sum(self.merged_length(p.encode()) for p in self.split.findall(text))

    def __missing__(self, piece: str) -> int:
        bare = piece[1:] if piece[:1] == " " else piece
        n = -1 if not bare or bare[0].isspace() or bare[-1].isspace() else self.split_count(piece)
        if len(piece) <= 64:
            self[piece] = n
        return n

    def plain_count(self, text: str) -> int:
        """Tokens of a text without special strings.

        A single space or line feed between two other characters that aren't white space ends a pre-token, so a text is cut there
        and the pieces are looked up; a text with other white space is split as a whole.
        """
        if not text:
            return 0
        total, get = -1, self.__getitem__
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            counts = [get(first), *map(get, [" " + p for p in rest])]
            if min(counts) < 0:
                return self.split_count(text)
            total += 1 + sum(counts)
        return total

    def count(self, text: str) -> int:
        if len(self) > MEMO_ENTRIES:
            self.clear()
        if self.special is None or not any(t in text for t in self.special_texts):
            return self.plain_count(text)
        return sum(map(self.plain_count, self.special.split(text))) + len(self.special.findall(text))


@lru_cache(maxsize=2)
def counter(path: str) -> BpeCounter:
    """One counter and memo for all the tasks of a worker."""
    return BpeCounter(path)


def _count(batches: Iterable[pa.RecordBatch], vocabulary: str, limit: int) -> Iterator[pa.RecordBatch]:
    import public_tokenizers

    c = counter(public_tokenizers.path(vocabulary))
    for batch in batches:
        texts = batch.column(1)
        n_bytes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).cast(pa.int64())
        n = [c.count(t.as_py() or "") for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens) for each row of ``docs``.

    Whole texts; a null text counts as empty (0 bytes, 0 tokens).  Repeated rows and null ids come back as they are; other columns
    are ignored.  ``vocabulary`` names a byte-level BPE file of the vocabulary package, which every worker opens itself.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(partial(_count, vocabulary=vocabulary, limit=limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"))
