"""Token ids of whole texts by the tokenizers library, a word at a time.

The normaliser and the splitter of ``word_bpe_49k.json`` never let a token cross white space, nor the border between letters, a digit and
signs, but for short forms, special strings and marks that join a letter.  So a block of texts is cut into words, Arrow finds the
distinct ones, and the ids of a text are those of its words in order.  A worker remembers the ids of words (bounded) and asks the
library for the rest; pieces between white space that hold one of the exceptions are asked for as a whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Callable
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from signalspark.llm.common import worker_memo
from signalspark.llm.token_count import byte_letters

#: Entries of a generation of the memo of words.  A full generation becomes the old one, whose entries are taken over as
#: they are asked for; the one before it goes.
MEMO_ENTRIES = 150_000
#: Bytes of text that are cut into words at a time (up to the next white space); the arrays made of them are some 20 times as large.
BLOCK_BYTES = 1 << 19
#: Words that are looked up before the memo's size is asked for again.
LOOKED_UP = 10_000

#: The letters that stand for bytes in the vocabulary, by byte.
BYTE_LETTERS = dict(enumerate(byte_letters()))
#: Letters below this are treated alike by Python and the library, but for the one whose small form is two characters.
LATIN_END, TWO_CHARACTERS = "\u0250", "\u0130"
WHITE = b" \t\n\x0b\x0c\r"
#: What a byte is part of: letters (and all that is not ASCII), white space, a digit, signs, or else (an apostrophe can begin a short form).
LETTER, SPACE, DIGIT, SIGN, OTHER = range(5)
_KINDS = bytes(SPACE if c in WHITE else LETTER if c > 127 or chr(c).isalpha() else DIGIT if chr(c).isdigit() else SIGN if 32 < c < 127 and c != ord("'") else OTHER for c in range(256))
_GAP = re.compile(rb"[ \t-\r]")


def _stays_letters(text: str) -> bool:
    """Whether a word is letters alone after the normaliser too: some letters become a letter and a mark."""
    return text.isalpha() and unicodedata.normalize("NFC", text).lower().isalpha()


class _Memo(dict):
    """Values made by a function as they are asked for."""

    def __init__(self, make: Callable[[bytes], bytes | None]):
        super().__init__()
        self.make = make

    def __missing__(self, key: bytes) -> bytes | None:
        value = self[key] = self.make(key)
        return value


class PieceEncoder:
    """texts (UTF-8 bytes) -> ids as little-endian unsigned integers of 32 bits (``code`` I) or 16 (H), as bytes."""

    def __init__(self, vocabulary: str, code: str = "I", entries: int = MEMO_ENTRIES, block: int = BLOCK_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker for each core
        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.model, self.code, self.entries, self.block = self.library.model, code, entries, block
        self.memo, self.old = _Memo(self._make), _Memo(self._make)

    def _make(self, key: bytes) -> bytes | None:
        """Ids of a word; or of a piece, which has a space in front as a key."""
        if key in self.old:
            return self.old[key]
        return self._piece(key[1:]) if key[0] == 32 else self._word(key)

    def _piece(self, piece: bytes) -> bytes:
        return array(self.code, self.library.encode(piece.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def _word(self, word: bytes) -> bytes | None:
        """Ids of a run of bytes of one kind; None if its piece has to be asked for as a whole.

        The normaliser and the splitter leave digits, signs and small Latin letters as they are, but for writing their bytes as
        letters; so the library's model is asked at once.
        """
        if word.isascii():
            if word.isalpha():
                if not word.islower():
                    return self.memo[word.lower()]
            elif b"<|" in word or _KINDS[word[0]] == OTHER:  # a special string, whose letters count as they are written
                return None
            text = word.decode()
        else:
            text = word.decode("utf-8", "replace")
            if not _stays_letters(text):
                return None
            if max(text) >= LATIN_END or TWO_CHARACTERS in text or not unicodedata.is_normalized("NFC", text):
                return self._piece(word)
            text = text.lower().encode().decode("latin-1").translate(BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()

    def _ids(self, keys: list[bytes]) -> list[bytes | None]:
        out = []
        for k in range(0, len(keys), LOOKED_UP):
            if len(self.memo) > self.entries:
                self.memo, self.old = _Memo(self._make), self.memo
            out += map(self.memo.__getitem__, keys[k : k + LOOKED_UP])
        return out

    def _block(self, raw: bytes) -> tuple[np.ndarray, pa.LargeBinaryArray]:
        """Where the words of some bytes start, and their ids; a piece that is asked for as a whole is one word."""
        kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
        edges = np.concatenate(([0], np.flatnonzero((kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)) + 1, [len(raw)]))
        spaces = kinds[edges[:-1]] == SPACE
        words = np.flatnonzero(~spaces)
        begin, end, piece = edges[words], edges[words + 1], np.cumsum(spaces)[words]
        bounds = np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32)
        distinct = pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(bounds), pa.py_buffer(raw.translate(None, WHITE))]).dictionary_encode()
        ids, which = self._ids(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), distinct.indices.to_numpy()
        whole = np.fromiter((i is None for i in ids), bool, len(ids))
        if whole.any():
            pieces = np.unique(piece[whole[which]])
            first, last = np.searchsorted(piece, pieces), np.searchsorted(piece, pieces, side="right") - 1
            which = which.copy()
            which[first] = len(ids) + np.arange(len(pieces))
            ids += self._ids([b" " + raw[a:b] for a, b in zip(begin[first].tolist(), end[last].tolist(), strict=True)])
            kept = ~np.isin(piece, pieces)
            kept[first] = True
            begin, which = begin[kept], which[kept]
        return begin, pa.array(ids, pa.large_binary()).take(pa.array(which))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        joined = b"".join(t + b"\n" for t in texts)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        parts, cuts, at, size = [], [], 0, 0
        while at < len(joined):
            gap = _GAP.search(joined, at + self.block)
            end = gap.end() if gap else len(joined)
            begin, ids = self._block(joined[at:end])
            offsets = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)
            inside = starts[np.searchsorted(starts, at) : np.searchsorted(starts, end)]
            cuts += (size + offsets[np.searchsorted(begin, inside - at)]).tolist()
            parts.append(ids.buffers()[2].to_pybytes()[: int(offsets[-1])])
            size, at = size + len(parts[-1]), end
        out = b"".join(parts)
        return [out[a:b] for a, b in pairwise([*cuts, size])]


def encoder(vocabulary: str, code: str = "I", entries: int = MEMO_ENTRIES, block: int = BLOCK_BYTES) -> PieceEncoder:
    """One encoder and memo for all the tasks of a worker."""
    return worker_memo(PieceEncoder, vocabulary, code, entries, block)


def id_code(vocabulary: str) -> str:
    """The narrowest ``code`` of an encoder that holds all ids."""
    return "H" if max(Tokenizer.from_file(public_tokenizers.path(vocabulary)).get_vocab().values()) < 1 << 16 else "I"
