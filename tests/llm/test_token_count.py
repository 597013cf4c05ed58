"""Token counts against the library itself."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from signalspark.llm.token_count import BpeCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def library_count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library_on_odd_texts(library):
    c = BpeCounter(PATH)
    rng = random.Random(7)
    letters = list("aaaeethTHs'  \n\n\t.,:;-_0123éßñÉ") + [" ", " ", "\u0085", "\x1c", "\x1f", "\r\n", "'s", "'ll", " the", "<|endoftext|>", "漢字", "́", "😀", "ſ", "​", "٣", "Ⅷ", "᠎", "﻿"]
    texts = ["", " ", "  ", "\n", "a", " a ", "a  b", "a \n b", "x" * 3000, "ab" * 2000, "<|endoftext|>", "a<|endoftext|> b", "<|endoftext|", " ".join(["the"] * 500)]
    texts += ["".join(rng.choices(letters, k=rng.randint(1, 60))) for _ in range(3000)]
    wrong = [(t, c.count(t), library_count(library, t)) for t in texts if c.count(t) != library_count(library, t)]
    assert not wrong, wrong[:5]


def test_whole_table_equals_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(docs).collect()}
    want = {}
    for r in docs.collect():
        n = library_count(library, r.text)
        want[r.doc_id] = (len(r.text.encode()), n, n > 1024)
    assert got == want


def test_nulls_empty_tables_and_extra_columns(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "a b", 7), (3, "same", 8), (3, "same", 8)], "doc_id long, text string, n_tokens int")
    got = sorted(map(tuple, count_tokens(rows).collect()), key=str)
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (None, 3, 2, False), (3, 4, 1, False), (3, 4, 1, False)], key=str)
    assert count_tokens(rows.limit(0)).collect() == []
