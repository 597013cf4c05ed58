"""Wavelet-matrix files: exact round trip, access, counting and lookup."""

import zlib

import numpy as np
import public_tokenizers
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from signalspark.llm import wavelet
from signalspark.llm.wavelet import CHUNK, WaveletMatrix, count_token, find_token, from_file, read_ids, to_file, write_ids
from signalspark.session import scratch_dir


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 49407) | st.integers(0, 3), max_size=1500))
def test_matrix_answers_as_the_list_does(ids):
    blob = to_file([7], [len(ids)], np.array(ids, np.uint32))
    docs, lengths, m = from_file(blob)
    assert (docs, lengths.tolist(), m.decode().tolist()) == ([7], [len(ids)], ids)
    for i in range(0, len(ids), 97):
        assert m[i] == ids[i]
    for token in [*ids[:5], 0, 3, 70000]:
        at = [i for i, x in enumerate(ids) if x == token]
        assert m.count(token) == len(at)
        assert m.count(token, len(ids) // 3, len(ids) // 2) == sum(len(ids) // 3 <= i < len(ids) // 2 for i in at)
        assert [m.find(token, j) for j in range(min(3, len(at) + 1))] == (at + [-1])[: min(3, len(at) + 1)]


def test_long_matrix():
    ids = np.random.default_rng(3).integers(0, 1 << 18, 5000).astype(np.uint32)
    m = WaveletMatrix.build(ids)
    assert (m.decode() == ids).all()
    assert m.find(int(ids[4321]), m.count(int(ids[4321])) - 1) >= 4321


def expected(rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = scratch_dir(spark, "test-wavelet")
    write_ids(table.repartition(5), path, range_bytes=1 << 16)
    got = sorted(map(tuple, read_ids(spark, path).collect()))
    assert got == expected([(r.doc_id, r.text) for r in table.collect()])


def test_nulls_repeats_clashes_and_empty_tables(spark):
    rows = [(3, "a b"), (None, "x"), (1, None), (2, ""), (3, "a b")]
    df = spark.createDataFrame([(*r, 0, "f") for r in rows], "doc_id long, text string, part int, file string")
    path = scratch_dir(spark, "test-wavelet")
    write_ids(df, path)
    assert sorted(map(tuple, read_ids(spark, path).collect()), key=lambda r: r[1]) == expected(rows)
    path = scratch_dir(spark, "test-wavelet")
    write_ids(df.limit(0), path)
    assert read_ids(spark, path).collect() == []
    assert count_token(spark, path, 2) == 0
    assert find_token(spark, path, 2).collect() == []


def test_file_of_several_chunks():
    ids = np.random.default_rng(4).zipf(1.3, 2 * CHUNK + 7000).clip(max=40000).astype(np.uint32)
    m = from_file(to_file([1, None], [CHUNK, len(ids) - CHUNK], ids))[2]
    assert (m.decode() == ids).all()
    for token in (1, 2, 77, 40000, 39999, 65535, 65536, -1):
        at = np.flatnonzero(ids == token)
        assert m.positions(token).tolist() == at.tolist()
        assert m.positions(token, 3, 5).tolist() == at[3:5].tolist()
        assert m.count(token, CHUNK - 5, CHUNK + 900) == ((at >= CHUNK - 5) & (at < CHUNK + 900)).sum()
    for i in (0, CHUNK - 1, CHUNK, 2 * CHUNK, len(ids) - 1):
        assert m[i] == ids[i]


def test_lookup_opens_few_chunks(monkeypatch):
    ids = np.random.default_rng(5).integers(0, 1 << 16, 8 * CHUNK).astype(np.uint32)
    blob, opened = to_file([1], [len(ids)], ids), []
    real = zstandard.ZstdDecompressor

    class Counted:
        def __init__(self):
            self.unpacker = real()

        def decompress(self, data):
            opened.append(len(data))
            return self.unpacker.decompress(data)

    monkeypatch.setattr(wavelet.zstandard, "ZstdDecompressor", Counted)
    assert from_file(blob)[2][12345] == ids[12345]
    assert len(opened) <= 2 + 16  # of 2 + 16 * 8


def test_lookups_over_a_folder(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    path = scratch_dir(spark, "test-wavelet")
    write_ids(table.repartition(5), path, range_bytes=1 << 16)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    flat = [(r.doc_id, k, t) for r in sorted(table.collect(), key=lambda r: r.doc_id) for k, t in enumerate([*library.encode(r.text or "", add_special_tokens=False).ids, 2])]
    for token in {2, flat[0][2], flat[len(flat) // 2][2], 49000, 1 << 20}:
        want = [(d, k, i) for i, (d, k, t) in enumerate(flat) if t == token]
        assert count_token(spark, path, token) == len(want)
        assert sorted(map(tuple, find_token(spark, path, token).collect()), key=lambda r: r[2]) == want
