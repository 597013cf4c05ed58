"""Words: hashes equal where words are, for any cutting into blocks."""

import numpy as np

from signalspark.llm import common


def test_words_of_texts(monkeypatch):
    texts = [b"", b"One two\tTWO  one", b" \n", "É é Á".encode(), b"x" * 9000, b"X" * 9000 + b" y", b"a\x0bb\x0cc\rd"]
    lists = [t.lower().split() for t in texts]
    for block in (1 << 20, 5):
        monkeypatch.setattr(common, "BLOCK_BYTES", block)
        flat, starts = common.split_words(texts)
        assert np.diff(starts).tolist() == [len(x) for x in lists]
        words = [w for x in lists for w in x]
        of = {}
        for w, h in zip(words, flat.tolist(), strict=True):
            assert of.setdefault(w, h) == h
        assert len(set(of.values())) == len(of)
    assert [len(x) for x in common.split_words([])] == [0, 1]
