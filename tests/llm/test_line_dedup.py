"""Repeated passages against a search of all 50-word runs."""

import random

import numpy as np

from signalspark.llm.common import split_words
from signalspark.llm.line_dedup import delete_repeated, fingerprints, merged
from tests.llm import brute


def text(rng, n):
    return " ".join(f"w{rng.randrange(10**5)}" for _ in range(n))


def test_planted_passages_go_and_the_rest_stays(spark):
    rng = random.Random(5)
    passages = [text(rng, n) for n in (50, 51, 68, 400)]
    parts = [(text(rng, rng.randrange(0, 30)), p, text(rng, rng.randrange(0, 30))) for p in passages for _ in range(4)]
    rows = [(i, "\n".join(x for x in part if x), 1) for i, part in enumerate(parts)]
    short = text(rng, 49)
    rows += [(100 + i, f"{text(rng, 8)} {short} {text(rng, 9)}", 1) for i in range(3)]  # too short to count
    rows += [(200, None, 1), (201, "", 1), (202, "a  b\n", 1), (None, passages[2], 1), (203, "the " * 120, 1), (204, text(rng, 300), 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_deleted int")
    got = {r.doc_id: r for r in delete_repeated(df).collect()}
    want = brute.repeated_words([r[:2] for r in rows if r[0] is not None], 50)
    for doc, old, _ in rows:
        if doc is None:
            assert (got[None].text, got[None].n_deleted) == (old, 0)
            continue
        keep = [w for i, w in enumerate(brute.words(old)) if i not in want[doc]]
        assert brute.words(got[doc].text) == keep, doc
        assert got[doc].n_deleted == len(want[doc])
        if not want[doc]:
            assert got[doc].text == old


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.repeated_words(docs, 50)
    got = {r.doc_id: r.n_deleted for r in delete_repeated(table).collect()}
    assert got == {d: len(w) for d, w in want.items()}


def check_all(spark, docs, n=50):
    got = {r.doc_id: (r.n_deleted, brute.words(r.text)) for r in delete_repeated(spark.createDataFrame(docs, "doc_id long, text string"), n).collect()}
    want = brute.repeated_words(docs, n)
    for doc, old in docs:
        assert got[doc] == (len(want[doc]), [w for i, w in enumerate(brute.words(old)) if i not in want[doc]]), doc


def test_passages_whose_parts_stand_earlier_in_other_documents(spark):
    rng = random.Random(11)
    docs = []
    for i in range(0, 400, 4):  # 36 words of L1 L2 L3 stand in each of the first two documents, all 54 in the others
        x, y, z = (text(rng, 18) for _ in range(3))
        own = [(text(rng, rng.randrange(20)), text(rng, rng.randrange(20))) for _ in range(4)]
        docs += [(i + j, f"{own[j][0]} {body} {own[j][1]}") for j, body in enumerate((f"{x} {y}", f"{y} {z}", f"{x} {y} {z}", f"{x} {y} {z}"))]
    check_all(spark, docs)


def test_chains_of_lines(spark):
    rng = random.Random(12)
    lines = [text(rng, rng.randrange(5, 40)) for _ in range(30)]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(2, 12)))) for i in range(120)]
    check_all(spark, docs)
    check_all(spark, docs, 70)


def test_passages_of_few_distinct_words(spark):
    rng = random.Random(13)
    docs = []
    for i in range(0, 240, 3):
        cycle = text(rng, 2 + i % 7).split()
        run = " ".join(cycle[j % len(cycle)] for j in range(rng.choice((49, 50, 60))))
        docs += [(i + j, f"{text(rng, rng.randrange(20))} {run} {text(rng, rng.randrange(20))}") for j in range(3)]
    check_all(spark, docs)


def test_equal_windows_choose_the_same_place():
    rng = random.Random(14)
    for i in range(2000):
        run = text(rng, 50).split() if i % 2 else [f"v{rng.randrange(3 + i % 5)}" for _ in range(50)]
        if i % 3 == 0:
            run[0] = "v1"
        chosen = []
        for front in ("v1", "w" + str(i)):  # one equal to the first word
            flat, starts = split_words([f"{front} {' '.join(run)} {text(rng, 9)}".encode()])
            at, h, w0, w1 = fingerprints(flat, starts)
            chosen.append({(int(p), int(x)) for p, x, a, b in zip(at, h, w0, w1, strict=True) if a <= 1 <= b})
        assert chosen[0] & chosen[1]


def test_columns_of_any_name_stay(spark):
    rng = random.Random(15)
    run = text(rng, 60)
    rows = [(i, f"{run} {i}", "a", "b", 7) for i in range(3)]
    got = delete_repeated(spark.createDataFrame(rows, "doc_id int, text string, runs string, run_doc string, n_deleted int"))
    assert got.columns == ["doc_id", "text", "runs", "run_doc", "n_deleted"]
    assert sorted(map(tuple, got.collect())) == [(0, f"{run} 0", "a", "b", 0), (1, "1", "a", "b", 60), (2, "2", "a", "b", 60)]


def test_empty_table(spark):
    assert delete_repeated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_merged():
    got = merged(*map(np.array, ([1, 0, 0, 1, 0, 0], [7, 5, 1, 2, 3, 8], [9, 9, 3, 4, 4, 12])))
    assert list(zip(*(x.tolist() for x in got), strict=True)) == [(0, 1, 4), (0, 5, 12), (1, 2, 4), (1, 7, 9)]
    assert [len(x) for x in merged(*[np.empty(0, np.int64)] * 3)] == [0, 0, 0]
