"""Benchmark items in documents: planted ones, re-parameterised ones, clean documents."""

import random
from collections import Counter

from signalspark.llm.decontaminate import benchmark_leaks

ITEM = "If Alice buys 12 apples for 3 dollars and sells 12 of them for 40 cents each, how much does Alice earn?"
RENAMED = "If Robert buys 75 apples for 9 dollars and sells 75 of them for 20 cents each, how much does Robert earn?"
BROKEN = "If Robert buys 75 apples for 9 euros and sells 14 pears to them at market, or how little would Susan pay?"
FILLER = "The tall grass moved in the wind while nobody looked at it and the day went on."


def leaks(spark, docs, items):
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    return {(r.doc_id, r.item_id): r for r in benchmark_leaks(d, b).collect()}


def test_copies_and_new_parameters_are_found(spark):
    docs = [(1, f"{FILLER} {ITEM} {FILLER}"), (2, f"{FILLER}\n{RENAMED}\n{FILLER}"), (3, f"{FILLER} {BROKEN}"), (4, FILLER), (5, None), (6, ""), (7, "20 31 42 53 64 75 86 97 10 11 12"), (8, ITEM), (8, ITEM), (None, ITEM)]
    items = [(10, ITEM), (11, None), (12, ""), (13, "two words"), (14, "Rome is a city."), (15, "1 2 3 4 5 6 7 8")]
    got = leaks(spark, docs, items)
    assert got.keys() == {(1, 10), (2, 10), (8, 10), (None, 10)}
    assert got[2, 10].renamed and not got[1, 10].renamed
    assert got[1, 10].n_covered == got[1, 10].n_words == len(ITEM.split())


def test_slots_must_agree(spark):
    # The two twelves become different numbers: the places of one of them don't count.
    odd = RENAMED.replace("sells 75", "sells 80")
    got = leaks(spark, [(1, RENAMED), (2, odd)], [(10, ITEM)])
    assert got[1, 10].n_covered > got[2, 10].n_covered


def test_short_items(spark):
    got = leaks(spark, [(1, "we say Rome is a city. often"), (2, "Rome is big")], [(14, "Rome is a city.")])
    assert got.keys() == {(1, 14)}


def test_parts_of_long_items(spark):
    rng = random.Random(2)
    words = [f"w{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}{chr(97 + i % 26)}" for i in range(200)]
    part = lambda a, b: f"{FILLER} {' '.join(words[a:b])} {FILLER}"
    got = leaks(spark, [(1, part(40, 150)), (2, part(180, 200)), (3, part(100, 119)), (4, part(0, 15) + part(50, 65))], [(10, " ".join(words))])
    assert {d: r.n_stretch for (d, _), r in got.items()} == {1: 110, 2: 20}


NAMES = ["Alice", "Robert", "Susan", "Peter", "Maria", "Kofi", "Ingrid", "Chen"]
TEMPLATE = "If {a} buys {x} apples for {y} dollars and gives {b} {x} of them, then {b} sells {z} apples, so how many does {a} keep?"


def fill(rng):
    a, b = rng.sample(NAMES, 2)
    x, y, z = rng.sample(range(2, 5000), 3)
    return {"a": a, "b": b, "x": x, "y": y, "z": z}


def test_recall_on_new_parameters_and_brute_force_of_the_slot_rule(spark):
    rng = random.Random(8)
    item = fill(rng)
    docs = [(i, f"{FILLER} {TEMPLATE.format(**fill(rng))} {FILLER}") for i in range(200)]
    got = leaks(spark, docs, [(10, TEMPLATE.format(**item))])
    assert len(got) == 200 and all(r.renamed and r.n_covered == r.n_words for r in got.values())
    # Each slot by itself at random: a value of the item stands for its most frequent value in the document (the smallest hash of equal ones).
    slots = [("a", 1), ("x", 3), ("y", 6), ("b", 10), ("x", 11), ("b", 15), ("z", 17), ("a", 23)]
    words = TEMPLATE.format(**item).split()
    docs, want = [], {}
    for i in range(100):
        w = list(words)
        for name, at in slots:
            w[at] = rng.choice(NAMES[:3]) if name in "ab" else str(rng.choice([7, 8, 9]))
        docs.append((i, f"{FILLER} {' '.join(w)} {FILLER}"))
        good = len(words) - len(slots)
        for name in "abxyz":
            good += max(Counter(w[at] for n, at in slots if n == name).values())
        want[i] = good
    got = leaks(spark, docs, [(10, " ".join(words))])
    assert {d: r.n_covered for (d, _), r in got.items()} == want


def test_whole_table_equals_search_of_whole_items(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    flat = lambda t: " ".join(t.split())
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in items.collect() if flat(b.text) in flat(d.text)}
    assert {(r.doc_id, r.item_id) for r in benchmark_leaks(docs, items).collect()} == want


def test_empty_tables(spark):
    assert leaks(spark, [(1, ITEM)], []) == {}
    assert leaks(spark, [], [(10, ITEM)]) == {}
