"""Secrets against Python's expressions and DuckDB; trigram queries."""

import hashlib
import random
import re

import duckdb

from signalspark.llm.secret_scan import ORACLE, RULES, scan_secrets, trigram_query


def brute(text):
    spans = []
    for k, r in enumerate(RULES):
        pattern = {"access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}.get(r.kind, r.pattern)  # as stated, short ones dropped
        least = {"access": 20, "hex": 24}.get(r.kind, r.least)
        for m in re.finditer(pattern, text or "", re.ASCII | (re.IGNORECASE if r.ignore_case else 0)):
            if len(m[r.group]) >= least and not (r.ignore_case and not m[0][: m.end(1) - m.start()].isascii()):
                spans.append((m.start(), k, m.end(), r.kind))
    spans.sort()
    write = lambda xs: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in xs)
    base = [s for s in spans if s[1] < 3]
    return (*(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(write(base).encode()).hexdigest(), write(spans))


def made_texts():
    rng = random.Random(11)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "apikey", '"', "'", " ", "  ", ":", "=", ": ", "= '", "abc", "hunter2hunter2", "x" * 5, "y" * 6, "AKIA", "AKIA" + "Q7" * 8, "Z" * 15, "deadbeef" * 3, "0123456789abcdef01234567", "é😀", "\n", "ghp_" + "a1B2" * 9, "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN PRIVATE KEY-----", "the "]
    made = ["".join(rng.choices(bits, k=rng.randrange(1, 25))) for _ in range(600)]
    return [None, "", "token=secret=abcdef", "secret: token: abcdefgh", "AKIAAKIA" + "A" * 20, "f" * 23, "f" * 24, "f" * 5000, *made]


def test_equal_to_python(spark):
    texts = made_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "token = abcdefgh", "x"), (5, "password=123456", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, rules string")
    got = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in scan_secrets(df).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t, _ in rows), key=str)
    assert scan_secrets(df.limit(0)).collect() == []


def test_duckdb_oracle(spark):
    rows = list(enumerate(made_texts()))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cols = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE})").fetchall())
    assert want == sorted((d, *brute(t)) for d, t in rows)


def test_trigram_queries():
    assert trigram_query("[0-9a-f]{24,}") == frozenset([frozenset()])
    assert trigram_query("AKIA[A-Z0-9]{16,}") == {frozenset(["aki", "kia"])}
    assert trigram_query("ab(cd|xy)z?e") == {frozenset(["abc", "bcd", "cde"]), frozenset(["abc", "bcd", "cdz", "dze"]), frozenset(["abx", "bxy", "xye"]), frozenset(["abx", "bxy", "xyz", "yze"])}
    assert {frozenset(["tok", "oke", "ken"]), frozenset(["api", "pik", "ike", "key"])} <= trigram_query(RULES[0].pattern)


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh")], "doc_id long, text string")
    plan = scan_secrets(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_many_matches_in_one_text(spark):
    texts = ["0123456789abcdef01234567 token=abcdefgh " * n for n in (1, 63, 64, 65, 4097, 50_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in scan_secrets(df).collect()), key=str)
    assert got == sorted(((d, *brute(t)) for d, t in enumerate(texts)), key=str)
