"""Compare registered Spark queries with their DuckDB oracles.

Order-insensitive, exact: rows are sorted after normalising NaN/None and
timestamps; columns are matched by name.  Usable from pytest and as a script:

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import sys
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, repr(v))
    if isinstance(v, dt.datetime):
        return (1, v.replace(tzinfo=None).isoformat())
    if isinstance(v, (bytes, bytearray)):
        return (1, bytes(v).hex())
    return (1, repr(v))


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    import __spark_entry__ as E

    con = con or duck(sf_dir)
    sdf = E.queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_recs = [tuple(r) for r in sdf.collect()]
    rel = con.sql(E.oracle_sql()[name])
    d_cols = rel.columns
    d_recs = rel.fetchall()
    out = {
        "name": name,
        "rows": (len(s_recs), len(d_recs)),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "duck_columns": d_cols,
    }
    out["values_match"] = out["columns_match"] and _rows(s_cols, s_recs) == _rows(d_cols, d_recs)
    out["ok"] = out["values_match"] and len(s_recs) == len(d_recs)
    if not out["ok"] and out["columns_match"]:
        a, b = _rows(s_cols, s_recs), _rows(d_cols, d_recs)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        out["first_diffs"] = diff
    return out


def main(argv: list[str]) -> int:
    from tests.conftest import make_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = make_session()
    import __spark_entry__ as E

    names = argv[1:] or list(E.oracle_sql())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as exc:  # report and go on
            r = {"name": n, "ok": False, "error": repr(exc)[:600]}
        bad += not r["ok"]
        print(r if not r["ok"] else f"OK {n} rows={r['rows'][0]}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
