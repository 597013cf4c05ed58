"""Every registered query against its DuckDB oracle, and the driver entry point.

The comparison runs at sf0.001 by default; ``SIGNALSPARK_ORACLE_SF=/root/testdata/sf0.01``
runs it at the driver's correctness scale.
"""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

ORACLE_SF = os.environ.get("SIGNALSPARK_ORACLE_SF", SF_SMALL)


@pytest.fixture(scope="module")
def con():
    c = duck(ORACLE_SF)
    yield c
    c.close()


def test_every_query_has_an_oracle():
    # The training-data queries have their own tests; those that SQL can't express have no oracle.
    assert set(E.queries()) - set(E.LLM_QUERIES) == set(E.oracle_sql()) - set(E.LLM_ORACLES)
    assert set(E.LLM_ORACLES) <= set(E.LLM_QUERIES)


@pytest.mark.parametrize("name", list(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, ORACLE_SF, con)
    assert r["columns_match"], (r["spark_columns"], r["duck_columns"])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["signal_hour", "generation_indicator", "sig_name", "average", "sig_mapping_name"]
    assert len(rows) > 0 and len(rows) % 4 == 0
    assert {r.sig_mapping_name for r in rows} == {
        "active_power_average",
        "wind_speed_average",
        "theo_power_curve_average",
        "wind_direction_average",
    }


@pytest.mark.parametrize(
    "name", ["datapoints_per_day", "hourly_avg_trunc", "hourly_avg_window", "nested_decode", "parse_signal_ts"]
)
def test_time_queries_do_not_depend_on_the_session_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(spark, name, ORACLE_SF, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert r["ok"], r
