"""Physical plans: the shapes the report queries are meant to have."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from signalspark.plans.queries import QUERIES
from tests.conftest import SF_SMALL

# Queries that run streams (and so jobs) while being built.
STREAMING = {"stream_concurrent", "stream_hourly_window", "stream_signal_rename", "stream_quarantine", "report_days", "report_kept", "csv_plain_ingest", "csv_ingest", "line_stream", "stream_end_to_end", "stream_nested_ingest", "stream_narrow_echo"}


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _exchanges(text: str) -> list[str]:
    return re.findall(r"^\(\d+\) Exchange\s*$", text, flags=re.M)


def test_hourly_average_is_one_shuffle_of_partial_rows(spark):
    text = plan_text(QUERIES["hourly_avg_trunc"](spark, SF_SMALL))
    assert len(_exchanges(text)) == 1
    assert text.count("HashAggregate") >= 2  # partial + final


def test_hourly_average_of_derived_rows_builds_no_map(spark):
    assert "map(" not in plan_text(QUERIES["hourly_avg_trunc"](spark, SF_SMALL)).split("FileScan")[0]


def test_day_counts_read_only_the_timestamp(spark):
    text = plan_text(QUERIES["datapoints_per_day"](spark, SF_SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in text
    assert len(_exchanges(text)) == 2  # de-duplicate on (day, ts), then count per day


def test_mapping_is_broadcast(spark):
    for name in ("mapping_join_fanout", "signal_rename", "mapping_literal_join"):
        text = plan_text(QUERIES[name](spark, SF_SMALL))
        assert "BroadcastHashJoin" in text and "LeftOuter" in text, name


def test_signal_rename_aggregates_before_reshaping(spark):
    text = plan_text(QUERIES["signal_rename"](spark, SF_SMALL))
    # the long form is made from hourly rows (Expand after the aggregate), not per reading
    assert text.index("Expand") < text.index("HashAggregate")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_python_evaluation(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in text, (name, node)


def test_json_is_decoded_once_per_row(spark):
    for name in ("json_envelope", "json_narrow_decode", "nested_decode"):
        text = plan_text(QUERIES[name](spark, SF_SMALL))
        physical = text.split("== Physical Plan ==")[-1]
        # one from_json per Project line, however many fields are expanded
        lines = [line for line in physical.splitlines() if "from_json(" in line and line.startswith("Output")]
        assert len(lines) == 1 and lines[0].count("from_json(") == 1, (name, lines)
