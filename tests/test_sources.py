"""Sources: CSV and line file streams, the message log, stored tables."""

from __future__ import annotations

import pytest

from signalspark.schemas import TURBINE_SCHEMA
from signalspark.sources import (
    csv_stream,
    kafka_sink_options,
    kafka_source_options,
    line_stream,
    read_table,
    topic_stream,
)
from signalspark.streaming import StreamOptions, echo_stream, run_stream
from tests.fixtures import EDGE_CSV, write_text


def _drain(spark, df, tmp_path, name):
    opts = StreamOptions(str(tmp_path / "ck"), available_now=True, query_name=name).child(name)
    run_stream(echo_stream(df, opts, sink="memory"))
    return spark.table(name)


def test_csv_stream_rejects_a_single_file(spark, tmp_path):
    f = write_text(tmp_path / "in", "T1.csv", EDGE_CSV)
    with pytest.raises(ValueError, match="directory or a glob"):
        csv_stream(spark, f)


def test_csv_stream_glob_with_header(spark, tmp_path):
    write_text(tmp_path / "in", "T1.csv", EDGE_CSV)
    write_text(tmp_path / "in", "other.txt", "not,csv\n")
    df = csv_stream(spark, str(tmp_path / "in" / "T1*.csv"))
    assert df.isStreaming and df.schema == TURBINE_SCHEMA
    rows = _drain(spark, df, tmp_path, "csv_glob").collect()
    assert len(rows) == 5 and sorted(r["Date/Time"] for r in rows)[0] == "01 01 2018 00:00"
    assert sum(r["LV ActivePower (kW)"] is None for r in rows) == 1


def test_csv_stream_without_header_keeps_header_row(spark, tmp_path):
    write_text(tmp_path / "in", "T1.csv", EDGE_CSV)
    rows = _drain(spark, csv_stream(spark, str(tmp_path / "in"), header=False), tmp_path, "csv_nohdr").collect()
    assert len(rows) == 6
    header = [r for r in rows if r["Date/Time"] == "Date/Time"]
    assert len(header) == 1 and header[0]["Wind Speed (m/s)"] is None


def test_csv_stream_wrong_separator(spark, tmp_path):
    write_text(tmp_path / "in", "T1.csv", EDGE_CSV)
    rows = _drain(spark, csv_stream(spark, str(tmp_path / "in"), sep=";"), tmp_path, "csv_semi").collect()
    assert all(r["LV ActivePower (kW)"] is None for r in rows)
    assert any(r["Date/Time"] == "01 01 2018 00:00,380.04,5.31,416.32,259.99" for r in rows)


def test_csv_stream_rate_limit(spark, tmp_path):
    for i in range(3):
        write_text(tmp_path / "in", f"T{i}.csv", EDGE_CSV)
    df = csv_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    opts = StreamOptions(str(tmp_path / "ck"), available_now=True, query_name="csv_rate").child("rate")
    q = echo_stream(df, opts, sink="memory")
    run_stream(q)
    assert spark.table("csv_rate").count() == 15
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 3


def test_line_stream(spark, tmp_path):
    write_text(tmp_path / "in", "a.txt", "x,1\ny,2\n")
    rows = _drain(spark, line_stream(spark, str(tmp_path / "in")), tmp_path, "lines").collect()
    assert sorted(r.value for r in rows) == ["x,1", "y,2"]


def test_topic_stream_validation(spark, tmp_path):
    with pytest.raises(ValueError):
        topic_stream(spark, "t", backend="kafka")
    with pytest.raises(ValueError):
        topic_stream(spark, "t", backend="file")
    with pytest.raises(ValueError):
        topic_stream(spark, "t", backend="file", path=str(tmp_path), starting="latest")
    with pytest.raises(ValueError):
        topic_stream(spark, "t", backend="pulsar", path=str(tmp_path))
    with pytest.raises(ValueError, match="max_files_per_trigger"):
        topic_stream(spark, "t", path=str(tmp_path), max_offsets_per_trigger=10)
    with_headers = topic_stream(spark, "t", path=str(tmp_path), include_headers=True)
    assert with_headers.columns[-1] == "headers"
    assert dict(with_headers.dtypes)["headers"] == "array<struct<key:string,value:binary>>"


def test_kafka_options():
    opts = kafka_source_options("b:9092", "turbine", include_headers=True, max_offsets_per_trigger=500)
    assert opts == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "turbine",
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": "500",
    }
    assert kafka_sink_options("b:9092", "turbine") == {"kafka.bootstrap.servers": "b:9092", "topic": "turbine"}


def test_read_table_reuses_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    first = read_table(spark, path)
    again = read_table(spark, path)
    assert first.schema == again.schema and again.count() == 5
