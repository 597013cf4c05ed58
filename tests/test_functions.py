"""Column functions: banding, timestamp parsing, map lookups, codecs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from signalspark.functions import (
    as_text,
    decode_json,
    encode_concat,
    encode_json,
    generation_indicator,
    parse_signal_ts,
    signal_value,
)
from signalspark.schemas import NARROW_SCHEMA, POWER, TURBINE_SCHEMA
from tests.fixtures import edge_readings


def test_indicator_band_edges(spark):
    values = [199.99, 200.0, 599.99, 600.0, 999.99, 1000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "p DOUBLE")
    got = [r[0] for r in df.select(generation_indicator("p")).collect()]
    assert got == ["Low", "Medium", "Medium", "High", "High", "Exceptional", "Exceptional"]


def test_indicator_custom_thresholds_and_validation(spark):
    df = spark.createDataFrame([(1,), (5,), (50,)], "x INT")
    got = [r[0] for r in df.select(generation_indicator(F.col("x"), (2, 10), ("a", "b", "c"))).collect()]
    assert got == ["a", "b", "c"]
    with pytest.raises(ValueError):
        generation_indicator("x", (1, 2), ("a", "b"))
    with pytest.raises(ValueError):
        generation_indicator("x", (5, 1), ("a", "b", "c"))


def test_parse_signal_ts(spark):
    df = spark.createDataFrame([("01 01 2018 00:10",), ("31 12 2018 23:50",), ("bad",), (None,)], "k STRING")
    got = [r[0] for r in df.select(F.date_format(parse_signal_ts("k"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2018-01-01 00:10", "2018-12-31 23:50", None, None]


def test_signal_value_missing_key_and_text_cast(spark):
    df = spark.createDataFrame([({"a": 1.5},)], "signals MAP<STRING, DOUBLE>")
    row = df.select(signal_value("a").alias("a"), signal_value("Wind Direction ()").alias("m")).first()
    assert row.a == 1.5 and row.m is None
    text = spark.createDataFrame([({"a": "2.5", "b": "abc"},)], "signals MAP<STRING, STRING>")
    row = text.select(signal_value("a", cast=True).alias("a"), signal_value("b", cast=True).alias("b")).first()
    assert row.a == 2.5 and row.b is None


def test_encode_json_omits_nulls_and_keeps_key(spark):
    enc = encode_json(edge_readings(spark), "Date/Time").collect()
    assert enc[0].key == "01 01 2018 00:00"
    blank = json.loads(enc[2].value)
    assert POWER not in blank and blank["Wind Speed (m/s)"] == 5.0


def test_encode_json_timestamps_keep_microseconds(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 10:00:07.179575' AS t")
    value = encode_json(df).first().value
    assert json.loads(value)["t"].startswith("2024-01-01T10:00:07.179575")


def test_concat_payload_null_and_no_separator(spark):
    got = encode_concat(edge_readings(spark), "Date/Time").collect()
    assert got[1].value == "01 01 2018 00:00100.01.01.01.0"
    assert got[2].value is None


def test_decode_json_round_trip_and_malformed(spark):
    readings = edge_readings(spark)
    back = decode_json(encode_json(readings, "Date/Time"), TURBINE_SCHEMA)
    assert back.columns == ["key"] + TURBINE_SCHEMA.names
    assert [tuple(r)[1:] for r in back.collect()] == [tuple(r) for r in readings.collect()]
    bad = decode_json(encode_concat(readings, "Date/Time"), TURBINE_SCHEMA).collect()
    assert all(all(v is None for v in tuple(r)[1:]) for r in bad)


def test_narrow_decode_ignores_undeclared_fields(spark):
    narrow = decode_json(encode_json(edge_readings(spark)), NARROW_SCHEMA, keep=()).collect()
    assert narrow[0].asDict() == {
        "LV ActivePower (kW)": 380.04,
        "Wind Speed (m/s)": 5.31,
        "Theoretical_Power_Curve (KWh)": 416.32,
        "Wind Direction (°)": 259.99,
    }


def test_nested_ddl_on_flat_rows_gives_nulls(spark):
    from signalspark.schemas import NESTED_PAYLOAD_DDL

    out = decode_json(encode_json(edge_readings(spark)), NESTED_PAYLOAD_DDL, keep=()).collect()
    assert all(r.signal_ts is None and r.signals is None for r in out)


def test_as_text_casts_binary(spark):
    df = spark.createDataFrame([(bytearray(b"k1"), bytearray(b"v1"), 3)], "key BINARY, value BINARY, n INT")
    row = as_text(df).first()
    assert (row.key, row.value, row.n) == ("k1", "v1", 3)
