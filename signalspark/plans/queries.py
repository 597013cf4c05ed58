"""Registered queries over the test tables, each with a DuckDB oracle.

Every query reads whole tables from ``sf_dir`` (or data Spark derives from
them) and returns a flat, aliased DataFrame: MAP/STRUCT results are taken
apart, timestamps are TIMESTAMP_NTZ, and load-time columns are left out,
so that the oracle comparison is exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.functions.codecs import as_text, decode_json, encode_concat, encode_json
from signalspark.functions.columns import col_
from signalspark.functions.indicator import generation_indicator
from signalspark.functions.maps import signal_value
from signalspark.functions.timeparse import parse_signal_ts
from signalspark.operators.analytics import add_indicator, datapoints_per_day, hourly_averages
from signalspark.operators.mapping import rename_by_mapping
from signalspark.operators.partitioning import spread_partitions
from signalspark.operators.signals import normalize_signals, unpack_signals, unpivot_signals
from signalspark.plans.derived import signal_columns, signal_table, turbine_readings, write_csv
from signalspark.plans.jobs import echo_job, ingest_job, produce_job, report_job, run_pipeline
from signalspark.plans.live import REJECTED_SCHEMA, RENAMED_SCHEMA, hourly_job, kept_reports, rename_job, run_together, sorted_out_job, update_reports
from signalspark.schemas import (
    DATE_TIME,
    MAPPING_JSON,
    MAPPING_ROWS,
    NARROW_SCHEMA,
    NESTED_PAYLOAD_DDL,
    POWER,
    SIGNAL_KEYS,
    SIGNAL_TABLE_SCHEMA,
    TURBINE_SCHEMA,
    WIND_DIRECTION,
    WINDOW_AVERAGE_NAMES,
)
from signalspark.session import scratch_dir
from signalspark.sources.files import csv_stream, line_stream, read_signals, read_table
from signalspark.sources.mapping import mapping_from_json, mapping_pairs
from signalspark.streaming.options import StreamOptions
from signalspark.streaming.runner import Part, run_parts, run_stream
from signalspark.streaming.sinks import echo_stream, read_batches, write_topic

Query = Callable[[SparkSession, str], DataFrame]

# The lookup key with the missing degree sign, as the
# original hourly report spelled it.
MISSPELT_DIRECTION_KEY = "Wind Direction ()"
# Thresholds for banding lineitem prices (same four labels).
PRICE_THRESHOLDS = (20000, 60000, 100000)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    """The test tables are one row group each, so JSON work on them would be one task."""
    return spread_partitions(df, df.sparkSession.sparkContext.defaultParallelism)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turbine_readings(_table(spark, sf_dir, "events"))


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_table(_table(spark, sf_dir, "events"))


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal_columns(_table(spark, sf_dir, "events"))


def _ntz(c: Column | str) -> Column:
    return (col_(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _flat_window(df: DataFrame, window_col: str = "hour") -> DataFrame:
    rest = [col_(c) for c in df.columns if c != window_col]
    return df.select(
        _ntz(F.col(f"{window_col}.start")).alias("hour_start"),
        _ntz(F.col(f"{window_col}.end")).alias("hour_end"),
        *rest,
    )


# ------------------------------------------------------------- report queries
def datapoints_per_day_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return datapoints_per_day(_signals(spark, sf_dir), by="date")


def datapoints_per_key_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day counts over the table as the original ingest produced it: its
    ``signal_date`` is the message key text, so every group is one minute."""
    sig = normalize_signals(_readings(spark, sf_dir), key_col=DATE_TIME, signal_date_type="string", with_load_time=False)
    return datapoints_per_day(sig, by="date")


def datapoints_per_day_trunc_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = datapoints_per_day(_signals(spark, sf_dir), by="trunc")
    return d.select(_ntz("date").alias("date"), "datapoints_per_day")


def _hourly_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly_averages(_columns(spark, sf_dir), "trunc", map_col=None)
    return h.withColumn("signal_hour", _ntz("signal_hour"))


def hourly_avg_trunc_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly_trunc(spark, sf_dir)


def hourly_avg_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_window(hourly_averages(_columns(spark, sf_dir), "window", map_col=None))


def _nested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signal_table(_spread(_table(spark, sf_dir, "events")))
    return sig.select(F.to_json(F.struct("signal_date", "signal_ts", "signals")).alias("value"))


def hourly_avg_text_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_json(_nested_messages(spark, sf_dir), NESTED_PAYLOAD_DDL, keep=())
    h = hourly_averages(decoded, "trunc", cast=True)
    return h.withColumn("signal_hour", _ntz("signal_hour"))


def indicator_per_reading_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = add_indicator(_signals(spark, sf_dir), signal_value(POWER))
    return sig.select(
        "signal_date",
        _ntz("signal_ts").alias("signal_ts"),
        signal_value(POWER).alias("active_power"),
        "generation_indicator",
    )


def indicator_per_hour_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_indicator(_hourly_trunc(spark, sf_dir), "avg_LV_ActivePower")


def indicator_lineitem_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    return add_indicator(li, "l_extendedprice", thresholds=PRICE_THRESHOLDS)


def map_missing_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly_averages(
        _signals(spark, sf_dir), "trunc", keys=[MISSPELT_DIRECTION_KEY], names={MISSPELT_DIRECTION_KEY: "avg_Wind_Direction"}
    )
    return h.withColumn("signal_hour", _ntz("signal_hour"))


# ------------------------------------------------------------ mapping queries
def _long_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = _signals(spark, sf_dir).select(_ntz("signal_ts").alias("signal_ts"), "signals")
    return unpack_signals(sig, keep=["signal_ts"])


def mapping_join_fanout_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_by_mapping(
        _long_readings(spark, sf_dir), mapping_pairs(), "sig_name", on_duplicate="keep"
    )


def mapping_join_dedupe_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_by_mapping(
        _long_readings(spark, sf_dir), mapping_pairs(), "sig_name", on_duplicate="dedupe"
    )


def mapping_literal_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ind = indicator_per_hour_q(spark, sf_dir)
    return rename_by_mapping(
        ind, MAPPING_ROWS, "generation_indicator", replace=True
    )


def signal_rename_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = hourly_averages(_columns(spark, sf_dir), "trunc", names={k: k for k in SIGNAL_KEYS}, map_col=None)
    wide = wide.withColumn("signal_hour", _ntz("signal_hour"))
    long = unpivot_signals(wide, ["signal_hour"], SIGNAL_KEYS, "sig_name", "average")
    return rename_by_mapping(
        long, mapping_pairs(), "sig_name", on_duplicate="dedupe"
    )


# -------------------------------------------------------------- codec queries
def _messages(df: DataFrame) -> DataFrame:
    """As a topic holds them: key and value BINARY."""
    cols = [F.col(c).cast("binary").alias(c) for c in ("key", "value") if c in df.columns]
    return df.select(*cols)


def json_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _spread(_table(spark, sf_dir, "lineitem"))
    text = as_text(_messages(encode_json(li, "l_orderkey")))
    return decode_json(text, li.schema)


def json_narrow_decode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _spread(_table(spark, sf_dir, "lineitem"))
    text = as_text(_messages(encode_json(li, "l_orderkey")))
    return decode_json(text, "l_orderkey BIGINT, l_extendedprice DOUBLE")


def json_malformed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    return decode_json(encode_concat(nation, "n_nationkey"), nation.schema)


def concat_payload_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_concat(_table(spark, sf_dir, "nation"), "n_nationkey")


def concat_indicator_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = encode_concat(_readings(spark, sf_dir), DATE_TIME)
    rows = normalize_signals(decode_json(messages, TURBINE_SCHEMA), with_load_time=False)
    rows = add_indicator(rows, signal_value(POWER))
    return rows.select(_ntz("signal_ts").alias("signal_ts"), "generation_indicator")


def nested_decode_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = decode_json(_nested_messages(spark, sf_dir), NESTED_PAYLOAD_DDL, keep=())
    return decoded.select(
        "signal_date",
        _ntz("signal_ts").alias("signal_ts"),
        signal_value(POWER, cast=True).alias("active_power"),
    )


def parse_signal_ts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _readings(spark, sf_dir)
    return r.select(col_(DATE_TIME), _ntz(parse_signal_ts(col_(DATE_TIME))).alias("signal_ts"))


# ---------------------------------------------------------- streaming queries
def csv_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> CSV files -> CSV file stream -> Parquet sink -> batch read."""
    work = scratch_dir(spark, "csv_ingest")
    customer = _table(spark, sf_dir, "customer")
    write_csv(customer, f"{work}/in")
    stream = csv_stream(spark, f"{work}/in", schema=customer.schema)
    opts = StreamOptions(f"{work}/checkpoints", available_now=True).child("csv-ingest")
    run_stream(opts.start(stream.writeStream.format("parquet").option("path", f"{work}/out")))
    return spark.read.schema(customer.schema).parquet(f"{work}/out")


def csv_plain_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier -> files without a header, parted by semicolons -> file stream with the default trigger, drained."""
    work = scratch_dir(spark, "csv_plain_ingest")
    supplier = _table(spark, sf_dir, "supplier")
    write_csv(_spread(supplier), f"{work}/in", header=False, sep=";")
    stream = csv_stream(spark, f"{work}/in", schema=supplier.schema, header=False, sep=";", max_files_per_trigger=3)
    opts = StreamOptions(f"{work}/checkpoints").child("csv-plain-ingest")
    run_parts([Part("ingest", lambda: echo_stream(stream, opts, sink="parquet", path=f"{work}/out"))])
    return spark.read.schema(supplier.schema).parquet(f"{work}/out")


def line_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> header-less CSV lines -> line stream -> Parquet sink."""
    work = scratch_dir(spark, "line_stream")
    write_csv(_table(spark, sf_dir, "nation"), f"{work}/in", header=False)
    opts = StreamOptions(f"{work}/checkpoints", available_now=True).child("lines")
    run_stream(echo_stream(line_stream(spark, f"{work}/in"), opts, sink="parquet", path=f"{work}/out"))
    return spark.read.schema("value STRING").parquet(f"{work}/out")


def _stream_input(spark: SparkSession, sf_dir: str, work: str) -> str:
    """The readings as CSV files, one per task slot, for the file streams."""
    events = _spread(_table(spark, sf_dir, "events"))
    return write_csv(turbine_readings(events), f"{work}/csv")


def _pipeline_table(spark: SparkSession, sf_dir: str, name: str, payload: str) -> str:
    work = scratch_dir(spark, name)
    _stream_input(spark, sf_dir, work)
    return run_pipeline(spark, f"{work}/csv", work, payload=payload)


def stream_end_to_end_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV stream -> JSON topic -> signal table -> hourly window report."""
    table = read_signals(spark, _pipeline_table(spark, sf_dir, "end_to_end", "json"))
    return _flat_window(hourly_averages(table, "window"))


def stream_nested_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV stream -> nested-JSON topic -> signal table -> datapoints per day."""
    table = read_signals(spark, _pipeline_table(spark, sf_dir, "nested_ingest", "nested"))
    return datapoints_per_day(table, by="date")


def stream_narrow_echo_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV stream -> JSON topic -> narrow decode echoed to a Parquet sink."""
    work = scratch_dir(spark, "narrow_echo")
    _stream_input(spark, sf_dir, work)
    topic_path = f"{work}/topic"
    run_stream(produce_job(spark, f"{work}/csv", "signals", f"{work}/checkpoints", topic_path, available_now=True))
    run_stream(
        echo_job(
            spark,
            "signals",
            f"{work}/checkpoints",
            topic_path,
            schema=NARROW_SCHEMA,
            sink="parquet",
            path=f"{work}/out",
            available_now=True,
        )
    )
    return spark.read.schema(NARROW_SCHEMA).parquet(f"{work}/out")


def stream_two_topics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two producers on one topic path, both topics ingested into one table: no row is lost."""
    work = scratch_dir(spark, "two_topics")
    events = _table(spark, sf_dir, "events")
    for k in (0, 1):
        write_csv(turbine_readings(events.where(F.col("event_id") % 2 == k)), f"{work}/csv{k}")
        run_stream(produce_job(spark, f"{work}/csv{k}", f"half {k}", f"{work}/checkpoints", f"{work}/topics", available_now=True))
    run_stream(ingest_job(spark, ["half 0", "half 1"], f"{work}/table", f"{work}/checkpoints", f"{work}/topics", available_now=True))
    return datapoints_per_day(read_signals(spark, f"{work}/table"), by="date")


def stream_text_echo_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV stream -> JSON topic -> key and value echoed as text (the value's power picked out)."""
    work = scratch_dir(spark, "text_echo")
    _stream_input(spark, sf_dir, work)
    run_stream(produce_job(spark, f"{work}/csv", "signals", f"{work}/checkpoints", f"{work}/topic", available_now=True))
    run_stream(echo_job(spark, "signals", f"{work}/checkpoints", f"{work}/topic", sink="parquet", path=f"{work}/out", available_now=True))
    out = spark.read.schema("key STRING, value STRING").parquet(f"{work}/out")
    return out.select("key", F.from_json("value", TURBINE_SCHEMA)[POWER].alias("active_power"))


def _ingested(spark: SparkSession, sf_dir: str, name: str, payload: str, **kinds) -> dict[str, DataFrame]:
    """The reports over a table of the given kind that the ingest wrote."""
    work = scratch_dir(spark, name)
    _stream_input(spark, sf_dir, work)
    run_stream(produce_job(spark, f"{work}/csv", "signals", f"{work}/checkpoints", f"{work}/topic", payload=payload, available_now=True))
    run_stream(ingest_job(spark, "signals", f"{work}/table", f"{work}/checkpoints", f"{work}/topic", payload=payload, available_now=True, **kinds))
    return report_job(spark, f"{work}/table", **kinds)


def report_string_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day counts over a stored table whose ``signal_date`` is the key text."""
    return _ingested(spark, sf_dir, "string_date", "json", signal_date_type="string")["datapoints_per_day"]


def report_text_map_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly averages over a stored table whose map holds texts."""
    h = _ingested(spark, sf_dir, "text_map", "nested", text_values=True)["hourly_trunc"]
    return h.withColumn("signal_hour", _ntz("signal_hour"))


def mapping_rows_join_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long readings and the literal mapping: three names match, the wind direction stays NULL."""
    return rename_by_mapping(_long_readings(spark, sf_dir), MAPPING_ROWS, "sig_name")


def json_events_envelope_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole events to JSON messages and back, microseconds kept."""
    events = _table(spark, sf_dir, "events")
    return decode_json(as_text(_messages(encode_json(events, "event_id"))), events.schema)


def stream_concurrent_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer, ingest and text echo at once until drained: hourly averages of the table, and the messages of each hour in the echo."""
    work = scratch_dir(spark, "concurrent")
    _stream_input(spark, sf_dir, work)
    run_together(spark, f"{work}/csv", work, echo_sink="parquet", echo_path=f"{work}/echo", max_files_per_trigger=3)
    hours = _flat_window(hourly_averages(read_signals(spark, f"{work}/table"), "window"))
    echo = spark.read.schema("key STRING, value STRING").parquet(f"{work}/echo")
    echoed = echo.groupBy(_ntz(F.date_trunc("hour", parse_signal_ts(F.col("key")))).alias("hour_start")).agg(F.count("value").alias("echoed"))
    return hours.join(echoed, "hour_start", "left")


def stream_hourly_window_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hours that a streaming average has closed, in two runs; an hour that the first run leaves open is finished by the second."""
    work = scratch_dir(spark, "hourly_window")
    events = _spread(_table(spark, sf_dir, "events"))
    first, last = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    for k, half in enumerate((F.col("ts") < first + (last - first) / 2, F.col("ts") >= first + (last - first) / 2)):
        write_csv(turbine_readings(events.where(half)), f"{work}/csv{k}")
        run_stream(produce_job(spark, f"{work}/csv*", "signals", f"{work}/checkpoints", f"{work}/topic", available_now=True))
        run_stream(hourly_job(spark, "signals", f"{work}/hours", f"{work}/checkpoints", f"{work}/topic", available_now=True))
    hours = spark.read.parquet(f"{work}/hours")
    return hours.select(*(_ntz(c).alias(c) for c in ("hour_start", "hour_end")), *hours.columns[2:])


def stream_signal_rename_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a topic as rows for each signal, renamed through a mapping document that is read again for every batch."""
    work = scratch_dir(spark, "signal_rename")
    _stream_input(spark, sf_dir, work)
    spark.createDataFrame([(MAPPING_JSON,)], "value STRING").coalesce(1).write.text(f"{work}/mapping")
    run_stream(produce_job(spark, f"{work}/csv", "signals", f"{work}/checkpoints", f"{work}/topic", available_now=True))
    mapping = lambda: mapping_from_json(spark, path=f"{work}/mapping")
    run_stream(rename_job(spark, "signals", f"{work}/renamed", f"{work}/checkpoints", mapping, f"{work}/topic", max_files_per_trigger=4, available_now=True))
    out = read_batches(spark, f"{work}/renamed", RENAMED_SCHEMA)
    return out.withColumn("signal_ts", _ntz("signal_ts"))


def stream_quarantine_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic in which the messages of some wind directions are cut short: what was stored, and what was rejected."""
    work = scratch_dir(spark, "quarantine")
    _stream_input(spark, sf_dir, work)
    direction = F.get_json_object("value", f"$['{WIND_DIRECTION}']").cast("double")
    cut = F.when(direction % 7 == 0, F.expr("substr(value, 1, length(value) - 1 - length(value) div 3)")).otherwise(F.col("value"))
    messages = encode_json(csv_stream(spark, f"{work}/csv"), DATE_TIME).select("key", cut.alias("value"))
    run_stream(write_topic(messages, "signals", StreamOptions(f"{work}/checkpoints", available_now=True).child("cut"), path=f"{work}/topic"))
    run_stream(sorted_out_job(spark, "signals", f"{work}/table", f"{work}/rejected", f"{work}/checkpoints", f"{work}/topic", max_files_per_trigger=3, available_now=True))
    stored = read_batches(spark, f"{work}/table", SIGNAL_TABLE_SCHEMA).select(_ntz("signal_ts").alias("signal_ts"), signal_value(POWER).alias("active_power"), F.lit(False).alias("rejected"))
    rejected = read_batches(spark, f"{work}/rejected", REJECTED_SCHEMA)
    return stored.union(rejected.select(_ntz(parse_signal_ts(F.col("key"))), F.lit(None).cast("double"), F.lit(True)))


def report_days_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly averages of every third day, chosen by a table of days."""
    work = scratch_dir(spark, "report_days")
    _stream_input(spark, sf_dir, work)
    table = run_pipeline(spark, f"{work}/csv", work)
    events = _table(spark, sf_dir, "events")
    days = events.select(F.to_date("ts").alias("signal_date")).where(F.dayofmonth("signal_date") % 3 == 0)
    return _flat_window(report_job(spark, table, days=days)["hourly_window"])


def report_kept_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly averages and times of each day, kept up to date over two ingests."""
    work = scratch_dir(spark, "report_kept")
    events = _spread(_table(spark, sf_dir, "events"))
    for k in (0, 1):
        write_csv(turbine_readings(events.where(F.col("event_id") % 2 == k)), f"{work}/csv{k}")
        table = run_pipeline(spark, f"{work}/csv*", work)
        run_stream(update_reports(spark, table, f"{work}/kept", f"{work}/checkpoints"))
    reports = kept_reports(spark, f"{work}/kept")
    hours = reports["hourly_trunc"].withColumn("signal_date", F.to_date("signal_hour")).withColumn("signal_hour", _ntz("signal_hour"))
    return hours.join(reports["datapoints_per_day"], "signal_date")


QUERIES: dict[str, Query] = {
    "stream_concurrent": stream_concurrent_q,
    "stream_hourly_window": stream_hourly_window_q,
    "stream_signal_rename": stream_signal_rename_q,
    "stream_quarantine": stream_quarantine_q,
    "report_days": report_days_q,
    "report_kept": report_kept_q,
    "stream_two_topics": stream_two_topics_q,
    "stream_text_echo": stream_text_echo_q,
    "report_string_date": report_string_date_q,
    "report_text_map": report_text_map_q,
    "mapping_rows_join": mapping_rows_join_q,
    "json_events_envelope": json_events_envelope_q,
    "datapoints_per_day": datapoints_per_day_q,
    "datapoints_per_day_trunc": datapoints_per_day_trunc_q,
    "datapoints_per_key_text": datapoints_per_key_text_q,
    "hourly_avg_trunc": hourly_avg_trunc_q,
    "hourly_avg_window": hourly_avg_window_q,
    "hourly_avg_text_map": hourly_avg_text_map_q,
    "indicator_per_reading": indicator_per_reading_q,
    "indicator_per_hour": indicator_per_hour_q,
    "indicator_lineitem": indicator_lineitem_q,
    "map_missing_key": map_missing_key_q,
    "mapping_join_fanout": mapping_join_fanout_q,
    "mapping_join_dedupe": mapping_join_dedupe_q,
    "mapping_literal_join": mapping_literal_join_q,
    "signal_rename": signal_rename_q,
    "json_envelope": json_envelope_q,
    "json_narrow_decode": json_narrow_decode_q,
    "json_malformed": json_malformed_q,
    "concat_payload": concat_payload_q,
    "concat_indicator": concat_indicator_q,
    "nested_decode": nested_decode_q,
    "parse_signal_ts": parse_signal_ts_q,
    "csv_ingest": csv_ingest_q,
    "csv_plain_ingest": csv_plain_ingest_q,
    "line_stream": line_stream_q,
    "stream_end_to_end": stream_end_to_end_q,
    "stream_nested_ingest": stream_nested_ingest_q,
    "stream_narrow_echo": stream_narrow_echo_q,
}


# ------------------------------------------------------------- DuckDB oracles
_READINGS = """readings AS (
  SELECT strftime(ts, '%d %m %Y %H:%M') AS "Date/Time",
         CASE WHEN event_type = 'error' THEN NULL
              ELSE CAST(floor(value * 10 + 0.5) AS DOUBLE) END AS "LV ActivePower (kW)",
         CAST(json_extract(props, '$.k') AS DOUBLE) AS "Wind Speed (m/s)",
         CAST(user_id AS DOUBLE) AS "Theoretical_Power_Curve (KWh)",
         CAST(event_id % 360 AS DOUBLE) AS "Wind Direction (°)"
  FROM events)"""

_SIG = (
    "WITH "
    + _READINGS
    + """,
sig AS (
  SELECT CAST(strptime("Date/Time", '%d %m %Y %H:%M') AS DATE) AS signal_date,
         strptime("Date/Time", '%d %m %Y %H:%M') AS signal_ts,
         "LV ActivePower (kW)" AS p, "Wind Speed (m/s)" AS w,
         "Theoretical_Power_Curve (KWh)" AS t, "Wind Direction (°)" AS d
  FROM readings)
"""
)

_HOURLY = (
    _SIG
    + """, hourly AS (
  SELECT date_trunc('hour', signal_ts) AS signal_hour,
         avg(p) AS avg_LV_ActivePower, avg(w) AS avg_Wind_Speed,
         avg(t) AS avg_Theoretical_Power_Curve, avg(d) AS avg_Wind_Direction
  FROM sig GROUP BY 1)
"""
)

_LONG = """long AS (
  SELECT signal_ts, 'LV ActivePower (kW)' AS sig_name, p AS sig_value FROM sig
  UNION ALL SELECT signal_ts, 'Wind Speed (m/s)', w FROM sig
  UNION ALL SELECT signal_ts, 'Theoretical_Power_Curve (KWh)', t FROM sig
  UNION ALL SELECT signal_ts, 'Wind Direction (°)', d FROM sig)
"""

_MAPPING_JSON = """mapping(sig_name, sig_mapping_name) AS (VALUES
  ('LV ActivePower (kW)', 'active_power_average'),
  ('Wind Speed (m/s)', 'wind_speed_average'),
  ('Theoretical_Power_Curve (KWh)', 'theo_power_curve_average'),
  ('Theoretical_Power_Curve (KWh)', 'theo_power_curve_average'),
  ('Wind Direction (°)', 'wind_direction_average'))
"""

_MAPPING_ROWS = """mapping(sig_name, sig_mapping_name) AS (VALUES
  ('LV ActivePower (kW)', 'active_power_average'),
  ('Wind Speed (m/s)', 'wind_speed_average'),
  ('Theoretical_Power_Curve (KWh)', 'theo_power_curve_avg'),
  (' Wind Direction', 'wind_direction_average'))
"""

_BAND = """CASE WHEN {c} < 200 THEN 'Low' WHEN {c} < 600 THEN 'Medium'
            WHEN {c} < 1000 THEN 'High' ELSE 'Exceptional' END"""

_WINDOW = """SELECT date_trunc('hour', signal_ts) AS hour_start,
       date_trunc('hour', signal_ts) + INTERVAL 1 HOUR AS hour_end,
       avg(p) AS average_LV_ActivePower, avg(w) AS average_Wind_Speed,
       avg(t) AS average_Theoretical_Power_Curve, avg(d) AS average_Wind_Direction
FROM sig WHERE signal_ts IS NOT NULL GROUP BY 1, 2"""

_DATAPOINTS = "SELECT signal_date, count(DISTINCT signal_ts) AS datapoints_per_day FROM sig GROUP BY signal_date"

ORACLES: dict[str, str] = {
    "stream_concurrent": _SIG
    + f"SELECT w.*, e.echoed FROM ({_WINDOW}) w LEFT JOIN (SELECT date_trunc('hour', signal_ts) AS hour_start, count(*) AS echoed FROM sig GROUP BY 1) e USING (hour_start)",
    "stream_hourly_window": _SIG + f"SELECT * FROM ({_WINDOW}) WHERE hour_end <= (SELECT max(signal_ts) - INTERVAL 1 HOUR FROM sig)",
    "stream_signal_rename": _SIG
    + ", "
    + _LONG
    + ", "
    + _MAPPING_JSON
    + "SELECT l.signal_ts, l.sig_name, l.sig_value, m.sig_mapping_name "
    "FROM long l LEFT JOIN (SELECT DISTINCT * FROM mapping) m ON l.sig_name = m.sig_name",
    "stream_quarantine": _SIG + "SELECT signal_ts, CASE WHEN d % 7 <> 0 THEN p END AS active_power, d % 7 = 0 AS rejected FROM sig",
    "report_days": _SIG + f"SELECT * FROM ({_WINDOW}) WHERE day(hour_start) % 3 = 0",
    "report_kept": _HOURLY
    + f"SELECT h.*, d.* FROM hourly h JOIN ({_DATAPOINTS}) d ON CAST(h.signal_hour AS DATE) = d.signal_date",
    "datapoints_per_day": _SIG + _DATAPOINTS,
    "datapoints_per_day_trunc": _SIG
    + "SELECT CAST(date_trunc('day', signal_ts) AS TIMESTAMP) AS date, "
    "count(DISTINCT signal_ts) AS datapoints_per_day FROM sig GROUP BY 1",
    "datapoints_per_key_text": "WITH "
    + _READINGS
    + """ SELECT "Date/Time" AS signal_date,
       count(DISTINCT strptime("Date/Time", '%d %m %Y %H:%M')) AS datapoints_per_day
FROM readings GROUP BY 1""",
    "hourly_avg_trunc": _HOURLY + "SELECT * FROM hourly",
    "hourly_avg_window": _SIG + _WINDOW,
    "hourly_avg_text_map": _HOURLY + "SELECT * FROM hourly",
    "indicator_per_reading": _SIG
    + "SELECT signal_date, signal_ts, p AS active_power, "
    + _BAND.format(c="p")
    + " AS generation_indicator FROM sig",
    "indicator_per_hour": _HOURLY + "SELECT *, " + _BAND.format(c="avg_LV_ActivePower") + " AS generation_indicator FROM hourly",
    "indicator_lineitem": "SELECT *, CASE WHEN l_extendedprice < 20000 THEN 'Low' "
    "WHEN l_extendedprice < 60000 THEN 'Medium' WHEN l_extendedprice < 100000 THEN 'High' "
    "ELSE 'Exceptional' END AS generation_indicator FROM lineitem",
    "map_missing_key": _SIG
    + "SELECT date_trunc('hour', signal_ts) AS signal_hour, CAST(NULL AS DOUBLE) AS avg_Wind_Direction "
    "FROM sig GROUP BY 1",
    "mapping_join_fanout": _SIG
    + ", "
    + _LONG
    + ", "
    + _MAPPING_JSON
    + "SELECT l.signal_ts, l.sig_name, l.sig_value, m.sig_mapping_name "
    "FROM long l LEFT JOIN mapping m ON l.sig_name = m.sig_name",
    "mapping_join_dedupe": _SIG
    + ", "
    + _LONG
    + ", "
    + _MAPPING_JSON
    + "SELECT l.signal_ts, l.sig_name, l.sig_value, m.sig_mapping_name "
    "FROM long l LEFT JOIN (SELECT DISTINCT * FROM mapping) m ON l.sig_name = m.sig_name",
    "mapping_literal_join": _HOURLY
    + ", "
    + _MAPPING_ROWS
    + ", ind AS (SELECT *, "
    + _BAND.format(c="avg_LV_ActivePower")
    + " AS generation_indicator FROM hourly) "
    "SELECT i.signal_hour, i.avg_LV_ActivePower, i.avg_Wind_Speed, i.avg_Theoretical_Power_Curve, "
    "i.avg_Wind_Direction, m.sig_mapping_name AS generation_indicator "
    "FROM ind i LEFT JOIN mapping m ON i.generation_indicator = m.sig_name",
    "signal_rename": _HOURLY
    + ", "
    + _MAPPING_JSON
    + """, long AS (
  SELECT signal_hour, 'LV ActivePower (kW)' AS sig_name, avg_LV_ActivePower AS average FROM hourly
  UNION ALL SELECT signal_hour, 'Wind Speed (m/s)', avg_Wind_Speed FROM hourly
  UNION ALL SELECT signal_hour, 'Theoretical_Power_Curve (KWh)', avg_Theoretical_Power_Curve FROM hourly
  UNION ALL SELECT signal_hour, 'Wind Direction (°)', avg_Wind_Direction FROM hourly)
SELECT l.signal_hour, l.sig_name, l.average, m.sig_mapping_name
FROM long l LEFT JOIN (SELECT DISTINCT * FROM mapping) m ON l.sig_name = m.sig_name""",
    "json_envelope": "SELECT CAST(l_orderkey AS VARCHAR) AS key, * FROM lineitem",
    "json_narrow_decode": "SELECT CAST(l_orderkey AS VARCHAR) AS key, l_orderkey, l_extendedprice FROM lineitem",
    "json_malformed": """WITH m AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS key,
         CAST(n_nationkey AS VARCHAR) || n_name || CAST(n_regionkey AS VARCHAR) AS value FROM nation)
SELECT key,
       CASE WHEN json_valid(value) THEN CAST(json_extract(value, '$.n_nationkey') AS INTEGER) END AS n_nationkey,
       CASE WHEN json_valid(value) THEN json_extract_string(value, '$.n_name') END AS n_name,
       CASE WHEN json_valid(value) THEN CAST(json_extract(value, '$.n_regionkey') AS INTEGER) END AS n_regionkey
FROM m""",
    "concat_payload": "SELECT CAST(n_nationkey AS VARCHAR) AS key, "
    "CAST(n_nationkey AS VARCHAR) || n_name || CAST(n_regionkey AS VARCHAR) AS value FROM nation",
    "concat_indicator": _SIG + "SELECT signal_ts, 'Exceptional' AS generation_indicator FROM sig",
    "nested_decode": _SIG + "SELECT signal_date, signal_ts, p AS active_power FROM sig",
    "parse_signal_ts": "WITH "
    + _READINGS
    + """ SELECT "Date/Time", strptime("Date/Time", '%d %m %Y %H:%M') AS signal_ts FROM readings""",
    "csv_ingest": "SELECT * FROM customer",
    "csv_plain_ingest": "SELECT * FROM supplier",
    "line_stream": "SELECT CAST(n_nationkey AS VARCHAR) || ',' || n_name || ',' || CAST(n_regionkey AS VARCHAR) "
    "AS value FROM nation",
    "stream_end_to_end": _SIG + _WINDOW,
    "stream_two_topics": _SIG + _DATAPOINTS,
    "stream_text_echo": "WITH " + _READINGS + """ SELECT "Date/Time" AS key, "LV ActivePower (kW)" AS active_power FROM readings""",
    "report_string_date": "WITH "
    + _READINGS
    + """ SELECT "Date/Time" AS signal_date,
       count(DISTINCT strptime("Date/Time", '%d %m %Y %H:%M')) AS datapoints_per_day
FROM readings GROUP BY 1""",
    "report_text_map": _HOURLY + "SELECT * FROM hourly",
    "mapping_rows_join": _SIG
    + ", "
    + _LONG
    + ", "
    + _MAPPING_ROWS
    + "SELECT l.signal_ts, l.sig_name, l.sig_value, m.sig_mapping_name "
    "FROM long l LEFT JOIN mapping m ON l.sig_name = m.sig_name",
    "json_events_envelope": "SELECT CAST(event_id AS VARCHAR) AS key, * FROM events",
    "stream_nested_ingest": _SIG + _DATAPOINTS,
    "stream_narrow_echo": "WITH "
    + _READINGS
    + """ SELECT "LV ActivePower (kW)", "Wind Speed (m/s)", "Theoretical_Power_Curve (KWh)",
       "Wind Direction (°)" FROM readings""",
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings -> hourly averages -> indicator -> signals renamed through the mapping."""
    wide = hourly_averages(_columns(spark, sf_dir), "trunc", names={k: k for k in SIGNAL_KEYS}, map_col=None)
    wide = wide.select(
        _ntz("signal_hour").alias("signal_hour"),
        generation_indicator(col_(POWER)).alias("generation_indicator"),
        *[col_(k) for k in SIGNAL_KEYS],
    )
    ids = ["signal_hour", "generation_indicator"]
    long = unpivot_signals(wide, ids, SIGNAL_KEYS, "sig_name", "average")
    return rename_by_mapping(
        long, mapping_pairs(), "sig_name", on_duplicate="dedupe"
    )


__all__ = ["ORACLES", "QUERIES", "WINDOW_AVERAGE_NAMES", "flagship"]
