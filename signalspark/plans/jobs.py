"""The four jobs: produce, ingest, echo, report -- and a whole pipeline run.

Produce and echo are stateless projections between a source and a sink, with no
shuffle; ingest shuffles a micro-batch once, to bound the files it
writes for each day.  The checkpoint folder of a streaming query is named after the job, the
topics and the sink, so that no two queries share one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalspark.functions.codecs import as_text, decode_json, encode_concat, encode_json
from signalspark.functions.columns import col_
from signalspark.functions.maps import signal_value
from signalspark.names import tag
from signalspark.operators.analytics import Days, add_indicator, datapoints_per_day, hourly_averages, select_days
from signalspark.operators.mapping import rename_by_mapping
from signalspark.operators.signals import normalize_nested, normalize_signals, unpivot_signals
from signalspark.schemas import DATE_TIME, NESTED_PAYLOAD_DDL, POWER, SIGNAL_KEYS, SIGNAL_TABLE_SCHEMA, TRUNC_AVERAGE_NAMES, TURBINE_SCHEMA
from signalspark.sources.files import csv_stream, read_signals
from signalspark.sources.mapping import mapping_pairs
from signalspark.sources.topic import topic_stream
from signalspark.streaming.options import StreamOptions
from signalspark.streaming.runner import run_stream
from signalspark.streaming.sinks import append_signals, echo_stream, write_topic

PAYLOADS = ("json", "concat", "nested")
#: Files of a micro-batch of the producer, unless given: the first batch is not the whole input.
FILES_PER_TRIGGER = 1000


def signal_keys(schema: T.StructType) -> tuple[str, ...]:
    """The signals of a reading: its DOUBLE columns."""
    return tuple(f.name for f in schema.fields if isinstance(f.dataType, T.DoubleType))


def signal_schema(signal_date_type: str = "date", text_values: bool = False) -> T.StructType:
    """The stored signal table's schema with the given kind of day and of map values."""
    kinds = {}
    if signal_date_type == "string":
        kinds["signal_date"] = T.StringType()
    if text_values:
        kinds["signals"] = T.MapType(T.StringType(), T.StringType())
    return T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in SIGNAL_TABLE_SCHEMA.fields])


def _options(checkpoint_root: str, name: str, processing_time: str | None, available_now: bool) -> StreamOptions:
    return StreamOptions(checkpoint_root, processing_time=processing_time, available_now=available_now).child(name)


def produce_job(
    spark: SparkSession,
    csv_path: str,
    topic: str,
    checkpoint_root: str,
    topic_path: str | None = None,
    backend: str = "file",
    bootstrap_servers: str | None = None,
    payload: str = "json",
    schema: T.StructType = TURBINE_SCHEMA,
    key_col: str | None = DATE_TIME,
    header: bool = True,
    sep: str = ",",
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """CSV file stream -> ``key, value`` messages -> topic.

    ``payload``: ``'json'`` (``to_json(struct(*))``, the default),
    ``'concat'`` (lossy ``concat(*)`` text), or ``'nested'`` (an already
    normalised signal row as JSON).
    """
    readings = csv_stream(spark, csv_path, schema, header, sep, max_files_per_trigger)
    if payload == "json":
        messages = encode_json(readings, key_col)
    elif payload == "concat":
        messages = encode_concat(readings, key_col)
    elif payload == "nested":
        key_col = key_col or DATE_TIME
        rows = normalize_signals(
            readings.withColumn("key", col_(key_col).cast("string")), key_col="key", keys=signal_keys(schema), with_load_time=False, keep=["key"]
        )
        messages = rows.select("key", F.to_json(F.struct("signal_date", "signal_ts", "signals")).alias("value"))
    else:
        raise ValueError(f"payload must be one of {PAYLOADS}")
    name = f"produce-{topic}-{tag(backend, topic_path, bootstrap_servers, csv_path, payload)}"
    opts = _options(checkpoint_root, name, processing_time, available_now)
    return write_topic(messages, topic, opts, backend, topic_path, bootstrap_servers)


def decode_messages(
    messages: DataFrame,
    payload: str = "json",
    signal_date_type: str = "date",
    schema: T.StructType = TURBINE_SCHEMA,
    text_values: bool = False,
) -> DataFrame:
    """Raw ``key, value`` messages -> signal rows (the ingest transformation).

    ``schema`` is the one the readings were produced with; its DOUBLE columns are the signals.  A nested payload carries its
    own names; ``text_values`` keeps its map of texts.
    """
    if payload == "nested" and signal_date_type != "date":
        raise ValueError("a nested payload carries a DATE signal_date")
    if payload != "nested" and text_values:
        raise ValueError("only a nested payload has text values")
    text = as_text(messages.select("key", "value"))
    if payload in ("json", "concat"):
        # A concat payload is not JSON: every signal decodes to NULL.
        return normalize_signals(decode_json(text, schema), keys=signal_keys(schema), signal_date_type=signal_date_type)
    if payload == "nested":
        return normalize_nested(decode_json(text, NESTED_PAYLOAD_DDL, keep=()), text_values)
    raise ValueError(f"payload must be one of {PAYLOADS}")


def streamed_messages(
    spark: SparkSession,
    topic: str | Sequence[str],
    backend: str = "file",
    topic_path: str | None = None,
    bootstrap_servers: str | None = None,
    starting: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The raw messages of one topic or of several."""
    raw = None
    for name in [topic] if isinstance(topic, str) else list(topic):
        messages = topic_stream(
            spark,
            name,
            backend,
            topic_path,
            bootstrap_servers,
            starting,
            max_offsets_per_trigger=max_offsets_per_trigger,
            max_files_per_trigger=max_files_per_trigger,
        )
        raw = messages if raw is None else raw.union(messages)
    return raw


def ingest_job(
    spark: SparkSession,
    topic: str | Sequence[str],
    table_path: str,
    checkpoint_root: str,
    topic_path: str | None = None,
    backend: str = "file",
    bootstrap_servers: str | None = None,
    payload: str = "json",
    starting: str = "earliest",
    table_format: str = "parquet",
    partition_by: Sequence[str] | str | None = "auto",
    signal_date_type: str = "date",
    schema: T.StructType = TURBINE_SCHEMA,
    text_values: bool = False,
    files_per_partition: int = 4,
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Topics -> decode -> normalise -> append to the signal table.

    Several topics into one table are one query (a table folder takes one writer).  ``partition_by='auto'`` is
    ``signal_date`` where that is a DATE; a text date has a folder for each minute, so it is refused.
    """
    topics = [topic] if isinstance(topic, str) else list(topic)
    raw = streamed_messages(spark, topics, backend, topic_path, bootstrap_servers, starting, max_offsets_per_trigger, max_files_per_trigger)
    rows = decode_messages(raw, payload, signal_date_type, schema, text_values)
    if partition_by == "auto":
        partition_by = ("signal_date",) if signal_date_type == "date" else None
    elif partition_by and signal_date_type != "date" and "signal_date" in partition_by:
        raise ValueError("a text signal_date would make a folder for each minute")
    name = f"ingest-{'+'.join(topics)}-{tag(table_path, table_format, backend, topic_path, payload, signal_date_type, text_values)}"
    opts = _options(checkpoint_root, name, processing_time, available_now)
    return append_signals(rows, table_path, opts, table_format, partition_by, files_per_partition)


def echo_job(
    spark: SparkSession,
    topic: str,
    checkpoint_root: str,
    topic_path: str | None = None,
    backend: str = "file",
    bootstrap_servers: str | None = None,
    schema: T.StructType | str | None = None,
    sink: str = "console",
    path: str | None = None,
    query_name: str | None = None,
    starting: str = "earliest",
    truncate: bool = False,
    include_headers: bool = False,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Topic -> key and value as text (or a decode with ``schema``, e.g. the narrow one) -> echo sink."""
    raw = topic_stream(spark, topic, backend, topic_path, bootstrap_servers, starting, include_headers, max_files_per_trigger=max_files_per_trigger)
    text = as_text(raw.select("key", "value", *(["headers"] if include_headers else [])))
    out = text if schema is None else decode_json(text, schema, keep=())
    opts = StreamOptions(
        checkpoint_root, processing_time=processing_time, available_now=available_now, query_name=query_name
    ).child(f"echo-{topic}-{tag(sink, path, query_name, schema, backend, topic_path)}")
    return echo_stream(out, opts, sink, truncate, path=path)


def report_job(
    spark: SparkSession,
    table_path: str,
    table_format: str = "parquet",
    mapping: DataFrame | Sequence[tuple[str, str]] | None = None,
    keys: Sequence[str] = SIGNAL_KEYS,
    signal_date_type: str = "date",
    text_values: bool = False,
    days: Days | None = None,
) -> dict[str, DataFrame]:
    """The batch reports over the signal table, as lazy DataFrames.

    Each is its own job when acted on; each scan reads only the columns it
    needs.  ``signal_rename`` aggregates first (wide, partial aggregation)
    and only then turns the few hourly rows long and joins the mapping.  The date type and ``text_values`` are
    those the table was ingested with; the indicator reports need the power among ``keys``.  ``days`` chooses the days
    that are reported, and read (see ``select_days``).
    """
    table = read_signals(spark, table_path, table_format, signal_schema(signal_date_type, text_values))
    if days is not None:
        if signal_date_type != "date":
            raise ValueError("days are chosen from a table whose signal_date is a DATE")
        table = select_days(table, days)
    hourly = hourly_averages(table, "trunc", keys, cast=text_values)
    wide = hourly_averages(table, "trunc", keys, names={k: k for k in keys}, cast=text_values)
    long = unpivot_signals(wide, ["signal_hour"], keys, "sig_name", "average")
    out = {
        "datapoints_per_day": datapoints_per_day(table, "date"),
        "datapoints_per_day_trunc": datapoints_per_day(table, "trunc"),
        "hourly_trunc": hourly,
        "hourly_window": hourly_averages(table, "window", keys, cast=text_values),
        "signal_rename": rename_by_mapping(long, mapping_pairs() if mapping is None else mapping, "sig_name", on_duplicate="dedupe"),
    }
    if POWER in keys:
        out["indicator_per_reading"] = add_indicator(table, signal_value(POWER, cast=text_values))
        out["indicator_per_hour"] = add_indicator(hourly, TRUNC_AVERAGE_NAMES[POWER])
    return out


def run_pipeline(
    spark: SparkSession,
    csv_path: str,
    work_dir: str,
    topic: str = "signals",
    payload: str = "json",
    table_format: str = "parquet",
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
) -> str:
    """Produce then ingest everything under ``csv_path``; return the table path.

    Both run with ``availableNow`` one after the other, so the ingest sees
    every message (a concurrent pair only sees what is there when it starts).
    Rerunning on the same ``work_dir`` adds nothing already processed.
    """
    topic_path = f"{work_dir}/topic"
    table_path = f"{work_dir}/table"
    checkpoints = f"{work_dir}/checkpoints"
    run_stream(
        produce_job(
            spark,
            csv_path,
            topic,
            checkpoints,
            topic_path,
            payload=payload,
            max_files_per_trigger=max_files_per_trigger,
            available_now=True,
        )
    )
    run_stream(
        ingest_job(
            spark,
            topic,
            table_path,
            checkpoints,
            topic_path,
            payload=payload,
            table_format=table_format,
            max_files_per_trigger=max_files_per_trigger,
            available_now=True,
        )
    )
    return table_path
