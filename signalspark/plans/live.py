"""Jobs that stay up: several queries at once, hourly averages of a stream, renaming, rejected messages, reports kept up to date."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from signalspark.functions.codecs import JSON_TIMES, as_text
from signalspark.functions.columns import col_
from signalspark.functions.maps import signal_value
from signalspark.names import tag
from signalspark.operators.analytics import datapoints_per_day, hourly_averages
from signalspark.operators.mapping import rename_by_mapping
from signalspark.operators.signals import normalize_signals, unpack_signals
from signalspark.plans.jobs import FILES_PER_TRIGGER, decode_messages, echo_job, ingest_job, produce_job, signal_keys, signal_schema, streamed_messages
from signalspark.schemas import SIGNAL_KEYS, SIGNAL_TABLE_SCHEMA, TRUNC_AVERAGE_NAMES, TURBINE_SCHEMA, WINDOW_AVERAGE_NAMES
from signalspark.sources.files import MAX_FILE_AGE
from signalspark.streaming.options import StreamOptions
from signalspark.streaming.runner import Part, run_parts
from signalspark.streaming.sinks import append_signals, read_batches, write_batches

#: How long an hour stays open for readings that come late.
LATENESS = "1 hour"


def run_together(
    spark: SparkSession,
    csv_path: str,
    work_dir: str,
    topic: str = "signals",
    payload: str = "json",
    table_format: str = "parquet",
    echo_schema: T.StructType | str | None = None,
    echo_sink: str = "console",
    echo_path: str | None = None,
    echo_name: str | None = None,
    processing_time: str | None = "1 second",
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
    drain: bool = True,
    timeout: float | None = None,
) -> dict[str, StreamingQuery]:
    """Producer, ingest and echo at once in one session; see ``run_parts`` for how they start, end and fail.

    Topic, table and checkpoints are below ``work_dir`` as with ``run_pipeline``, so either continues the other's work.  With ``drain`` all three have seen
    every row of the files that were there; else they run until stopped.
    """
    topic_path, checkpoints = f"{work_dir}/topic", f"{work_dir}/checkpoints"
    common = {"max_files_per_trigger": max_files_per_trigger, "processing_time": processing_time}
    return run_parts(
        [
            Part("produce", lambda: produce_job(spark, csv_path, topic, checkpoints, topic_path, payload=payload, **common), ("ingest", "echo")),
            Part("ingest", lambda: ingest_job(spark, topic, f"{work_dir}/table", checkpoints, topic_path, payload=payload, table_format=table_format, **common)),
            Part("echo", lambda: echo_job(spark, topic, checkpoints, topic_path, schema=echo_schema, sink=echo_sink, path=echo_path, query_name=echo_name, **common)),
        ],
        drain,
        timeout,
    )


def _job_options(checkpoint_root: str, job: str, topics: str | Sequence[str], *parts: object, processing_time: str | None, available_now: bool) -> StreamOptions:
    names = topics if isinstance(topics, str) else "+".join(topics)
    return StreamOptions(checkpoint_root, processing_time=processing_time, available_now=available_now).child(f"{job}-{names}-{tag(*parts)}")


def hourly_job(
    spark: SparkSession,
    topic: str | Sequence[str],
    table_path: str,
    checkpoint_root: str,
    topic_path: str | None = None,
    backend: str = "file",
    bootstrap_servers: str | None = None,
    payload: str = "json",
    schema: T.StructType = TURBINE_SCHEMA,
    lateness: str = LATENESS,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Topics -> hourly averages of each signal, appended to a table as hours close.

    An hour closes when a reading has come that is ``lateness`` later than its end; until then its sums and counts are kept in the query's
    state, through restarts.  Readings of closed hours are dropped (``late_rows``), readings without a time too.  The hours still open
    at the end are counted by ``open_hours``; they close as later readings come.  Columns: ``hour_start, hour_end`` and an average for each signal.
    """
    keys = signal_keys(schema)
    raw = streamed_messages(spark, topic, backend, topic_path, bootstrap_servers, max_files_per_trigger=max_files_per_trigger)
    rows = decode_messages(raw, payload, schema=schema).select("signal_ts", "signals").withWatermark("signal_ts", lateness)
    hours = hourly_averages(rows, "window", keys).select(
        F.col("hour.start").alias("hour_start"), F.col("hour.end").alias("hour_end"), *(col_(WINDOW_AVERAGE_NAMES.get(k, k)) for k in keys)
    )
    opts = _job_options(checkpoint_root, "hourly", topic, table_path, backend, topic_path, payload, lateness, processing_time=processing_time, available_now=available_now)
    return append_signals(hours, table_path, opts, partition_by=None)


def _state(progress: dict | None, name: str) -> int:
    return sum(op[name] for op in (progress or {}).get("stateOperators", []))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their hour had closed, over the progress reports that Spark still holds.

    Spark counts them after each task has summed its rows up: one for each task and hour.
    """
    return sum(_state(p, "numRowsDroppedByWatermark") for p in query.recentProgress)


def open_hours(query: StreamingQuery) -> int:
    """Hours that the state holds after the last batch."""
    return _state(query.lastProgress, "numRowsTotal")


RENAMED_SCHEMA = "signal_ts TIMESTAMP, sig_name STRING, sig_value DOUBLE, sig_mapping_name STRING"


def rename_job(
    spark: SparkSession,
    topic: str | Sequence[str],
    table_path: str,
    checkpoint_root: str,
    mapping: Callable[[], DataFrame] | Sequence[tuple[str, str]],
    topic_path: str | None = None,
    backend: str = "file",
    bootstrap_servers: str | None = None,
    payload: str = "json",
    schema: T.StructType = TURBINE_SCHEMA,
    on_duplicate: str = "dedupe",
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Topics -> a row for each reading and signal, with the signal's name in ``mapping``.

    ``mapping`` is a list of pairs, or a function that opens the mapping's table; that is called for every micro-batch, so a table rewritten between
    two batches counts from the next one on (a join with a table opened once would go on reading files that are gone).  Unmatched signals keep a
    NULL name.  Read the table with ``read_batches(spark, path, RENAMED_SCHEMA)``.
    """
    raw = streamed_messages(spark, topic, backend, topic_path, bootstrap_servers, max_files_per_trigger=max_files_per_trigger)
    long = unpack_signals(decode_messages(raw, payload, schema=schema), keep=["signal_ts"])

    def renamed(batch: DataFrame) -> DataFrame:
        return rename_by_mapping(batch, mapping() if callable(mapping) else mapping, "sig_name", on_duplicate=on_duplicate)

    opts = _job_options(checkpoint_root, "rename", topic, table_path, backend, topic_path, payload, on_duplicate, processing_time=processing_time, available_now=available_now)
    return write_batches(long, opts, {table_path: renamed})


REJECTED_SCHEMA = "key STRING, value STRING, reason STRING, create_ts TIMESTAMP"
_BROKEN = "__broken"


def sorted_out_job(
    spark: SparkSession,
    topic: str | Sequence[str],
    table_path: str,
    rejected_path: str,
    checkpoint_root: str,
    topic_path: str | None = None,
    backend: str = "file",
    bootstrap_servers: str | None = None,
    schema: T.StructType = TURBINE_SCHEMA,
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Topics of JSON messages -> signal table, and a table of the messages that are no such JSON, as they came.

    A message is rejected without a value, or when it isn't one JSON object or a field has another type than ``schema`` says.  A batch is parsed
    once and written to both tables; one that is run again replaces its rows.  A time that doesn't parse stays a NULL ``signal_ts``, as with
    ``ingest_job``.  Read the tables with ``read_batches`` (``SIGNAL_TABLE_SCHEMA``, ``REJECTED_SCHEMA``); the signal table's folders are by day.
    """
    raw = streamed_messages(spark, topic, backend, topic_path, bootstrap_servers, max_files_per_trigger=max_files_per_trigger)
    text = as_text(raw.select("key", "value"))
    fields = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = text.select("key", "value", F.from_json("value", fields, {**JSON_TIMES, "columnNameOfCorruptRecord": _BROKEN}).alias("data"))
    no_value = F.col("value").isNull() | (F.trim("value") == "")
    bad = no_value | F.col("data").isNull() | F.col(f"data.{_BROKEN}").isNotNull()

    def good(batch: DataFrame) -> DataFrame:
        return normalize_signals(batch.where(~bad).select("key", "data.*"), keys=signal_keys(schema))

    def rejected(batch: DataFrame) -> DataFrame:
        reason = F.when(no_value, "no value").otherwise("not the JSON that was asked for")
        return batch.where(bad).select("key", "value", reason.alias("reason"), F.current_timestamp().alias("create_ts"))

    opts = _job_options(checkpoint_root, "sort-out", topic, table_path, rejected_path, backend, topic_path, processing_time=processing_time, available_now=available_now)
    return write_batches(parsed, opts, {table_path: good, rejected_path: rejected}, {table_path: ["signal_date"]})


def _hours_schema(keys: Sequence[str]) -> T.StructType:
    sums = [T.StructField(f"{kind}{i}", t) for i in range(len(keys)) for kind, t in (("sum", T.DoubleType()), ("count", T.LongType()))]
    return T.StructType([T.StructField("signal_hour", T.TimestampType()), *sums])


_DAYS_SCHEMA = "signal_date DATE, signal_ts TIMESTAMP"


def update_reports(
    spark: SparkSession,
    table_path: str,
    kept_path: str,
    checkpoint_root: str,
    keys: Sequence[str] = SIGNAL_KEYS,
    table_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    processing_time: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Bring what ``kept_reports`` reads up to date with a signal table; only files that came since the last call are read.

    Each batch of new files leaves its sums and counts for each hour, and its distinct times of each day: parts that can be merged with those of
    other batches, and far smaller than the readings.
    """
    rows = spark.readStream.schema(signal_schema()).format(table_format).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        rows = rows.option("maxFilesPerTrigger", int(max_files_per_trigger))

    def hours(batch: DataFrame) -> DataFrame:
        values = batch.select(F.date_trunc("hour", "signal_ts").alias("signal_hour"), *(signal_value(k).alias(f"value{i}") for i, k in enumerate(keys)))
        sums = [f(f"value{i}").alias(f"{name}{i}") for i in range(len(keys)) for name, f in (("sum", F.sum), ("count", F.count))]
        return values.groupBy("signal_hour").agg(*sums)

    def days(batch: DataFrame) -> DataFrame:
        return batch.select("signal_date", "signal_ts").distinct()

    opts = StreamOptions(checkpoint_root, processing_time=processing_time, available_now=available_now).child(f"reports-{tag(table_path, kept_path, *keys)}")
    return write_batches(rows.load(table_path), opts, {f"{kept_path}/hours": hours, f"{kept_path}/days": days})


def kept_reports(spark: SparkSession, kept_path: str, keys: Sequence[str] = SIGNAL_KEYS) -> dict[str, DataFrame]:
    """``datapoints_per_day`` and ``hourly_trunc`` as ``report_job`` gives them, merged from the parts of all batches."""
    parts = read_batches(spark, f"{kept_path}/hours", _hours_schema(keys))
    totals = parts.groupBy("signal_hour").agg(*(F.sum(c).alias(c) for c in parts.columns[1:]))
    averages = [F.try_divide(f"sum{i}", f"count{i}").alias(TRUNC_AVERAGE_NAMES.get(k, k)) for i, k in enumerate(keys)]
    return {"datapoints_per_day": datapoints_per_day(read_batches(spark, f"{kept_path}/days", _DAYS_SCHEMA)), "hourly_trunc": totals.select("signal_hour", *averages)}


__all__ = [
    "REJECTED_SCHEMA",
    "RENAMED_SCHEMA",
    "SIGNAL_TABLE_SCHEMA",
    "hourly_job",
    "kept_reports",
    "late_rows",
    "open_hours",
    "rename_job",
    "run_together",
    "sorted_out_job",
    "update_reports",
]
