"""Streaming sinks: the message log, the signal table, an echo."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from signalspark.sources.files import check_sink, claim_sink, make_folder
from signalspark.sources.topic import kafka_sink_options, topic_folder
from signalspark.streaming.options import StreamOptions


def _start_owned(spark: SparkSession, paths: Sequence[str], options: StreamOptions, writer: DataStreamWriter) -> StreamingQuery:
    """Start a query whose sink folders are its own (see ``check_sink``)."""
    for path in paths:
        check_sink(spark, path, options.checkpoint)
    query = options.start(writer)
    try:
        for path in paths:
            claim_sink(spark, path, query.id)
    except Exception:
        query.stop()
        raise
    return query


def write_topic(
    df: DataFrame,
    topic: str,
    options: StreamOptions,
    backend: str = "file",
    path: str | None = None,
    bootstrap_servers: str | None = None,
) -> StreamingQuery:
    """Publish ``key`` (optional) and ``value`` rows to ``topic``.

    Raises at once when there is no ``value`` column or when ``key`` or
    ``value`` is neither STRING nor BINARY (as Kafka's sink demands), rather
    than when the first micro-batch fails.  The file back end writes ``key``,
    ``value``, ``topic`` and ``timestamp`` to the topic's own folder below ``path``, one file for each
    task of a micro-batch: the input's splits set their number, nothing is shuffled.
    """
    if "value" not in df.columns:
        raise ValueError("a topic sink needs a 'value' column (and optionally 'key')")
    types = dict(df.dtypes)
    for c in ("key", "value"):
        if c in types and types[c] not in ("string", "binary"):
            raise ValueError(f"topic column {c!r} must be STRING or BINARY, not {types[c]}")
    has_key = "key" in df.columns
    key = F.col("key") if has_key else F.lit(None).cast("string")
    if backend == "kafka":
        if not bootstrap_servers:
            raise ValueError("the kafka back end needs bootstrap_servers")
        cols = (["key"] if has_key else []) + ["value"]
        writer = df.select(*cols).writeStream.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic))
        return options.start(writer)
    if backend != "file":
        raise ValueError("backend must be 'file' or 'kafka'")
    if not path:
        raise ValueError("the file back end needs a path")
    folder = topic_folder(path, topic)
    records = df.select(
        key.cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.current_timestamp().alias("timestamp"),
    )
    return _start_owned(df.sparkSession, [folder], options, records.writeStream.format("parquet").option("path", folder))


def append_signals(
    df: DataFrame,
    path: str,
    options: StreamOptions,
    table_format: str = "parquet",
    partition_by: Sequence[str] | None = ("signal_date",),
    files_per_partition: int = 4,
) -> StreamingQuery:
    """Append signal rows to a table folder (exactly-once via the sink's log).

    Partitioning by ``signal_date`` lets later reads prune whole days.  A micro-batch is clustered by the
    partition columns and a hash of the time, so it writes at most ``files_per_partition`` files for
    each of their values (not one for each task and value) and a hot day is still several tasks' work.
    """
    if partition_by:
        cell = F.pmod(F.xxhash64("signal_ts"), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], cell)
    writer = df.writeStream.format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _start_owned(df.sparkSession, [] if table_format == "delta" else [path], options, writer.option("path", path))


def echo_stream(
    df: DataFrame,
    options: StreamOptions,
    sink: str = "console",
    truncate: bool = False,
    num_rows: int = 20,
    path: str | None = None,
) -> StreamingQuery:
    """Show each micro-batch: ``console`` (untruncated by default), ``memory``
    (for tests; needs ``options.query_name``) or a file format with ``path``."""
    writer = df.writeStream.format(sink)
    if sink == "console":
        writer = writer.option("truncate", str(truncate).lower()).option("numRows", num_rows)
    elif sink == "memory":
        if not options.query_name:
            raise ValueError("a memory sink needs options.query_name")
    elif path:
        return _start_owned(df.sparkSession, [path], options, writer.option("path", path))
    else:
        raise ValueError(f"sink {sink!r} needs a path")
    return options.start(writer)


def write_batches(
    df: DataFrame,
    options: StreamOptions,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    partition_by: Mapping[str, Sequence[str]] | None = None,
) -> StreamingQuery:
    """Write several tables from each micro-batch, which is computed once.

    ``outputs`` gives, for each folder, what to make of a batch; that may read other tables as they are by then.  A batch has a folder of its
    own, ``batch_id=<n>``, below each output; a batch that is run again after a failure replaces its folders, so its rows are there
    once.  ``partition_by`` names an output's partition columns.  Read the tables with ``read_batches``.
    """
    spark = df.sparkSession
    several = len(outputs) > 1

    def write(batch: DataFrame, n: int) -> None:
        if several:
            batch.persist()
        try:
            for path, make in outputs.items():
                make(batch).write.mode("overwrite").partitionBy(*(partition_by or {}).get(path, ())).parquet(f"{path.rstrip('/')}/batch_id={n}")
        finally:
            if several:
                batch.unpersist()

    for path in outputs:
        make_folder(spark, path)  # a table without a batch is an empty one
    return _start_owned(spark, list(outputs), options, df.writeStream.foreachBatch(write))


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table that ``write_batches`` keeps under ``path``, as it is now."""
    return spark.read.schema(schema).parquet(path).drop("batch_id")
