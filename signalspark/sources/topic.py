"""The keyed message log ("topic").

Two back ends with one set of columns (Spark's Kafka source columns):

* ``kafka``: Spark's Kafka connector (its jar must be on the class path);
* ``file``: Parquet files written by a streaming file sink, one folder for
  each topic below the given path (a sink's commit log is per folder).  It is exactly-once through the sink's commit log, read from the earliest
  entry, keeps no order across files and writes no offsets (NULL).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.names import safe_name
from signalspark.schemas import TOPIC_SCHEMA
from signalspark.sources.files import MAX_FILE_AGE, make_folder

HEADERS_TYPE = "array<struct<key: string, value: binary>>"


def topic_folder(path: str, topic: str) -> str:
    """The folder of one topic of the file back end."""
    return f"{path.rstrip('/')}/{safe_name(topic)}"


def kafka_source_options(
    bootstrap_servers: str,
    topic: str,
    starting: str = "earliest",
    include_headers: bool = False,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format('kafka')``: subscribe to one topic.

    Decoding is done by ``CAST`` downstream, so no deserializer options.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if include_headers:
        opts["includeHeaders"] = "true"
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    return opts


def kafka_sink_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    """Options for ``writeStream.format('kafka')``."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def topic_stream(
    spark: SparkSession,
    topic: str,
    backend: str = "file",
    path: str | None = None,
    bootstrap_servers: str | None = None,
    starting: str = "earliest",
    include_headers: bool = False,
    max_offsets_per_trigger: int | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream the messages of ``topic``: ``key, value`` (BINARY) and metadata."""
    if backend == "kafka":
        if not bootstrap_servers:
            raise ValueError("the kafka back end needs bootstrap_servers")
        opts = kafka_source_options(bootstrap_servers, topic, starting, include_headers, max_offsets_per_trigger)
        return spark.readStream.format("kafka").options(**opts).load()
    if backend != "file":
        raise ValueError("backend must be 'file' or 'kafka'")
    if not path:
        raise ValueError("the file back end needs a path")
    if starting != "earliest":
        raise ValueError("the file back end always reads from the earliest message")
    if max_offsets_per_trigger:
        raise ValueError("the file back end has no offsets: limit it with max_files_per_trigger")
    folder = topic_folder(path, topic)
    make_folder(spark, folder)  # a consumer may start before the first message
    reader = spark.readStream.schema(TOPIC_SCHEMA).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    messages = reader.parquet(folder)
    if include_headers:
        # Same column as Kafka's source; the file log keeps no headers.
        messages = messages.withColumn("headers", F.lit(None).cast(HEADERS_TYPE))
    return messages
