"""File-backed streams and the stored signal table."""

from __future__ import annotations

import json
import os
import re
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from signalspark.schemas import SIGNAL_TABLE_SCHEMA, TURBINE_SCHEMA


#: Files older than this against the newest are skipped by a file stream.  Spark's default of 7 days drops backfills and copies
#: that keep their times.  The price is that a query remembers the names of all files it has read; ``archive_dir`` with a lower age bounds that.
MAX_FILE_AGE = "36500d"


def _file_reader(spark: SparkSession, max_files_per_trigger: int | None, max_file_age: str, archive_dir: str | None) -> DataStreamReader:
    """Options that all file streams share.

    With ``archive_dir``, files that a committed batch has read are moved there (outside the watched path, same store).  The driver then remembers only
    names younger than ``max_file_age``; a file that comes later than that is skipped, so choose an age that no late file reaches.
    """
    reader = spark.readStream.option("maxFileAge", max_file_age)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader


def _check_stream_path(path: str) -> None:
    """A file stream watches a directory or a glob; a single file fails late.

    Only local paths can be checked without a round trip to the store.
    """
    parsed = urlparse(path)
    if parsed.scheme in ("", "file") and os.path.isfile(parsed.path or path):
        raise ValueError(
            f"{path!r} is a file; a file stream needs a directory or a glob such as 'dir/T1*.csv'"
        )


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = TURBINE_SCHEMA,
    header: bool = True,
    sep: str = ",",
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    archive_dir: str | None = None,
    **options: str,
) -> DataFrame:
    """Stream CSV files under a fixed schema (columns bind by position).

    ``header=False`` makes a header line an ordinary row (its numbers NULL);
    a wrong ``sep`` puts the whole line into the first column.  A cell that
    is not a number gives NULL, never an error.  ``archive_dir``: see ``_file_reader``.
    """
    _check_stream_path(path)
    reader = _file_reader(spark, max_files_per_trigger, max_file_age, archive_dir).schema(schema).option("header", header).option("sep", sep)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def line_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None, max_file_age: str = MAX_FILE_AGE, archive_dir: str | None = None
) -> DataFrame:
    """Stream text lines from files: one ``value STRING`` column per line.  ``archive_dir``: see ``_file_reader``."""
    _check_stream_path(path)
    return _file_reader(spark, max_files_per_trigger, max_file_age, archive_dir).text(path)


def read_table(spark: SparkSession, path: str, table_format: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Batch read of a table folder or file; its schema is read from the files unless given."""
    reader = spark.read.format(table_format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def _hadoop(spark: SparkSession, path: str):
    """The path and its file system, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def make_folder(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.mkdirs(p)


def _read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none or it is empty (as a crash between creating and writing leaves it)."""
    p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip() or None
    finally:
        stream.close()


def query_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark keeps in a checkpoint folder; None before its query first started."""
    text = _read_text(spark, f"{checkpoint}/metadata")
    return json.loads(text)["id"] if text else None


_BATCH = re.compile(r"(?:batch_id=)?(\d+)(?:\.compact)?")


def _last_batch(spark: SparkSession, folder: str) -> int:
    """The largest batch number among the names in a folder; -1 if there is none."""
    p, fs = _hadoop(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return max((int(m[1]) for m in map(_BATCH.fullmatch, names) if m), default=-1)


def check_sink(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Raise unless the query of this checkpoint may write to ``path``.

    A sink numbers the batches of one query: those of a second query, or of the same one begun afresh, would count
    as committed already (or take the place of others), and their rows would be lost without an error.  The folder therefore names its
    query by the id in the query's checkpoint, whatever path leads there.  A folder with batches but without a readable name (the
    program ended between the first batch and ``claim_sink``) is taken only if the checkpoint has gone as far as the folder.
    """
    owner, own = _read_text(spark, f"{path}/_owner"), query_id(spark, checkpoint)
    if owner is not None:
        if own != owner:
            why = "another query's" if own else "a fresh one, whose first batches would count as written"
            raise ValueError(f"{path!r} is the sink of the query {owner}, and the checkpoint {checkpoint!r} is {why}: give the old checkpoint or a new folder")
        return
    written = max(_last_batch(spark, f"{path}/_spark_metadata"), _last_batch(spark, path))
    if written >= 0 and (own is None or _last_batch(spark, f"{checkpoint}/offsets") < written):
        raise ValueError(f"{path!r} has batches of another query")


def claim_sink(spark: SparkSession, path: str, owner_id: str) -> None:
    """Write the name of the query that has started into its sink folder; raise if another query was faster."""
    owner, fs = _hadoop(spark, f"{path}/_owner")
    held = _read_text(spark, f"{path}/_owner")
    if held is None:
        stream = fs.create(owner, bool(fs.exists(owner)))
        stream.writeBytes(owner_id)
        stream.close()
    elif held != owner_id:
        raise ValueError(f"{path!r} is the sink of the query {held}")


def read_signals(
    spark: SparkSession,
    path: str,
    table_format: str = "parquet",
    schema: T.StructType | None = SIGNAL_TABLE_SCHEMA,
) -> DataFrame:
    """Batch snapshot of the stored signal table.

    A folder written by a streaming file sink is read through its commit
    log, so files of an unfinished micro-batch are never seen.  The schema
    pins ``signal_date`` to DATE when it is also the partition column.
    """
    reader = spark.read.format(table_format)
    if schema is not None and table_format != "delta":
        reader = reader.schema(schema)
    return reader.load(path)
