"""Streams that share folders, late files, rewritten tables: every row is counted, or an error is raised."""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import types as T

from signalspark.functions.codecs import decode_json, encode_json
from signalspark.plans.jobs import echo_job, ingest_job, produce_job, report_job, run_pipeline
from signalspark.schemas import NARROW_SCHEMA, POWER
from signalspark.sources import csv_stream, read_signals, read_table
from signalspark.streaming import StreamOptions, echo_stream, run_stream, run_streams
from tests.fixtures import EDGE_CSV
from tests.test_streaming import write_text


@pytest.fixture()
def topics(spark, work):
    """Topics a and a/b on one path: five messages and one."""
    header, first, *_ = EDGE_CSV.splitlines()
    write_text(Path(work, "one"), "T1.csv", EDGE_CSV)
    write_text(Path(work, "two"), "T1.csv", f"{header}\n{first}\n")
    for folder, topic in (("one", "a"), ("two", "a/b")):
        run_stream(produce_job(spark, f"{work}/{folder}", topic, f"{work}/ck", f"{work}/topics", available_now=True))
    return work


def ingest(spark, work, topic, table, **more):
    run_stream(ingest_job(spark, topic, f"{work}/{table}", f"{work}/ck", f"{work}/topics", available_now=True, **more))
    return spark.read.parquet(f"{work}/{table}").count()


def test_two_topics_two_tables_one_root(spark, topics):
    assert ingest(spark, topics, "a", "t1") == 5
    assert ingest(spark, topics, "a", "t2") == 5  # the same topic into another table
    assert ingest(spark, topics, "a/b", "t3") == 1
    assert ingest(spark, topics, ["a", "a/b"], "t4") == 6
    assert ingest(spark, topics, ["a", "a/b"], "t4") == 6  # a restart adds nothing
    with pytest.raises(ValueError, match="is the sink of the query"):
        ingest(spark, topics, "a/b", "t1")


def test_text_echo_then_narrow_echo(spark, topics):
    for name, schema in (("text", None), ("narrow", NARROW_SCHEMA)):
        run_stream(echo_job(spark, "a", f"{topics}/ck", f"{topics}/topics", schema=schema, sink="parquet", path=f"{topics}/{name}", available_now=True))
    text = spark.read.parquet(f"{topics}/text")
    assert text.columns == ["key", "value"] and text.count() == 5
    assert spark.read.parquet(f"{topics}/narrow").count() == 5


def test_late_files_are_read(spark, work):
    write_text(Path(work, "in"), "T1.csv", EDGE_CSV)
    opts = StreamOptions(f"{work}/ck", available_now=True).child("late")
    for count in (5, 10):
        run_stream(echo_stream(csv_stream(spark, f"{work}/in"), opts, sink="parquet", path=f"{work}/out"))
        assert spark.read.parquet(f"{work}/out").count() == count
        write_text(Path(work, "in"), "old.csv", EDGE_CSV)
        old = time.time() - 40 * 86400
        os.utime(f"{work}/in/old.csv", (old, old))


def test_a_rewritten_table_shows_its_columns(spark, work):
    for ddl, row in (("a INT", (1,)), ("a INT, b STRING", (1, "x")), ("c INT", (7,))):
        spark.createDataFrame([row], ddl).write.mode("overwrite").parquet(f"{work}/t")
        df = read_table(spark, f"{work}/t")
        assert (df.columns, tuple(df.first())) == ([c.split()[0] for c in ddl.split(", ")], row)


def test_a_stream_of_plain_names_keeps_its_values(spark, work):
    schema = T.StructType([T.StructField("when", T.StringType()), T.StructField("power", T.DoubleType()), T.StructField("speed", T.DoubleType())])
    write_text(Path(work, "in"), "T1.csv", "when,power,speed\n01 01 2018 00:00,10,2\n01 01 2018 00:30,30,\n")
    run_stream(produce_job(spark, f"{work}/in", "p", f"{work}/ck", f"{work}/topics", schema=schema, key_col="when", available_now=True))
    assert ingest(spark, work, "p", "t", schema=schema) == 2
    reports = report_job(spark, f"{work}/t", keys=("power", "speed"))
    assert "indicator_per_hour" not in reports
    row = reports["hourly_trunc"].first()
    assert (row["power"], row["speed"]) == (20.0, 2.0)


def test_report_on_one_signal_and_refused_partitions(spark, topics):
    assert ingest(spark, topics, "a", "t") == 5
    assert report_job(spark, f"{topics}/t", keys=("Wind Speed (m/s)",))["hourly_trunc"].columns[1:] == ["avg_Wind_Speed"]
    assert POWER not in report_job(spark, f"{topics}/t")["hourly_trunc"].columns
    with pytest.raises(ValueError, match="folder for each minute"):
        ingest(spark, topics, "a", "s", signal_date_type="string", partition_by=["signal_date"])


def test_files_for_each_day_are_bounded(spark, work):
    lines = [f"{d:02} 01 2018 {m // 60:02}:{m % 60:02},1,1,1,1" for d in (1, 2, 3) for m in range(400)]
    for k in range(8):
        write_text(Path(work, "in"), f"T{k}.csv", EDGE_CSV.splitlines()[0] + "\n" + "\n".join(lines[k::8]) + "\n")
    run_stream(produce_job(spark, f"{work}/in", "a", f"{work}/ck", f"{work}/topics", available_now=True))
    # Batches this small would be put into one task again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert ingest(spark, work, "a", "t", files_per_partition=3) == 1200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for day in (1, 2, 3):
        files = [f for f in os.listdir(f"{work}/t/signal_date=2018-01-{day:02}") if f.endswith(".parquet")]
        assert 1 < len(files) <= 3


def test_a_later_failure_is_raised_at_once(spark, work):
    write_text(Path(work, "in"), "a.txt", "x\n")
    endless = echo_stream(spark.readStream.format("rate").load(), StreamOptions(f"{work}/ck1", query_name="endless2"), sink="memory")
    bad = spark.readStream.text(f"{work}/in").selectExpr("raise_error(value) AS value")
    failing = echo_stream(bad, StreamOptions(f"{work}/ck2", available_now=True, query_name="failing"), sink="memory")
    with pytest.raises(Exception, match="x"):
        run_streams(spark, [endless, failing], timeout=120)
    assert not endless.isActive


def test_json_keeps_microseconds(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:07.179575' AS a, TIMESTAMP_NTZ '2024-01-02 03:04:07.000001' AS b")
    assert decode_json(encode_json(df), df.schema, keep=()).first() == df.first()
    plain = spark.sql("""SELECT '{"a":"2024-01-02T03:04:07Z","b":"2024-01-02T03:04:07"}' AS value""")
    assert all(decode_json(plain, df.schema, keep=()).first())


def test_a_fresh_checkpoint_on_an_old_table_is_refused(spark, work):
    write_text(Path(work, "in"), "a.csv", EDGE_CSV)
    run_pipeline(spark, f"{work}/in", f"{work}/w")
    os.rename(f"{work}/w/checkpoints", f"{work}/w/moved")
    write_text(Path(work, "in"), "b.csv", EDGE_CSV)
    with pytest.raises(ValueError, match="fresh one"):
        run_pipeline(spark, f"{work}/in", f"{work}/w")
    os.rename(f"{work}/w/checkpoints", f"{work}/w/unused") if os.path.exists(f"{work}/w/checkpoints") else None
    os.rename(f"{work}/w/moved", f"{work}/w/checkpoints")
    assert read_signals(spark, run_pipeline(spark, f"{work}/in", f"{work}/w")).count() == 10


def test_one_checkpoint_by_any_path_and_a_half_written_name(spark, work, monkeypatch):
    write_text(Path(work, "in"), "a.csv", EDGE_CSV)
    relative = os.path.relpath(f"{work}/ck", os.getcwd())
    for k, checkpoint in enumerate((f"{work}/ck", f"file:{work}/ck", relative, f"{work}/ck")):
        if k == 3:  # the program ended between making the file and writing into it
            Path(work, "out/_owner").write_text("")
            Path(work, "out/._owner.crc").unlink(missing_ok=True)
        run_stream(echo_stream(csv_stream(spark, f"{work}/in"), StreamOptions(checkpoint, available_now=True), sink="parquet", path=f"{work}/out"))
        assert spark.read.parquet(f"{work}/out").count() == 5 * (k + 1)
        assert Path(work, "out/_owner").read_text() == json.loads(Path(work, "ck/metadata").read_text())["id"]
        write_text(Path(work, "in"), f"b{k}.csv", EDGE_CSV)
    # Without a readable name, a checkpoint that is behind the folder can't be its own.
    Path(work, "out/_owner").unlink()
    for checkpoint in ("ck-new", "ck-short"):
        if checkpoint == "ck-short":
            run_stream(echo_stream(csv_stream(spark, f"{work}/in"), StreamOptions(f"{work}/{checkpoint}", available_now=True), sink="parquet", path=f"{work}/elsewhere"))
        with pytest.raises(ValueError, match="batches of another query"):
            echo_stream(csv_stream(spark, f"{work}/in"), StreamOptions(f"{work}/{checkpoint}", available_now=True), sink="parquet", path=f"{work}/out")


def test_archived_files_are_read_once_and_late_ones_too(spark, work):
    def rows():
        stream = csv_stream(spark, f"{work}/in", max_file_age="400d", archive_dir=f"{work}/archive")
        run_stream(echo_stream(stream, StreamOptions(f"{work}/ck", available_now=True), sink="parquet", path=f"{work}/out"))
        return spark.read.parquet(f"{work}/out").count()

    for k in range(3):
        write_text(Path(work, "in"), f"T{k}.csv", EDGE_CSV)
        late = time.time() - 40 * k * 86400
        os.utime(f"{work}/in/T{k}.csv", (late, late))
        assert rows() == 5 * (k + 1)
    # A batch's files are moved when a later one is planned.
    assert {f.name for f in Path(work, "archive").rglob("*.csv")} >= {"T0.csv", "T1.csv"}
    assert {f.name for f in Path(work, "in").glob("*.csv")} <= {"T2.csv"}
    assert rows() == 15
