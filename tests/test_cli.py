"""The command line runs the same jobs."""

from __future__ import annotations

from signalspark.__main__ import _parser, main
from signalspark.plans.jobs import FILES_PER_TRIGGER
from signalspark.sources import read_signals
from tests.fixtures import EDGE_CSV, write_text


def test_cli_jobs_one_by_one(spark, tmp_path, capsys):
    write_text(tmp_path / "csv", "T1.csv", EDGE_CSV)
    common = ["--topic", "turbine", "--checkpoints", str(tmp_path / "ck"), "--topic-path", str(tmp_path / "topic"), "--available-now"]
    assert main(["produce", "--csv", str(tmp_path / "csv"), *common]) == 0
    assert main(["ingest", "--table", str(tmp_path / "table"), *common]) == 0
    assert read_signals(spark, str(tmp_path / "table")).count() == 5
    assert main(["report", "--table", str(tmp_path / "table"), "--show", "3"]) == 0
    out = capsys.readouterr().out
    assert "== hourly_window" in out and "== signal_rename" in out


def test_cli_pipeline(spark, tmp_path, capsys):
    write_text(tmp_path / "csv", "T1.csv", EDGE_CSV)
    assert main(["pipeline", "--csv", str(tmp_path / "csv"), "--work", str(tmp_path / "w"), "--payload", "nested"]) == 0
    assert "wind_speed_average" in capsys.readouterr().out


def test_cli_together_and_hourly(spark, tmp_path, capsys):
    write_text(tmp_path / "csv", "T1.csv", EDGE_CSV)
    work = str(tmp_path / "w")
    assert main(["together", "--csv", str(tmp_path / "csv"), "--work", work, "--drain", "--timeout", "300"]) == 0
    assert read_signals(spark, f"{work}/table").count() == 5
    topic = ["--topic", "signals", "--checkpoints", f"{work}/checkpoints", "--topic-path", f"{work}/topic", "--available-now"]
    assert main(["hourly", "--table", f"{work}/hours", *topic]) == 0
    assert [r.average_LV_ActivePower for r in spark.read.parquet(f"{work}/hours").collect()] == [240.02]
    assert main(["report", "--table", f"{work}/table", "--days", "2018-12-31"]) == 0
    out = capsys.readouterr().out
    assert "2018-12-31" in out and "2018-01-01" not in out


def test_cli_defaults():
    topic = ["--topic", "t", "--checkpoints", "ck"]
    assert _parser().parse_args(["produce", "--csv", "in", *topic]).max_files_per_trigger == FILES_PER_TRIGGER
    assert _parser().parse_args(["ingest", "--table", "table", *topic]).starting == "earliest"
    assert _parser().parse_args(["echo", "--starting", "latest", *topic]).starting == "latest"
