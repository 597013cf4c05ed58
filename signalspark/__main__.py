"""Command line: run one job, as the original programs each ran one ``main``.

    python -m signalspark produce  --csv 'in/T1*.csv' --topic turbine --checkpoints ck --topic-path topic
    python -m signalspark ingest   --topic turbine --table table --checkpoints ck --topic-path topic
    python -m signalspark echo     --topic turbine --checkpoints ck --topic-path topic [--narrow]
    python -m signalspark report   --table table [--show 20]
    python -m signalspark pipeline --csv in --work work
    python -m signalspark together --csv in --work work [--drain] [--timeout 60]
    python -m signalspark hourly   --topic turbine --table hours --checkpoints ck --topic-path topic

Streams run until stopped unless ``--available-now`` is given (then they
process what is there and end).  ``--kafka host:port`` switches the topic
to Spark's Kafka connector; ``--format delta`` the table to Delta.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from signalspark.plans.jobs import FILES_PER_TRIGGER, PAYLOADS, echo_job, ingest_job, produce_job, report_job, run_pipeline
from signalspark.plans.live import LATENESS, hourly_job, run_together
from signalspark.schemas import NARROW_SCHEMA
from signalspark.session import build_session
from signalspark.streaming.runner import run_stream


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m signalspark")
    p.add_argument("--master", default=None, help="left to spark-submit when absent")
    p.add_argument("--format", default="parquet", choices=["parquet", "delta"], help="signal table format")
    sub = p.add_subparsers(dest="job", required=True)

    def topic_args(sp: argparse.ArgumentParser) -> None:
        sp.add_argument("--topic", required=True)
        sp.add_argument("--checkpoints", required=True, help="root folder; each query gets its own sub-folder")
        sp.add_argument("--topic-path", help="folder of the file back end")
        sp.add_argument("--kafka", help="bootstrap servers; selects the Kafka back end")
        sp.add_argument("--trigger", help="processing-time interval, e.g. '1 second'")
        sp.add_argument("--available-now", action="store_true")

    sp = sub.add_parser("produce", help="CSV file stream -> topic")
    sp.add_argument("--csv", required=True, help="folder or glob of CSV files")
    sp.add_argument("--payload", default="json", choices=PAYLOADS)
    sp.add_argument("--no-header", action="store_true")
    sp.add_argument("--sep", default=",")
    sp.add_argument("--max-files-per-trigger", type=int, default=FILES_PER_TRIGGER)
    topic_args(sp)

    sp = sub.add_parser("ingest", help="topic -> signal table")
    sp.add_argument("--table", required=True)
    sp.add_argument("--payload", default="json", choices=PAYLOADS)
    sp.add_argument("--max-offsets-per-trigger", type=int)
    sp.add_argument("--starting", default="earliest", help="start position; other than earliest with Kafka only")
    topic_args(sp)

    sp = sub.add_parser("echo", help="topic -> console")
    sp.add_argument("--narrow", action="store_true", help="decode the four signals only")
    sp.add_argument("--starting", default="earliest", help="start position; other than earliest with Kafka only")
    topic_args(sp)

    sp = sub.add_parser("report", help="batch reports over the signal table")
    sp.add_argument("--table", required=True)
    sp.add_argument("--show", type=int, default=20)
    sp.add_argument("--days", nargs="+", type=dt.date.fromisoformat, help="days to report, e.g. 2018-01-31; only their folders are read")

    sp = sub.add_parser("together", help="producer, ingest and echo at once")
    sp.add_argument("--csv", required=True)
    sp.add_argument("--work", required=True)
    sp.add_argument("--payload", default="json", choices=PAYLOADS)
    sp.add_argument("--trigger", default="1 second")
    sp.add_argument("--drain", action="store_true", help="end when all three have seen every row")
    sp.add_argument("--timeout", type=float, help="seconds")

    sp = sub.add_parser("hourly", help="topic -> hourly averages, appended as hours close")
    sp.add_argument("--table", required=True)
    sp.add_argument("--lateness", default=LATENESS)
    topic_args(sp)

    sp = sub.add_parser("pipeline", help="produce then ingest everything (availableNow), then report")
    sp.add_argument("--csv", required=True)
    sp.add_argument("--work", required=True)
    sp.add_argument("--payload", default="json", choices=PAYLOADS)
    sp.add_argument("--show", type=int, default=20)
    return p


def _backend(args: argparse.Namespace) -> dict:
    return {
        "backend": "kafka" if args.kafka else "file",
        "bootstrap_servers": args.kafka,
        "topic_path": args.topic_path,
        "processing_time": args.trigger,
        "available_now": args.available_now,
    }


def _show(reports: dict, rows: int) -> None:
    for name, df in reports.items():
        print(f"== {name}")
        df.show(rows, truncate=False)


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master, table_format=args.format)
    if args.job == "produce":
        q = produce_job(
            spark,
            args.csv,
            args.topic,
            args.checkpoints,
            payload=args.payload,
            header=not args.no_header,
            sep=args.sep,
            max_files_per_trigger=args.max_files_per_trigger,
            **_backend(args),
        )
        run_stream(q)
    elif args.job == "ingest":
        q = ingest_job(
            spark,
            args.topic,
            args.table,
            args.checkpoints,
            payload=args.payload,
            table_format=args.format,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
            starting=args.starting,
            **_backend(args),
        )
        run_stream(q)
    elif args.job == "echo":
        run_stream(echo_job(spark, args.topic, args.checkpoints, schema=NARROW_SCHEMA if args.narrow else None, starting=args.starting, **_backend(args)))
    elif args.job == "report":
        _show(report_job(spark, args.table, args.format, days=args.days), args.show)
    elif args.job == "together":
        run_together(
            spark, args.csv, args.work, payload=args.payload, table_format=args.format, processing_time=args.trigger, drain=args.drain, timeout=args.timeout
        )
    elif args.job == "hourly":
        run_stream(hourly_job(spark, args.topic, args.table, args.checkpoints, lateness=args.lateness, **_backend(args)))
    elif args.job == "pipeline":
        table = run_pipeline(spark, args.csv, args.work, payload=args.payload, table_format=args.format)
        _show(report_job(spark, table, args.format), args.show)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
