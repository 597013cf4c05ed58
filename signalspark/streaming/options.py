"""Trigger, output mode and checkpoint of one streaming query."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from signalspark.names import safe_name


@dataclass(frozen=True)
class StreamOptions:
    """How one query runs.

    ``checkpoint`` is required (a sink without one cannot restart where it
    stopped).  Use ``child()`` to give every query of a job its own folder:
    two queries on one checkpoint break each other.
    ``processing_time`` is an interval such as ``'1 second'``;
    ``available_now`` processes what is there (in rate-limited batches) and
    stops; with neither, batches run as soon as the previous one ends.
    """

    checkpoint: str
    processing_time: str | None = None
    available_now: bool = False
    output_mode: str = "append"
    query_name: str | None = None

    def __post_init__(self) -> None:
        if self.processing_time and self.available_now:
            raise ValueError("choose either processing_time or available_now, not both")
        if not self.checkpoint:
            raise ValueError("a streaming query needs a checkpoint folder")

    def child(self, name: str) -> StreamOptions:
        """The folder of one query; different names give different folders."""
        return replace(self, checkpoint=f"{self.checkpoint.rstrip('/')}/{safe_name(name)}")

    def configure(self, writer: DataStreamWriter) -> DataStreamWriter:
        writer = writer.outputMode(self.output_mode).option("checkpointLocation", self.checkpoint)
        if self.query_name:
            writer = writer.queryName(self.query_name)
        if self.available_now:
            writer = writer.trigger(availableNow=True)
        elif self.processing_time:
            writer = writer.trigger(processingTime=self.processing_time)
        return writer

    def start(self, writer: DataStreamWriter, path: str | None = None) -> StreamingQuery:
        writer = self.configure(writer)
        return writer.start(path) if path else writer.start()
