"""Structured Streaming sinks, trigger/checkpoint options and query runners."""

from signalspark.streaming.options import StreamOptions
from signalspark.streaming.runner import Part, run_parts, run_stream, run_streams
from signalspark.streaming.sinks import append_signals, echo_stream, read_batches, write_batches, write_topic

__all__ = ["Part", "StreamOptions", "append_signals", "echo_stream", "read_batches", "run_parts", "run_stream", "run_streams", "write_batches", "write_topic"]
