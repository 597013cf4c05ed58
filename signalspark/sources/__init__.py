"""Sources: CSV and line file streams, the message log, the signal table, mappings."""

from signalspark.sources.files import csv_stream, line_stream, read_signals, read_table
from signalspark.sources.mapping import mapping_from_json, mapping_from_rows, mapping_pairs
from signalspark.sources.topic import kafka_sink_options, kafka_source_options, topic_stream

__all__ = [
    "csv_stream",
    "kafka_sink_options",
    "kafka_source_options",
    "line_stream",
    "mapping_from_json",
    "mapping_from_rows",
    "mapping_pairs",
    "read_signals",
    "read_table",
    "topic_stream",
]
