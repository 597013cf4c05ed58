"""DataFrame -> DataFrame operators; each works on batch and streaming frames where Spark allows."""

from signalspark.operators.analytics import add_indicator, datapoints_per_day, hourly_averages
from signalspark.operators.mapping import dedupe_mapping, dedupe_pairs, rename_by_mapping
from signalspark.operators.partitioning import spread_partitions
from signalspark.operators.signals import (
    normalize_nested,
    normalize_signals,
    pack_signals,
    unpack_signals,
    unpivot_signals,
)

__all__ = [
    "add_indicator",
    "dedupe_pairs",
    "datapoints_per_day",
    "dedupe_mapping",
    "hourly_averages",
    "normalize_nested",
    "normalize_signals",
    "pack_signals",
    "rename_by_mapping",
    "spread_partitions",
    "unpack_signals",
    "unpivot_signals",
]
