"""Column expressions: codecs, timestamp parsing, banding, map lookups."""

from signalspark.functions.codecs import (
    as_text,
    decode_json,
    encode_concat,
    encode_json,
    encode_nested,
)
from signalspark.functions.columns import col_
from signalspark.functions.indicator import generation_indicator
from signalspark.functions.maps import signal_value
from signalspark.functions.timeparse import parse_signal_ts

__all__ = [
    "as_text",
    "col_",
    "decode_json",
    "encode_concat",
    "encode_json",
    "encode_nested",
    "generation_indicator",
    "parse_signal_ts",
    "signal_value",
]
