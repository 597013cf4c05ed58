"""Reading timestamps out of message keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalspark.schemas import DATE_TIME_PATTERN


def parse_signal_ts(col: Column | str, pattern: str = DATE_TIME_PATTERN) -> Column:
    """Text to TIMESTAMP with ``pattern``; text that does not parse gives NULL.

    ``try_to_timestamp`` keeps the lenient NULL result under ANSI mode, where
    plain ``to_timestamp`` would fail the whole job on one bad key.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(pattern))
