"""Report aggregates over the signal table.

Every aggregate here is algebraic, so Spark plans it as a partial
(map-side) aggregate, one shuffle of partial rows, and a final aggregate:
a hot day or hour costs one partial row per input partition, not a hot task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalspark.functions.columns import col_
from signalspark.functions.indicator import generation_indicator
from signalspark.functions.maps import signal_value
from signalspark.operators.mapping import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, fits
from signalspark.schemas import (
    BAND_LABELS,
    BAND_THRESHOLDS,
    SIGNAL_KEYS,
    TRUNC_AVERAGE_NAMES,
    WINDOW_AVERAGE_NAMES,
)


#: Chosen days: a list (``between`` makes one of a first and a last day), or a table with a column of days.
Days = Sequence[dt.date] | DataFrame


def between(first: dt.date, last: dt.date) -> list[dt.date]:
    """All days from ``first`` to ``last``."""
    return [first + dt.timedelta(n) for n in range((last - first).days + 1)]


def select_days(df: DataFrame, days: Days, date_col: str = "signal_date") -> DataFrame:
    """The rows of the chosen days; NULL days are never chosen.

    On a table partitioned by day only those days' folders are read: a list becomes a partition filter, a table of days (its
    ``date_col``, repeats allowed) is joined, and prunes the folders when the query runs if it is small enough to be broadcast (checked).
    """
    if not isinstance(days, DataFrame):
        return df.where(col_(date_col).isin(list(days)))
    # The comparison is true for every day; Spark prunes by a joined table only if that is filtered.
    wanted = days.select(col_(date_col).cast("date").alias("__day")).where(F.col("__day") >= F.lit("0001-01-01").cast("date")).distinct()
    wanted = F.broadcast(wanted) if fits(wanted, BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES) else wanted.hint("merge")
    return df.join(wanted, col_(date_col) == F.col("__day"), "left_semi")


def datapoints_per_day(
    df: DataFrame,
    by: str = "date",
    ts_col: str = "signal_ts",
    date_col: str = "signal_date",
    out: str = "datapoints_per_day",
) -> DataFrame:
    """``count(DISTINCT signal_ts)`` per day.

    ``by='date'`` groups on the stored ``signal_date``; ``by='trunc'`` on
    ``date_trunc('day', signal_ts) AS date``.  NULL timestamps are not
    counted; a NULL day is its own group.

    Spark plans a single distinct aggregate in two steps: de-duplicate on
    (day, ts), shuffled on both keys, then count per day from partial counts.
    The first shuffle spreads a hot day over all tasks.
    """
    if by == "date":
        group: Column = col_(date_col)
    elif by == "trunc":
        group = F.date_trunc("day", col_(ts_col)).alias("date")
    else:
        raise ValueError("by must be 'date' or 'trunc'")
    return df.groupBy(group).agg(F.count_distinct(col_(ts_col)).alias(out))


def _value(key: str, map_col: str | None, cast: bool) -> Column:
    if map_col is None:
        c = col_(key)
        return c.try_cast("double") if cast else c
    return signal_value(key, map_col, cast)


def hourly_averages(
    df: DataFrame,
    bucket: str = "trunc",
    keys: Sequence[str] = SIGNAL_KEYS,
    names: Mapping[str, str] | None = None,
    map_col: str | None = "signals",
    ts_col: str = "signal_ts",
    cast: bool = False,
    width: str = "1 hour",
    unit: str = "hour",
    out_col: str | None = None,
) -> DataFrame:
    """Average of each signal per hour.

    ``bucket='trunc'``: ``date_trunc(unit, ts) AS signal_hour`` (a NULL
    timestamp forms its own group).  ``bucket='window'``: tumbling
    ``window(ts, width) AS hour``, a ``[start, end)`` struct (NULL
    timestamps are dropped).  ``map_col=None`` reads wide typed columns
    instead of map entries, which lets the scan prune to the needed signals.
    ``cast=True`` reads text values with ``try_cast`` (bad text gives NULL).
    """
    if names is None:
        names = TRUNC_AVERAGE_NAMES if bucket == "trunc" else WINDOW_AVERAGE_NAMES
    aggs = [F.avg(_value(k, map_col, cast)).alias(names.get(k, k)) for k in keys]
    if bucket == "trunc":
        group = F.date_trunc(unit, col_(ts_col)).alias(out_col or "signal_hour")
    elif bucket == "window":
        group = F.window(col_(ts_col), width).alias(out_col or "hour")
    else:
        raise ValueError("bucket must be 'trunc' or 'window'")
    return df.groupBy(group).agg(*aggs)


def add_indicator(
    df: DataFrame,
    source: Column | str,
    out: str = "generation_indicator",
    thresholds: Sequence[float] = BAND_THRESHOLDS,
    labels: Sequence[str] = BAND_LABELS,
) -> DataFrame:
    """Append the four-level band of ``source`` (a column name or expression)."""
    src = col_(source) if isinstance(source, str) else source
    return df.withColumn(out, generation_indicator(src, thresholds, labels))
