"""Reshaping readings: wide columns <-> a keyed signals map <-> long rows.

All of these are narrow (row-local) projections: no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.functions.columns import col_
from signalspark.functions.timeparse import parse_signal_ts
from signalspark.schemas import DATE_TIME_PATTERN, SIGNAL_KEYS, SIGNAL_TABLE_COLUMNS


def pack_signals(
    df: DataFrame, keys: Sequence[str] = SIGNAL_KEYS, out: str = "signals"
) -> DataFrame:
    """Add ``out = map(k1, col(k1), k2, col(k2), ...)``.

    A NULL cell stays in the map as a key with a NULL value.
    """
    pairs = []
    for k in keys:
        pairs += [F.lit(k), col_(k)]
    return df.withColumn(out, F.create_map(*pairs))


def unpack_signals(
    df: DataFrame,
    map_col: str = "signals",
    keep: Sequence[str] | None = None,
    name_col: str = "sig_name",
    value_col: str = "sig_value",
    outer: bool = False,
) -> DataFrame:
    """One row per map entry: ``keep..., name_col, value_col``.

    With ``outer=True`` a row whose map is NULL or empty is kept once with
    NULL name and value; by default such a row has no signals, hence no rows.
    """
    keep = [c for c in df.columns if c != map_col] if keep is None else list(keep)
    explode = F.explode_outer if outer else F.explode
    return df.select(*[col_(c) for c in keep], explode(col_(map_col)).alias(name_col, value_col))


def unpivot_signals(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    name_col: str = "sig_name",
    value_col: str = "sig_value",
) -> DataFrame:
    """Wide typed columns to long rows (``stack``), the name being the column name.

    Used on already aggregated frames, where it is far cheaper than
    exploding a map per raw reading.
    """
    return df.unpivot([col_(c) for c in ids], [col_(c) for c in columns], name_col, value_col)


def normalize_signals(
    decoded: DataFrame,
    key_col: str = "key",
    keys: Sequence[str] = SIGNAL_KEYS,
    pattern: str = DATE_TIME_PATTERN,
    signal_date_type: str = "date",
    with_load_time: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decoded reading -> stored signal row.

    ``signal_ts`` is the key parsed with ``pattern`` (NULL when it does not
    parse); ``signal_date`` is the DATE of ``signal_ts`` (``'date'``, the
    declared type) or the key text itself (``'string'``).  ``create_date`` and
    ``create_ts`` are the load date and time, fixed within one micro-batch.
    ``keep`` names input columns to carry in front of the signal columns.
    """
    ts = parse_signal_ts(col_(key_col), pattern)
    if signal_date_type == "date":
        signal_date = F.to_date(ts)
    elif signal_date_type == "string":
        signal_date = col_(key_col).cast("string")
    else:
        raise ValueError("signal_date_type must be 'date' or 'string'")
    pairs = []
    for k in keys:
        pairs += [F.lit(k), col_(k)]
    cols = [col_(c) for c in keep]
    cols += [signal_date.alias("signal_date"), ts.alias("signal_ts"), F.create_map(*pairs).alias("signals")]
    if with_load_time:
        cols += [F.current_date().alias("create_date"), F.current_timestamp().alias("create_ts")]
    return decoded.select(*cols)


def normalize_nested(decoded: DataFrame, text_values: bool = False, with_load_time: bool = True) -> DataFrame:
    """Decoded nested payload (date, timestamp, text map) -> stored signal row.

    Map values arrive as text; they are read as DOUBLE with ``try_cast``
    (bad text gives NULL) unless ``text_values`` keeps the text map.
    """
    signals = col_("signals")
    if not text_values:
        signals = F.transform_values(signals, lambda _k, v: v.try_cast("double"))
    cols = [col_("signal_date"), col_("signal_ts"), signals.alias("signals")]
    if with_load_time:
        cols += [F.current_date().alias("create_date"), F.current_timestamp().alias("create_ts")]
    return decoded.select(*cols)


__all__ = [
    "SIGNAL_TABLE_COLUMNS",
    "normalize_nested",
    "normalize_signals",
    "pack_signals",
    "unpack_signals",
    "unpivot_signals",
]
