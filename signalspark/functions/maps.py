"""Looking up one signal in a signals map."""

from __future__ import annotations

from pyspark.sql import Column

from signalspark.functions.columns import col_


def signal_value(name: str, map_col: str = "signals", cast: bool = False) -> Column:
    """``signals[name]``: NULL when the key is absent (also under ANSI).

    With ``cast=True`` the entry is read as DOUBLE with ``try_cast``, for maps
    of text values; text that is not a number gives NULL.
    """
    # Bracket lookup, not element_at: element_at raises on a missing key under ANSI.
    value = col_(map_col)[name]
    return value.try_cast("double") if cast else value
