"""Message payloads: whole rows to text and back.

All encoders return ``key`` (optional) and ``value`` string columns, the
shape a keyed message log takes.  They stay inside whole-stage codegen
(``to_json``/``from_json``/``concat`` are JVM expressions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalspark.functions.columns import col_


#: Six fraction digits on both sides; messages without a fraction or zone are read too.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def _key(df: DataFrame, key_col: str | None) -> list[Column]:
    return [] if key_col is None else [col_(key_col).cast("string").alias("key")]


def encode_json(
    df: DataFrame, key_col: str | None = None, columns: Sequence[str] | None = None, options: dict[str, str] | None = None
) -> DataFrame:
    """``CAST(key AS STRING) AS key, to_json(struct(*)) AS value``.

    NULL fields are left out of the JSON object; timestamps keep their
    microseconds.  ``options`` go to ``to_json`` over ``JSON_TIMES``.
    """
    cols = list(columns or df.columns)
    value = F.to_json(F.struct(*[col_(c) for c in cols]), {**JSON_TIMES, **(options or {})}).alias("value")
    return df.select(*_key(df, key_col), value)


def encode_concat(
    df: DataFrame, key_col: str | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """``concat(*)``: all columns as text, no separator; any NULL gives NULL.

    A lossy payload kept for fidelity: it cannot be decoded as JSON.
    """
    cols = list(columns or df.columns)
    value = F.concat(*[col_(c).cast("string") for c in cols]).alias("value")
    return df.select(*_key(df, key_col), value)


def encode_nested(df: DataFrame, key_col: str | None = None) -> DataFrame:
    """JSON of an already normalised signal row (date, timestamp, map)."""
    return encode_json(df, key_col, ["signal_date", "signal_ts", "signals"])


def as_text(df: DataFrame, columns: Sequence[str] = ("key", "value")) -> DataFrame:
    """``CAST(key AS STRING), CAST(value AS STRING)`` on raw message columns."""
    present = [c for c in columns if c in df.columns]
    rest = [c for c in df.columns if c not in present]
    return df.select(*[col_(c).cast("string").alias(c) for c in present], *[col_(c) for c in rest])


def decode_json(
    df: DataFrame,
    schema: T.StructType | str,
    value_col: str = "value",
    keep: Sequence[str] = ("key",),
    expand: bool = True,
    alias: str = "data",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """``from_json(CAST(value AS STRING), schema)``, then ``data.*``.

    PERMISSIVE parsing: a malformed payload gives a row of NULL fields, never
    an error.  Fields not named in ``schema`` are ignored, so a narrow schema
    is also the cheapest decode.  ``schema`` may be a StructType or DDL text.
    """
    kept = [col_(c) for c in keep if c in df.columns]
    decoded = df.select(*kept, F.from_json(col_(value_col).cast("string"), schema, {**JSON_TIMES, **(options or {})}).alias(alias))
    if not expand:
        return decoded
    return decoded.select(*kept, f"{alias}.*")
