"""Renaming signals through a small name mapping (an equi-join).

The mapping is broadcast only after its rows and bytes are checked against a
bound; a literal mapping (a list of pairs) is checked, and de-duplicated, on
the driver without a job.  Past the bound the join is a plain shuffle join:
signal names are few, so one name may be a third of all rows, and AQE's
skew-join split (on in ``build_session``) divides it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalspark.functions.columns import col_
from signalspark.sources.mapping import mapping_from_rows

BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 8 << 20
#: Joins that give the same rows however they are run; the mapping is the side that may be broadcast.
JOINS = ("left", "inner", "left_semi", "left_anti")

_KEY = "__mapping_key"


def fits(mapping: DataFrame, rows: int, size: int) -> bool:
    """Whether a mapping has at most so many rows and bytes of text (reads ``rows + 1`` rows at most)."""
    width = sum((F.coalesce(F.octet_length(col_(c).cast("string")), F.lit(0)) for c in mapping.columns), F.lit(0))
    got = mapping.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return got["n"] <= rows and (got["b"] or 0) <= size


def dedupe_pairs(pairs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """One pair for each key of a literal mapping; two names for one key raise."""
    names: dict[str, str] = {}
    for key, name in pairs:
        if names.setdefault(key, name) != name:
            raise ValueError(f"mapping gives more than one name for {key!r}")
    return list(names.items())


def dedupe_mapping(mapping: DataFrame, key: str = "sig_name", name: str = "sig_mapping_name") -> DataFrame:
    """One row per key: exact duplicate pairs collapse; two different names
    for one key fail the query that uses the mapping (checked lazily, inside
    that query, so no separate job runs)."""
    is_null = F.max(col_(name).isNull().cast("int"))
    grouped = mapping.groupBy(col_(key)).agg(
        F.max(col_(name)).alias(name), (F.count_distinct(col_(name)) + is_null).alias("__names")
    )
    clash = F.raise_error(F.lit(f"mapping gives more than one {name!r} for some {key!r}"))
    return grouped.select(
        col_(key), F.when(F.col("__names") > 1, clash).otherwise(col_(name)).cast("string").alias(name)
    )


def rename_by_mapping(
    df: DataFrame,
    mapping: DataFrame | Sequence[tuple[str, str]],
    key_col: str,
    mapping_key: str = "sig_name",
    name_col: str = "sig_mapping_name",
    how: str = "left",
    on_duplicate: str = "keep",
    replace: bool = False,
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """``df LEFT JOIN mapping ON df[key_col] = mapping[mapping_key]``.

    Adds ``name_col``; an unmatched row keeps a NULL name.  ``mapping`` is a table or literal ``(key, name)`` pairs.
    ``on_duplicate``: ``'keep'`` lets a repeated mapping key multiply the matching rows,
    ``'dedupe'`` removes exact duplicates first (conflicts raise).
    ``replace=True`` drops ``key_col`` and renames ``name_col`` to it.  ``how`` is one of ``JOINS``.
    """
    if how not in JOINS:
        raise ValueError(f"how must be one of {JOINS}")
    if on_duplicate not in ("keep", "dedupe"):
        raise ValueError("on_duplicate must be 'keep' or 'dedupe'")
    if name_col in df.columns:
        raise ValueError(f"{name_col!r} already is a column of the input")
    if isinstance(mapping, DataFrame):
        if on_duplicate == "dedupe":
            mapping = dedupe_mapping(mapping, mapping_key, name_col)
        right = mapping.select(col_(mapping_key).alias(_KEY), col_(name_col).alias(name_col))
        small = fits(right, broadcast_max_rows, broadcast_max_bytes)
    else:
        pairs = dedupe_pairs(list(mapping)) if on_duplicate == "dedupe" else list(mapping)
        right = mapping_from_rows(df.sparkSession, pairs).toDF(_KEY, name_col)
        small = len(pairs) <= broadcast_max_rows and sum(len(v.encode()) for p in pairs for v in p if v) <= broadcast_max_bytes
    right = F.broadcast(right) if small else right.hint("merge")
    joined = df.join(right, col_(key_col) == F.col(_KEY), how).drop(_KEY)
    if replace:
        joined = joined.drop(key_col).withColumnRenamed(name_col, key_col)
    return joined
