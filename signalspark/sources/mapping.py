"""The small signal-name mapping, from a JSON document or from literal rows."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.functions.columns import col_
from signalspark.schemas import MAPPING_DDL, MAPPING_JSON, MAPPING_ROWS

#: Literal rows up to which the mapping is part of the plan itself (no scan, no job).
INLINE_ROWS = 1000
_BROKEN = "__broken"


def mapping_pairs(document: str = MAPPING_JSON) -> list[tuple[str, str]]:
    """The pairs of a JSON array of ``{sig_name, sig_mapping_name}``, duplicates kept."""
    return [(e.get("sig_name"), e.get("sig_mapping_name")) for e in json.loads(document)]


def mapping_from_json(spark: SparkSession, document: str = MAPPING_JSON, path: str | None = None) -> DataFrame:
    """One row per element of a JSON array of ``{sig_name, sig_mapping_name}``: the given text, or the documents under ``path``.

    Duplicates in the document are kept (see ``rename_by_mapping``).  Documents in a store are read by Spark (a whole document in a task, whatever
    its line feeds); one that doesn't parse, or holds other things than texts under these names, raises ValueError with its place.
    """
    if path is None:
        return mapping_from_rows(spark, mapping_pairs(document))
    reader = spark.read.schema(f"{MAPPING_DDL}, {_BROKEN} STRING").option("multiLine", True).option("columnNameOfCorruptRecord", _BROKEN)
    rows = reader.json(path)
    broken = rows.where(col_(_BROKEN).isNotNull()).select("_metadata.file_path", "sig_name", F.substring(_BROKEN, 1, 80).alias("start")).limit(5).collect()
    if broken:
        raise ValueError("mapping documents that don't parse: " + "; ".join(f"{r['file_path']} ({r['start']!r} ...)" for r in broken))
    return rows.drop(_BROKEN)


def mapping_from_rows(spark: SparkSession, rows: Iterable[tuple[str, str]] = MAPPING_ROWS) -> DataFrame:
    """The mapping from literal ``(sig_name, sig_mapping_name)`` pairs."""
    rows = list(rows)
    if not rows or len(rows) > INLINE_ROWS:
        return spark.createDataFrame(rows, MAPPING_DDL)
    values = ", ".join(f"(:k{i}, :v{i})" for i in range(len(rows)))
    args = {f"{c}{i}": v for i, pair in enumerate(rows) for c, v in zip("kv", pair, strict=True)}
    return spark.sql(f"SELECT CAST(k AS STRING) AS sig_name, CAST(v AS STRING) AS sig_mapping_name FROM VALUES {values} AS m(k, v)", args)
