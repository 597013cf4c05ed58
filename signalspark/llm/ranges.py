"""Places of rows in a global order without a global window: sorted ranges, places within them, and what stands before each range."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from signalspark.llm.common import join_ids, stored

#: Rows of a range; small tables have up to ``FEW_RANGES`` ranges of ``FEW_ROWS`` rows, so that several tasks sort them.
RANGE_ROWS = 500_000
FEW_RANGES, FEW_ROWS = 16, 10_000


def _place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for b in batches:
        where = [pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(at, at + b.num_rows))]
        at += b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, *where], names=[*b.schema.names, "range_no", "range_place"])


def placed(df: DataFrame, order: Sequence[Column], name: str, group: str | None = None) -> DataFrame:
    """Rows of a stored table with ``place`` (from 0) in ``order`` within ``group`` (a column without nulls, and the first of the order).

    The rows are dealt to ranges of about ``RANGE_ROWS`` rows and sorted there.  Only a row for each range and group is
    summed up further, so a group that holds most rows is many tasks.  Rows that tie in ``order`` get consecutive
    places in any order.  With a group, ``group_rows`` is its number of rows.
    """
    rows = df.count()
    ranges = max(-(-rows // RANGE_ROWS), min(FEW_RANGES, -(-rows // FEW_ROWS)), 1)
    schema = StructType([*df.schema.fields, StructField("range_no", IntegerType()), StructField("range_place", LongType())])
    sorted_ = stored(df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).mapInArrow(_place, schema), name)
    keys = ["range_no", *([group] if group else [])]
    counts = sorted_.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("range_place").alias("first"))
    whole = Window.partitionBy(group) if group else Window.partitionBy()  # a row for each range
    before = F.coalesce(F.sum("n").over(whole.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*keys, (before - F.col("first")).alias("shift"), *([F.sum("n").over(whole).alias("group_rows")] if group else []))
    out = join_ids(sorted_, stored(starts, f"{name}-starts"), keys, "inner")
    extra = ["group_rows"] if group else []
    return out.select(*df.columns, (F.col("range_place") + F.col("shift")).alias("place"), *extra)
