"""Spreading CPU-heavy row work over all task slots."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Deal the rows round robin into ``partitions``: an explicit shuffle, asked for by the caller.

    Worth it only before heavy row work on a source that Spark reads in fewer tasks than there are slots, such as one small
    file with one row group.  Nothing is looked at while the plan is made, so no job runs then.
    """
    return df.repartition(partitions)
