"""Four-level banding of a reading or of an average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalspark.schemas import BAND_LABELS, BAND_THRESHOLDS


def generation_indicator(
    col: Column | str,
    thresholds: Sequence[float] = BAND_THRESHOLDS,
    labels: Sequence[str] = BAND_LABELS,
) -> Column:
    """``CASE WHEN c < t0 THEN l0 WHEN c < t1 THEN l1 ... ELSE last END``.

    A NULL input matches no comparison and so falls to the last label.
    """
    if len(labels) != len(thresholds) + 1:
        raise ValueError("need exactly one more label than thresholds")
    if list(thresholds) != sorted(thresholds):
        raise ValueError("thresholds must be ascending")
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c < F.lit(thresholds[0]), F.lit(labels[0]))
    for t, label in zip(thresholds[1:], labels[1:-1]):
        expr = expr.when(c < F.lit(t), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))
