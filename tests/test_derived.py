"""The test-table derivations agree with the jobs' own normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from signalspark.plans.derived import signal_frame, signal_table, turbine_readings
from signalspark.sources import read_table
from tests.conftest import SF_SMALL


def _rows(df):
    out = df.select(
        F.col("signal_date").cast("string"),
        F.date_format("signal_ts", "yyyy-MM-dd HH:mm:ss"),
        F.to_json(F.map_entries("signals")),
    )
    return sorted(tuple(r) for r in out.collect())


def test_signal_table_equals_normalised_readings(spark):
    events = read_table(spark, f"{SF_SMALL}/events.parquet")
    fast = signal_table(events)
    slow = signal_frame(turbine_readings(events))
    assert _rows(fast) == _rows(slow)
    assert fast.count() == events.count()


def test_readings_cover_all_bands_and_nulls(spark):
    from signalspark.functions import generation_indicator
    from signalspark.schemas import POWER

    readings = turbine_readings(read_table(spark, f"{SF_SMALL}/events.parquet"))
    bands = {r[0] for r in readings.select(generation_indicator(F.col(f"`{POWER}`"))).distinct().collect()}
    assert bands == {"Low", "Medium", "High", "Exceptional"}
    assert readings.where(F.col(f"`{POWER}`").isNull()).count() > 0
