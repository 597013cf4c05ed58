"""Turbine-shaped readings derived from the ``events`` test table.

The test data holds no turbine file, so the jobs run over readings that
Spark derives from ``events`` row by row (no shuffle):

* ``Date/Time``: ``ts`` as ``dd MM yyyy HH:mm`` text (minute precision);
* ``LV ActivePower (kW)``: ``floor(value * 10 + 0.5)``, NULL for ``error`` events;
* ``Wind Speed (m/s)``: ``k`` read from the ``props`` JSON text (NULL if absent or not a number);
* ``Theoretical_Power_Curve (KWh)``: ``user_id``;
* ``Wind Direction (°)``: ``event_id % 360``.

All values are whole numbers held as DOUBLE, so sums (and hence averages)
are exact whatever order a cluster adds them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from signalspark.functions.columns import quote
from signalspark.operators.signals import normalize_signals
from signalspark.schemas import (
    DATE_TIME,
    DATE_TIME_PATTERN,
    POWER,
    THEORETICAL_POWER,
    WIND_DIRECTION,
    WIND_SPEED,
)

# Each derived signal as a SQL expression over ``events``.  The derivation
# is written as one ``selectExpr`` projection: the JVM parses it in a single
# call, instead of one driver round trip per column expression.
SIGNAL_SQL = {
    POWER: "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value * 10 + 0.5) AS DOUBLE) END",
    # One field of a small document: a path lookup is cheaper than a
    # schema-driven decode of the whole object.
    WIND_SPEED: "try_cast(get_json_object(props, '$.k') AS DOUBLE)",
    THEORETICAL_POWER: "CAST(user_id AS DOUBLE)",
    WIND_DIRECTION: "CAST(event_id % 360 AS DOUBLE)",
}

_MINUTE_TS = "CAST(date_trunc('minute', ts) AS TIMESTAMP)"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def turbine_readings(events: DataFrame) -> DataFrame:
    """Readings as the CSV files hold them: ``Date/Time`` text and four DOUBLEs."""
    values = [f"{sql} AS {quote(k)}" for k, sql in SIGNAL_SQL.items()]
    return events.selectExpr(f"date_format(ts, {_sql_text(DATE_TIME_PATTERN)}) AS {quote(DATE_TIME)}", *values)


def signal_frame(readings: DataFrame, with_load_time: bool = False) -> DataFrame:
    """The stored signal table from readings, by the ingest's own normalisation."""
    return normalize_signals(readings, key_col=DATE_TIME, with_load_time=with_load_time)


def signal_table(events: DataFrame) -> DataFrame:
    """The stored signal table as ingest leaves it, derived in one projection.

    Equal to ``signal_frame(turbine_readings(events))`` (the key text holds
    minutes, so the parsed timestamp is ``ts`` truncated to the minute) but
    without formatting and parsing text per row: this is what the reports
    read, as they would read the already ingested table.
    """
    entries = ", ".join(f"{_sql_text(k)}, {sql}" for k, sql in SIGNAL_SQL.items())
    return events.selectExpr(
        f"to_date({_MINUTE_TS}) AS signal_date", f"{_MINUTE_TS} AS signal_ts", f"map({entries}) AS signals"
    )


def signal_columns(events: DataFrame) -> DataFrame:
    """The rows of ``signal_table`` with a column for each signal: no map is built for what is averaged at once."""
    values = [f"{sql} AS {quote(k)}" for k, sql in SIGNAL_SQL.items()]
    return events.selectExpr(f"to_date({_MINUTE_TS}) AS signal_date", f"{_MINUTE_TS} AS signal_ts", *values)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> str:
    """Write ``df`` as CSV files (one per partition) for the file streams to pick up."""
    df.write.mode("errorifexists").option("header", header).option("sep", sep).csv(path)
    return path
