"""Schemas, signal keys and other fixed values shared by every job.

Everything between the two "fixed values" markers must equal the values of
the original wind-turbine programs for results to agree (column names, the
date pattern, band thresholds and labels, the signal-name mappings and the
output column names of the reports).  They are stated once, here, in plain
text and natural order; the rest of the package only refers to them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------- fixed values
DATE_TIME = "Date/Time"
POWER = "LV ActivePower (kW)"
WIND_SPEED = "Wind Speed (m/s)"
THEORETICAL_POWER = "Theoretical_Power_Curve (KWh)"
WIND_DIRECTION = "Wind Direction (°)"

DATE_TIME_PATTERN = "dd MM yyyy HH:mm"

BAND_THRESHOLDS = (200, 600, 1000)
BAND_LABELS = ("Low", "Medium", "High", "Exceptional")

# Output names of the hourly report that buckets with date_trunc.
TRUNC_AVERAGE_NAMES = {
    POWER: "avg_LV_ActivePower",
    WIND_SPEED: "avg_Wind_Speed",
    THEORETICAL_POWER: "avg_Theoretical_Power_Curve",
    WIND_DIRECTION: "avg_Wind_Direction",
}

# Output names of the hourly report that buckets with a tumbling window.
WINDOW_AVERAGE_NAMES = {
    POWER: "average_LV_ActivePower",
    WIND_SPEED: "average_Wind_Speed",
    THEORETICAL_POWER: "average_Theoretical_Power_Curve",
    WIND_DIRECTION: "average_Wind_Direction",
}

# Signal-name mapping as a JSON document (note the repeated entry).
MAPPING_JSON = """
[
  {"sig_name": "LV ActivePower (kW)", "sig_mapping_name": "active_power_average"},
  {"sig_name": "Wind Speed (m/s)", "sig_mapping_name": "wind_speed_average"},
  {"sig_name": "Theoretical_Power_Curve (KWh)", "sig_mapping_name": "theo_power_curve_average"},
  {"sig_name": "Theoretical_Power_Curve (KWh)", "sig_mapping_name": "theo_power_curve_average"},
  {"sig_name": "Wind Direction (°)", "sig_mapping_name": "wind_direction_average"}
]
"""

# Signal-name mapping as literal rows (note the leading blank and the missing unit).
MAPPING_ROWS = (
    ("LV ActivePower (kW)", "active_power_average"),
    ("Wind Speed (m/s)", "wind_speed_average"),
    ("Theoretical_Power_Curve (KWh)", "theo_power_curve_avg"),
    (" Wind Direction", "wind_direction_average"),
)
# ------------------------------------------------------------ end fixed values

SIGNAL_KEYS = (POWER, WIND_SPEED, THEORETICAL_POWER, WIND_DIRECTION)

# One turbine reading as it arrives in CSV files (columns bind by position).
TURBINE_SCHEMA = T.StructType(
    [T.StructField(DATE_TIME, T.StringType())]
    + [T.StructField(k, T.DoubleType()) for k in SIGNAL_KEYS]
)

# The same reading without its timestamp text (narrow decode).
NARROW_SCHEMA = T.StructType([T.StructField(k, T.DoubleType()) for k in SIGNAL_KEYS])

# The stored signal table.
SIGNAL_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("signal_date", T.DateType()),
        T.StructField("signal_ts", T.TimestampType()),
        T.StructField("signals", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("create_date", T.DateType()),
        T.StructField("create_ts", T.TimestampType()),
    ]
)
SIGNAL_TABLE_COLUMNS = tuple(f.name for f in SIGNAL_TABLE_SCHEMA.fields)

# A message whose payload already is a signal row (nested payload).
NESTED_PAYLOAD_DDL = "signal_date DATE, signal_ts TIMESTAMP, signals MAP<STRING, STRING>"

MAPPING_DDL = "sig_name STRING, sig_mapping_name STRING"
MAPPING_JSON_DDL = "array<struct<sig_name: string, sig_mapping_name: string>>"

# Columns of a keyed message log, the same as Spark's Kafka source.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
TOPIC_COLUMNS = tuple(f.name for f in TOPIC_SCHEMA.fields)
