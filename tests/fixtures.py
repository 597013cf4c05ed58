"""Small literal fixtures (FIXTURES.md section 2) shared by the unit tests."""

from __future__ import annotations

from signalspark.schemas import TURBINE_SCHEMA

# Date/Time, power, wind speed, power curve, direction.
EDGE_ROWS = [
    ("01 01 2018 00:00", 380.04, 5.31, 416.32, 259.99),  # normal
    ("01 01 2018 00:00", 100.0, 1.0, 1.0, 1.0),  # same timestamp again
    ("01 01 2018 00:10", None, 5.0, 400.0, 1.0),  # blank power
    ("31 12 2018 23:50", 1200.5, 11.0, 3000.0, 90.0),  # day over 12, year end
    ("bad", 10.0, 1.0, 1.0, 1.0),  # date that does not parse
]

EDGE_CSV = """Date/Time,LV ActivePower (kW),Wind Speed (m/s),Theoretical_Power_Curve (KWh),Wind Direction (°)
01 01 2018 00:00,380.04,5.31,416.32,259.99
01 01 2018 00:00,100,1,1,1
01 01 2018 00:10,,5.0,400.0,1.0
31 12 2018 23:50,1200.5,11.0,3000.0,90.0
bad,10,1,1,1
"""

# Average of the power column over the rows above (the blank one is skipped).
EDGE_POWER_AVERAGE = (380.04 + 100.0 + 1200.5 + 10.0) / 4


def edge_readings(spark):
    return spark.createDataFrame(EDGE_ROWS, TURBINE_SCHEMA)


def write_text(path, name: str, text: str) -> str:
    path.mkdir(parents=True, exist_ok=True)
    f = path / name
    f.write_text(text, encoding="utf-8")
    return str(f)
