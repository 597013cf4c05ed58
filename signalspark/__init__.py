"""Sensor-signal analytics as Spark DataFrame operators and Structured Streaming jobs."""

from signalspark import schemas
from signalspark.session import build_session, scratch_dir

__all__ = ["build_session", "schemas", "scratch_dir"]
