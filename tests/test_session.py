"""Session settings and the shared scratch folder."""

from __future__ import annotations

from signalspark.session import DEFAULT_CONFIGS, DELTA_CONFIGS, scratch_dir


def test_scratch_dirs_are_unique_under_the_checkpoint_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root + "/signalspark/x-")


def test_defaults_pin_the_zone_and_keep_the_ui_off():
    assert DEFAULT_CONFIGS["spark.sql.session.timeZone"] == "UTC"
    assert DEFAULT_CONFIGS["spark.ui.enabled"] == "false"
    assert DEFAULT_CONFIGS["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "spark.sql.extensions" in DELTA_CONFIGS
