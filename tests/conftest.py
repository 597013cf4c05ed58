from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def make_session():
    from pyspark.sql import SparkSession

    ck = tempfile.mkdtemp(prefix="signalspark-test-")
    return (
        SparkSession.builder.master("local[8]")
        .appName("signalspark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", ck)
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


@pytest.fixture(scope="session")
def spark():
    s = make_session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def work(tmp_path):
    return str(tmp_path)
