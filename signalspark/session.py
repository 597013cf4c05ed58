"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DELTA_CONFIGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}

DEFAULT_CONFIGS = {
    # Parsed timestamps depend on the zone; pin it so jobs agree everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "signalspark",
    master: str | None = None,
    table_format: str = "parquet",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the settings every job relies on.

    ``master`` is left to ``spark-submit`` unless given.  The Delta session
    extension and catalog are only configured when ``table_format='delta'``
    (their jars must then be on the class path).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    confs = dict(DEFAULT_CONFIGS)
    if table_format == "delta":
        confs.update(DELTA_CONFIGS)
    if shuffle_partitions:
        confs["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    confs.update(extra or {})
    for key, value in confs.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            # A folder on one machine is invisible to the other executors.
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
        # Only for local runs and tests.
        root = tempfile.mkdtemp(prefix="signalspark-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the cluster's shared checkpoint folder.

    The root is read from ``spark.checkpoint.dir``; a local folder is made
    only when the session names none.  Each call gets a fresh sub-folder so
    that runs never share checkpoints or outputs.
    """
    return f"{_checkpoint_root(spark)}/signalspark/{name}-{uuid.uuid4().hex[:12]}"
