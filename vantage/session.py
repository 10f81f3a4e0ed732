"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a local test or bench session uses. On a cluster the submitter's configuration wins:
# builder options only apply to a session that does not exist yet.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once nothing references the checkpointed data any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "vantage", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialized intermediate tables.

    Read from ``spark.checkpoint.dir``. A folder is only made up for a local-mode session that has
    none (tests); on a cluster an unset value is an error rather than a machine-local folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            # a machine-local folder is not visible to other executors and dies with the machine
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's file system)")
        path = tempfile.mkdtemp(prefix="vantage-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder, for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark).rstrip("/"), "vantage", *parts)
