"""Session options (S1) and the shared checkpoint folder.

The caller owns the SparkSession. ``session_builder`` only collects the
options the dashboard set (Kryo, Arrow, result cap) plus the adaptive
execution switches every plan here relies on.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Options that the plans assume. AQE coalesces the small post-aggregate
# partitions and splits skewed join partitions at run time.
DEFAULT_OPTIONS = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.driver.maxResultSize": "2g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Checkpoint files of dropped DataFrames are removed by the context cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session_builder(master: str | None = None, app_name: str = "ontime",
                    options: dict[str, str] | None = None) -> SparkSession.Builder:
    """Return a builder with the default options; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_OPTIONS, **(options or {})}.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read
    (unset is an error there). Only in local mode (tests) is a private folder
    created and set when the setting is missing.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    local = tempfile.mkdtemp(prefix="ontime-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

