"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """UTC timestamps, and a checkpoint folder where the cluster names none."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if not spark.sparkContext.getCheckpointDir():
        folder = checkpoint_dir(spark)
        if not folder:
            # Only a local session may use a folder of its machine: executors must share it.
            if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="plumbline-")
        spark.sparkContext.setCheckpointDir(folder)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()
