"""Fresh folders that driver and executors share, for tables that a job writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; where that is unset, and Spark runs on one machine, below a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/corvane-{uuid.uuid4().hex}/{name}"
