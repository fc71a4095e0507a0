"""Tables that cut lineage, written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only where it is unset and Spark runs on one machine a temporary one is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(configured)
        configured = spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/corvane-{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Later reads survive the loss of executors, and Spark knows the table's size from then on.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._corvane_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table._corvane_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
