"""Change events as a stream: replayed in order into the catalog, batch by batch, with the same merge as in batch jobs.

The catalog is a folder of versions; a batch writes the next one and a marker file commits it, so a batch that is run again after
a failure writes the same version again. The stream's checkpoint is the acknowledgement.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corvane.operators.catalog import SCHEMA, identity_collisions, merge_events

EVENTS = f"seq long, event_id string, operation string, {SCHEMA}"


def _version(path: str, batch: int) -> str:
    return f"{path}/version={batch:012d}"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_catalog(spark: SparkSession, path: str, batch: int | None = None) -> DataFrame:
    """The catalog's last committed version, or the last one before a batch; an empty table if there is none."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    if fs.exists(root):
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = sorted(n for n in names if n.startswith("version=") and _exists(spark, f"{path}/{n}/_SUCCESS"))
    if batch is not None:
        found = [n for n in found if n < f"version={batch:012d}"]
    return spark.read.schema(SCHEMA).parquet(f"{path}/{found[-1]}") if found else spark.createDataFrame([], SCHEMA)


class IdentityCollisionError(ValueError):
    """A key's events are about different documents; nothing of the batch is applied."""


def apply_batch(events: DataFrame, batch: int, path: str, seen: str | None = None) -> None:
    """Apply one batch in event order: known ids are left out, a collision stops the stream and leaves the batch pending."""
    spark = events.sparkSession
    before = read_catalog(spark, path, batch)
    new = events
    if seen is not None:
        known = _known_ids(spark, seen, batch)
        new = new.join(known, "event_id", "left_anti").dropDuplicates(["event_id"])
    new = new.persist()
    try:
        if not identity_collisions(before, new).isEmpty():
            raise IdentityCollisionError(f"batch {batch}")
        merge_events(before, new).write.mode("overwrite").parquet(_version(path, batch))
        if seen is not None:
            new.select("event_id").write.mode("overwrite").parquet(f"{seen}/batch={batch:012d}")
    finally:
        new.unpersist()


def _known_ids(spark: SparkSession, seen: str, batch: int) -> DataFrame:
    if not _exists(spark, seen):
        return spark.createDataFrame([], "event_id string")
    read = spark.read.schema("event_id string, batch string").parquet(seen)
    return read.where(F.col("batch") < f"{batch:012d}").select("event_id")


def replay(spark: SparkSession, source: str, path: str, checkpoint: str, seen: str | None = None, files: int = 100) -> StreamingQuery:
    """Apply all events that lie in ``source`` as JSON lines, then stop. A failed batch stops it; later ones stay pending."""
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).json(source)
    writer = stream.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, path, seen)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def compact(events: DataFrame, acked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that aren't acknowledged, quarantined ones too, and the counts ``before, removed, retained``."""
    done = acked.select("event_id").distinct().withColumn("_done", F.lit(True))
    told = events.join(done, "event_id", "left")
    counts = told.agg(F.count("*").alias("before"), F.count("_done").alias("removed"), F.count_if(F.col("_done").isNull()).alias("retained"))
    return told.where("_done is null").drop("_done"), counts


def quarantine(requests: DataFrame, events: DataFrame, acked: DataFrame, quarantined: DataFrame) -> DataFrame:
    """``requests(event_id, reason)`` that are about pending events: the rows to append to the quarantine."""
    from corvane.operators.joins import pending_events

    return requests.join(pending_events(events, acked, quarantined).select("event_id"), "event_id", "left_semi").dropDuplicates(["event_id"])


def failures_by_kind(failures: DataFrame) -> DataFrame:
    """Failures that will pass and those that won't, as their writer says; anything else is unclassified."""
    kind = F.when(F.col("failure_kind").isin("transient", "permanent"), F.col("failure_kind")).otherwise("unclassified")
    return failures.groupBy(kind.alias("failure_kind")).agg(F.count("*").alias("failures"))


def absence_streaks(coverage: DataFrame, threshold: int = 2) -> DataFrame:
    """A stream of ``key, run (long), found, complete`` -> a row whenever a version's runs of absence reach the threshold.

    A sighting resets the count, an incomplete list changes nothing. Runs of a micro-batch are taken in order.
    """

    def count(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        missing = state.get[0] if state.exists else 0
        fired = []
        for r in pd.concat(list(frames)).sort_values("run").itertuples():
            if r.found:
                missing = 0
            elif r.complete:
                missing += 1
                if missing == threshold:
                    fired.append((key[0], int(r.run), missing))
        state.update((missing,))
        yield pd.DataFrame(fired, columns=["key", "run", "missing"])

    grouped = coverage.groupBy("key")
    return grouped.applyInPandasWithState(count, "key string, run long, missing int", "missing int", "append", GroupStateTimeout.NoTimeout)


def absences(coverage: DataFrame, threshold: int = 2) -> DataFrame:
    """The same over a table: runs at which a version's streak of absences reaches the threshold, by window functions."""
    from pyspark.sql import Window

    by_run = Window.partitionBy("key").orderBy("run")
    sightings = F.count_if(F.col("found")).over(by_run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    told = coverage.withColumn("_spell", sightings).where("not found and complete")
    n = F.row_number().over(Window.partitionBy("key", "_spell").orderBy("run"))
    return told.withColumn("missing", n).where(F.col("missing") == threshold).select("key", "run", "missing")
