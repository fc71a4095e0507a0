"""An outbox replayed as a stream: events are checked, applied first in, first out, and acknowledged; the first bad one stops it.

What is ahead of the bad event is applied and acknowledged, what follows stays pending. Once the bad event is mended or set aside the stream goes on
from there: acknowledged events of the unfinished batch are known by their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvane.operators.catalog import COLUMNS, SCHEMA, STATUS, apply_status_updates, identity_collisions, merge_events
from corvane.sources.journals import judged_events
from corvane.sources.scratch import fresh_path
from corvane.streaming.store import BucketedTable, Staging

IDS = "event_id string"
_KINDS = dict(part.split(" ", 1) for part in SCHEMA.split(", "))
_UPDATED = ("document_key", *STATUS, "last_status_run_id", "saved_relative_path")
_UPDATE = ",".join(f"{c}:{_KINDS[c]}" for c in _UPDATED)


class PoisonedEventError(ValueError):
    """The number of the first event that can't be applied."""

    def __init__(self, seq: int) -> None:
        super().__init__(f"event {seq} is bad or about another document than its key's; those before it are applied")
        self.seq = seq


def catalog_table(spark: SparkSession, path: str, **how) -> BucketedTable:
    return BucketedTable(spark, f"{path}/catalog", SCHEMA, "document_key", **how)


def id_table(spark: SparkSession, path: str, **how) -> BucketedTable:
    return BucketedTable(spark, f"{path}/acked", IDS, "event_id", **how)


def upserts_of(events: DataFrame) -> DataFrame:
    """Upsert events with their payloads as columns of the catalog."""
    rows = events.where(F.col("operation") != "update_status_rows").withColumn("p", F.from_json("payload", SCHEMA))
    empty = F.create_map().cast("map<string,string>")
    return rows.select("seq", "operation", *[F.coalesce(f"p.{c}", empty).alias(c) if c == "source_metadata" else F.col(f"p.{c}") for c in COLUMNS])


def updates_of(events: DataFrame) -> DataFrame:
    """Status updates, one row for each document that an event names."""
    rows = F.from_json("payload", f"rows array<struct<{_UPDATE}>>")["rows"]
    return events.where(F.col("operation") == "update_status_rows").select("seq", F.explode(rows).alias("r")).select("seq", *[F.col(f"r.{c}") for c in _UPDATED])


def replayed_onto(catalog: DataFrame, upserts: DataFrame, updates: DataFrame) -> DataFrame:
    """The catalog after all events, each document's in order.

    Documents don't depend on each other, so of each the first stretch of events of one sort is applied, then its second, and so on: as
    many rounds as some document changes between sorts, not as there are events. Events of a single sort are one round.
    """
    if updates.isEmpty():
        return merge_events(catalog, upserts)
    if upserts.isEmpty():
        return apply_status_updates(catalog, updates)[0].select(*COLUMNS)
    marks = upserts.select("document_key", "seq", F.lit(0).alias("sort")).union(updates.select("document_key", "seq", F.lit(1)))
    by_key = Window.partitionBy("document_key").orderBy("seq")
    changed = marks.withColumn("_new", F.coalesce((F.col("sort") != F.lag("sort").over(by_key)).cast("int"), F.lit(0)))
    stretch = changed.select("document_key", "seq", F.sum("_new").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("stretch"))
    stretch = _kept(stretch.distinct(), "stretches")
    rounds = stretch.agg(F.max("stretch")).first()[0]
    for n in range(0 if rounds is None else rounds + 1):
        now = stretch.where(F.col("stretch") == n).drop("stretch")
        catalog = merge_events(catalog, upserts.join(now, ["document_key", "seq"], "left_semi"))
        catalog = apply_status_updates(catalog, updates.join(now, ["document_key", "seq"], "left_semi"))[0].select(*COLUMNS)
        if n:
            catalog = _kept(catalog, "round")
    return catalog


def _kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows that several steps read, computed once."""
    path = fresh_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _publish(staging: Staging, catalog: BucketedTable, acked: BucketedTable) -> None:
    catalog.overwrite(staging.part("rows", SCHEMA))
    acked.append(staging.part("ids", IDS))
    staging.done()


def apply_outbox(lines: DataFrame, path: str, quarantined: DataFrame | None = None, **how) -> None:
    """Apply one batch of ``lines(value)``, JSON events with a number ``seq``, to the catalog and the acknowledged ids under ``path``.

    A line without a number is bad ahead of all others. Repeated ids count once, their first event; acknowledged and quarantined ones are passed over. The
    first event that is malformed, or about another document than its key's earlier events, raises ``PoisonedEventError`` after everything ahead of it is done.
    """
    spark = lines.sparkSession
    catalog, acked, staging = catalog_table(spark, path, **how), id_table(spark, path, **how), Staging(spark, path)
    if staging.ready():
        _publish(staging, catalog, acked)
    told = _kept(lines.select(F.coalesce(F.get_json_object("value", "$.seq").try_cast("long"), F.lit(-1)).alias("ingest_seq"), F.get_json_object("value", "$.event_id").alias("event_id"), "value"), "told")
    pending = told.join(acked.matching(told.where("event_id is not null")), "event_id", "left_anti")
    if quarantined is not None:
        pending = pending.join(quarantined.select("event_id"), "event_id", "left_anti")
    firsts = pending.where("event_id is not null").groupBy("event_id").agg(F.min(F.struct("ingest_seq", "value")).alias("first")).select("first.*")
    firsts = firsts.union(pending.where("event_id is null").select("ingest_seq", "value"))
    judged = _kept(judged_events(firsts).select(F.col("ingest_seq").alias("seq"), "event_id", "operation", "payload", "good"), "judged")
    events, errors = judged.where("good").drop("good"), judged.where(~F.col("good"))
    upserts, updates = _kept(upserts_of(events), "upserts"), _kept(updates_of(events), "updates")
    buckets = catalog.touched(upserts.select("document_key").union(updates.select("document_key")))
    before = catalog.read(buckets)
    bad = errors.select("seq").union(events.where("seq < 0").select("seq")).union(identity_collisions(before, upserts).select("seq")).agg(F.min("seq")).first()[0]
    if bad is not None:
        events, upserts, updates = (rows.where(F.col("seq") < bad) for rows in (events, upserts, updates))
    staging.stage(rows=replayed_onto(before, upserts, updates), ids=events.select("event_id"))
    _publish(staging, catalog, acked)
    if bad is not None:
        raise PoisonedEventError(bad)


def replay_outbox(spark: SparkSession, source: str, path: str, checkpoint: str, quarantined: str | None = None, files: int = 100, **how) -> StreamingQuery:
    """Apply all lines of the text files under ``source``, oldest files first, then stop. ``quarantined``: a table of event ids, read for each batch."""

    def apply(batch: DataFrame, _: int) -> None:
        aside = spark.read.schema(IDS).json(quarantined) if quarantined else None
        apply_outbox(batch, path, aside, **how)

    stream = spark.readStream.option("maxFilesPerTrigger", files).text(source)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
