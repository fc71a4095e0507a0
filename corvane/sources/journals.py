"""Versioned JSON-lines journals, outboxes and run summaries."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.keys import DOCUMENT_KEY, PRODUCT_KEY

OPERATIONS = ("upsert_seen", "upsert_result", "update_status_rows")
FINAL_STATES = ("SUCCESS", "PARTIAL_SUCCESS", "FAILED", "LOCKED")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the start of their split and the offset in it; an unended last line keeps its mark.

    The text reader splits files anywhere, so a long journal is read by many tasks.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = None, 0
        for batch in batches:
            numbers = []
            for key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = (key, 0) if key != at else (at, n + 1)
                numbers.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=["file", "block", "size", "line", "line_no"])

    # Without a final line end the file's size equals the sum of its lines with one line end less.
    read = spark.read.option("lineSep", "\n").text(path)
    told = read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("long").alias("block"), F.col("_metadata.file_size").cast("long").alias("size"), F.col("value").alias("line"))
    return told.mapInArrow(place, "file string, block long, size long, line string, line_no long")


def read_journal(spark: SparkSession, path: str, schema: str | T.StructType, version: int) -> tuple[DataFrame, DataFrame]:
    """Rows of a journal in arrival order (``ingest_seq``), and its errors ``file, block, line_no, line``; a caller stops if there are any.

    A row must be an object of ``schema`` whose ``schema_version`` is ``version``. A bad row is an error unless it is the last of its
    file and has no line end: then a writer was cut off, and the row is dropped. Blank lines are skipped.
    """
    lines = _lines(spark, path)
    totals = lines.groupBy("file", "size").agg(F.sum(F.octet_length("line") + 1).alias("bytes"), F.max(F.struct("block", "line_no")).alias("last"))
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    probe = T.StructType([*[f for f in kind if f.name != "schema_version"], T.StructField("schema_version", T.IntegerType()), T.StructField("_corrupt_record", T.StringType())])
    row = F.from_json("line", probe, {"columnNameOfCorruptRecord": "_corrupt_record"})
    parsed = lines.where(F.trim("line") != "").join(totals, ["file", "size"]).withColumn("row", row)
    good = F.col("row").isNotNull() & F.col("row._corrupt_record").isNull() & F.trim("line").startswith("{") & F.coalesce(F.col("row.schema_version") == version, F.lit(False))
    torn = (F.struct("block", "line_no") == F.col("last")) & (F.col("size") < F.col("bytes"))
    rows = parsed.where(good).select("file", "block", "line_no", "row.*").drop("_corrupt_record")
    return _with_seq(rows), parsed.where(~good & ~torn).select("file", "block", "line_no", "line")


def _with_seq(rows: DataFrame) -> DataFrame:
    """A number that grows with file, split and line: the line's place in the split, after all lines of the splits before."""
    sizes = rows.groupBy("file", "block").agg((F.max("line_no") + 1).alias("_lines"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_lines").over(before), F.lit(0))).drop("_lines")
    return rows.join(starts, ["file", "block"]).withColumn("ingest_seq", F.col("_start") + F.col("line_no") + 1).drop("_start", "file", "block", "line_no")


def append_log(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Rows at the end of a log; earlier ones stay as they are."""
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).json(path)


def judged_events(lines: DataFrame) -> DataFrame:
    """``lines(ingest_seq, value)`` of an outbox as events, and whether each is ``good``.

    An event needs an id, a known operation and a payload whose keys have the right form.
    """
    event = F.from_json("value", "event_id string, created_at string, event struct<operation:string,payload:string>")
    told = lines.withColumn("e", event).select("ingest_seq", "value", "e.event_id", F.try_to_timestamp("e.created_at").alias("created_at"), "e.event.operation", "e.event.payload")
    keys = F.from_json("payload", "document_key string, product_version_key string")
    keyed = F.coalesce(keys["document_key"].rlike(DOCUMENT_KEY), F.lit(False)) & F.coalesce(keys["product_version_key"].rlike(PRODUCT_KEY), F.lit(False))
    statuses = F.from_json("payload", "rows array<struct<document_key:string>>")["rows"]
    listed = F.coalesce(F.forall(statuses, lambda r: r["document_key"].rlike(DOCUMENT_KEY)), F.lit(False))
    good = F.col("event_id").isNotNull() & F.coalesce(F.col("operation").isin(*OPERATIONS), F.lit(False)) & F.when(F.col("operation") == "update_status_rows", listed).otherwise(keyed)
    return told.withColumn("good", good)


def parse_events(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``lines(ingest_seq, value)`` of an outbox -> events ``ingest_seq, event_id, created_at, operation, payload`` and errors; a caller stops at any error."""
    told = judged_events(lines)
    return told.where("good").drop("value", "good"), told.where(~F.col("good")).select("ingest_seq", "value")


SUMMARY = "run_id string, layout_version int, finished_at string, run_status string, total_records long, companies map<string,string>"


def completed_runs(spark: SparkSession, path: str) -> DataFrame:
    """Summaries of finished runs under ``year/month/day/run_id/summary.json``; half-written and odd ones are left out."""
    folder = F.url_decode(F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), F.lit("+"), F.lit("%2B")))
    read = spark.read.schema(SUMMARY).option("multiLine", True).option("mode", "PERMISSIVE").json(f"{path}/*/*/*/*/summary.json")
    day = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4})/(\d{2})/(\d{2})/[^/]+/summary\.json$", 0)
    told = read.select("*", folder.alias("_dir"), F.regexp_replace(F.substring(day, 2, 10), "/", "-").alias("run_day"))
    finished = F.trim(F.coalesce("finished_at", F.lit(""))) != ""
    return told.where((F.col("run_id") == F.col("_dir")) & (F.col("layout_version") == 3) & finished & F.col("run_status").isin(*FINAL_STATES)).drop("_dir")


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.col("run_day").desc(), F.col("run_id").desc()).limit(1)


def write_summary(summary: DataFrame, path: str) -> None:
    """A run's summary: one row, one file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def publish_summaries(summaries: DataFrame, path: str) -> int:
    """Each run's summary as one file ``year/month/day/run_id/summary.json`` under ``path``, where ``completed_runs`` finds it; returns how many.

    ``summaries(run_day, run_id, ...)``, a row for each run, with the run's date as ``2026-07-01``. Files are written beside their place and renamed into it, so a reader sees a whole summary or none; a summary
    that is there already is replaced. One rename for each run passes through the driver.
    """
    spark = summaries.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    staged = f"{path.rstrip('/')}/_staged"
    day = F.split("run_day", "-")
    folder = F.concat_ws("/", day, "run_id").alias("_folder")
    text = F.to_json(F.struct(*[c for c in summaries.columns if c != "run_day"])).alias("value")
    summaries.select(folder, text).repartition("_folder").write.mode("overwrite").partitionBy("_folder").text(staged)
    root = jvm.org.apache.hadoop.fs.Path(staged)
    fs = root.getFileSystem(conf)
    done = 0
    for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{staged}/_folder=*/part-*")):
        name = unquote(status.getPath().getParent().getName().removeprefix("_folder="))
        target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}/summary.json")
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            fs.delete(target, False)
        fs.rename(status.getPath(), target)
        done += 1
    fs.delete(root, True)
    return done


def write_by_month(plan: DataFrame, path: str) -> None:
    """The plan filed under its months."""
    plan.write.mode("overwrite").partitionBy("month").json(path)


def write_records(path: str, **tables: DataFrame) -> None:
    """Page, table, image and warning records, a folder of JSON lines for each."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path}/{name}")



#: Records of an extractor by kind: what it says about pages, their lines, table candidates, images and warnings.
RECORDS = {
    "pages": "doc_id string, page_no int, width double, height double, text_raw string, extraction_failed boolean",
    "lines": "doc_id string, page_no int, line_no int, text string, x0 double, top double, x1 double, bottom double",
    "tables": "doc_id string, page_no int, candidate_index int, bbox array<double>, rows array<array<string>>",
    "images": "doc_id string, page_no int, x0 double, top double, x1 double, bottom double, pixel_width int, pixel_height int, sha256 string",
    "warnings": "doc_id string, code string, page_no int, message string",
}


def read_records(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Records of a kind, and the lines that aren't such records: no object, a value of another type, or no document."""
    told = spark.read.schema(f"{RECORDS[kind]}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(f"{path}/{kind}")
    good = F.col("_bad").isNull() & F.col("doc_id").isNotNull()
    return told.where(good).drop("_bad"), told.where(~good).select(F.coalesce("_bad", F.to_json(F.struct(*[c for c in told.columns if c != "_bad"]))).alias("line"))
