"""The catalog of documents: conditional upserts of events that arrive out of order, status updates, checks.

An event is accepted column group by column group, by three clocks. A key's rows are put in event order; running
maxima of the clocks say which rows are accepted, and a result column is the value of the last (or first) accepted row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions.dates import parse_date
from corvane.functions.keys import DOCUMENT_KEY, KEY_VERSION, PRODUCT_KEY, SHA256
from corvane.functions.status import only_if_available, proven_file_state, sale_state

#: Column groups of a catalog row.
SEEN = ("product_version_key", "collector_type", "company_name", "product_category", "source_product_id", "product_name", "product_name_normalized", "last_seen_run_id", "last_seen_at")
STATUS = ("sale_status", "sale_status_raw", "sale_start_date", "sale_end_date", "status_checked_at", "status_changed_at", "status_missing_count")
DOCUMENT = ("document_date", "document_date_basis", "document_type", "document_label", "source_page_url", "document_url", "original_filename")
FILE = ("file_status", "saved_relative_path", "file_size", "sha256")
ATTEMPT = ("last_attempt_status", "error_message", "last_attempt_at")
RUNS = ("last_download_run_id", "last_status_run_id")
#: Metadata that the first writer keeps.
KEPT_METADATA = ("migration", "checkpoint_key", "source_locator", "migration_verification")
IDENTITY_METADATA = ("document_key", "product_version_key", "identity_version")

SCHEMA = (
    "document_key string, company_code string, product_version_key string, collector_type string, company_name string, product_category string, source_product_id string, "
    "product_name string, product_name_normalized string, last_seen_run_id string, last_seen_at timestamp, sale_status string, sale_status_raw string, sale_start_date date, "
    "sale_end_date date, status_checked_at timestamp, status_changed_at timestamp, status_missing_count int, document_date date, document_date_basis string, document_type string, "
    "document_label string, source_page_url string, document_url string, original_filename string, file_status string, saved_relative_path string, file_size bigint, sha256 string, "
    "last_attempt_status string, error_message string, last_attempt_at timestamp, downloaded_at timestamp, last_download_run_id string, last_status_run_id string, "
    "identity_version smallint, source_metadata map<string,string>"
)
COLUMNS = tuple(part.split()[0] for part in SCHEMA.split(", "))


def effective_locator(metadata: Column, url: Column, filename: Column) -> Column:
    """What tells a document from its siblings in a catalog row."""
    filled = [F.nullif(c, F.lit("")) for c in (F.try_element_at(metadata, F.lit("checkpoint_key")), F.try_element_at(metadata, F.lit("source_locator")), url, filename)]
    return F.coalesce(*filled, F.lit(""))


def _identity() -> Column:
    names = ("product_version_key", "company_code", "source_product_id", "document_type", "document_date")
    return F.struct(*names, effective_locator(F.col("source_metadata"), F.col("document_url"), F.col("original_filename")).alias("locator"))


def identity_collisions(catalog: DataFrame, events: DataFrame) -> DataFrame:
    """Events whose identity differs from that of their key's first row; none of them may be applied."""
    base = catalog.select("document_key", F.lit(0).cast("long").alias("seq"), _identity().alias("identity"))
    rows = base.union(events.select("document_key", F.col("seq").cast("long"), _identity().alias("identity")))
    first = rows.groupBy("document_key").agg(F.min_by("identity", "seq").alias("first"))
    told = rows.where("seq > 0").join(first, "document_key")
    return told.where(~F.equal_null("identity", "first")).select("document_key", "seq")


def _history(catalog: DataFrame, events: DataFrame) -> DataFrame:
    old = catalog.select(F.lit(0).cast("long").alias("seq"), F.lit(True).alias("result"), *COLUMNS)
    new = events.select(F.col("seq").cast("long").alias("seq"), (F.col("operation") == "upsert_result").alias("result"), *COLUMNS)
    return old.unionByName(new.withColumn("last_attempt_at", F.when(F.col("result"), F.col("last_attempt_at"))))


def _flagged(catalog: DataFrame, events: DataFrame) -> DataFrame:
    by_key = Window.partitionBy("document_key").orderBy("seq")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)

    def newer(clock: str, among: Column) -> Column:
        latest = F.max(F.when(among, F.col(clock))).over(before)
        return F.coalesce(latest.isNull() | (F.col(clock) >= latest), F.lit(False))

    rows = _history(catalog, events).withColumn("base", F.row_number().over(by_key) == 1)
    rows = rows.withColumn("ns", F.col("base") | newer("last_seen_at", F.lit(True)))
    rows = rows.withColumn("na", F.col("base") | (F.col("result") & newer("last_attempt_at", F.col("result") | F.col("base"))))
    return rows.withColumn("st", F.col("base") | (F.col("ns") & newer("status_checked_at", F.col("ns"))))


def _last(columns: tuple[str, ...], accepted: Column) -> Column:
    return F.max_by(F.struct(*columns), F.when(accepted, F.col("seq")))


def _last_filled(column: str, accepted: Column) -> Column:
    return F.max_by(column, F.when(accepted & F.col(column).isNotNull(), F.col("seq"))).alias(column)


def merge_events(catalog: DataFrame, events: DataFrame) -> DataFrame:
    """The catalog after ``events(seq, operation, <columns>)``, operation being upsert_seen or upsert_result.

    Late events change nothing that a newer clock has set. Check ``identity_collisions`` first. Applying events in
    one batch or in several gives the same catalog; rows of equal key and seq must not exist. A dry run proves no
    file, so its file state is never AVAILABLE.
    """
    rows = _flagged(catalog, events)
    told = F.col("base") | (F.col("result") & (F.col("na") | F.col("ns")))
    real = F.col("na") & (F.col("base") | ~F.equal_null(F.col("last_attempt_status"), F.lit("DRY_RUN")))
    # Which row each column comes from is told by numbers alone; only those rows are then read whole.
    accepted = {"seen": F.col("ns"), "status": F.col("st"), "attempt": F.col("na"), "real_file": real, "any_file": F.col("na"), "identity_version": F.col("ns") | told} | dict.fromkeys(DOCUMENT, told)
    accepted |= {"last_download_run_id": F.col("na"), "last_status_run_id": F.col("base") | (F.col("result") & F.col("st"))}
    accepted |= {c: accepted[c] & F.col(c).isNotNull() for c in (*DOCUMENT, *RUNS)}
    columns = {"seen": SEEN, "status": STATUS, "attempt": ATTEMPT, "real_file": FILE, "any_file": FILE}
    at = [F.max(F.when(ok, F.col("seq"))).alias(f"_{name}") for name, ok in accepted.items()]
    places = rows.groupBy("document_key").agg(F.min("seq").alias("_first"), F.max(F.when(told, F.col("downloaded_at"))).alias("_downloaded"), *at)
    whole = _history(catalog, events).drop("result").withColumnRenamed("document_key", "_key")
    wanted = reduce(lambda a, b: a | F.coalesce(b, F.lit(False)), [F.col("seq") == F.col(f"_{name}") for name in accepted], F.col("seq") == F.col("_first"))
    read = whole.join(places, F.equal_null("_key", "document_key")).where(wanted)

    def taken(name: str, value: Column) -> Column:
        return F.max_by(value, F.when(F.col("seq") == F.col(f"_{name}"), F.col("seq"))).alias(name)

    merged = read.groupBy("document_key").agg(
        F.min_by("company_code", "seq").alias("company_code"),
        *[taken(name, F.struct(*columns[name]) if name in columns else F.col(name)) for name in accepted],
        F.first("_downloaded").alias("downloaded_at"),
    )
    file = F.when(F.col("real_file.file_status") == "AVAILABLE", F.col("real_file")).otherwise(F.col("any_file"))
    flat = merged.withColumn("file", file).select(
        "document_key", "company_code", "seen.*", "status.*", *DOCUMENT, "file.*", "attempt.*", "downloaded_at", *RUNS, "identity_version"
    )
    entries = rows.where("ns").select("document_key", "seq", F.explode("source_metadata").alias("name", "value"))
    kept = entries.groupBy("document_key", "name").agg(F.min_by("value", "seq").alias("first"), F.max_by("value", "seq").alias("last"))
    value = F.when(F.col("name").isin(*KEPT_METADATA), F.col("first")).otherwise(F.col("last"))
    maps = kept.groupBy("document_key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", value.alias("value"))))).alias("source_metadata"))
    empty = F.create_map().cast("map<string,string>")
    return flat.join(maps, "document_key", "left").withColumn("source_metadata", F.coalesce("source_metadata", empty)).select(*COLUMNS)


def apply_status_updates(catalog: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The catalog after ``updates(seq, document_key, <status columns>, last_status_run_id, saved_relative_path)``, and their outcomes.

    Outcomes ``requested, updated, stale_noop, missing`` as one row; an update older than what is known is stale.
    """
    columns = ("document_key", *STATUS, "last_status_run_id", "saved_relative_path")
    old = catalog.select(F.lit(0).cast("long").alias("seq"), *columns)
    rows = old.unionByName(updates.select(F.col("seq").cast("long").alias("seq"), *columns))
    before = Window.partitionBy("document_key").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.max("status_checked_at").over(before)
    there = F.max(F.col("seq") == 0).over(Window.partitionBy("document_key"))
    newer = F.coalesce(latest.isNull() | (F.col("status_checked_at") >= latest), F.lit(False))
    judged = rows.withColumn("there", there).withColumn("ok", (F.col("seq") == 0) | (F.col("there") & newer))
    new = judged.where("there").groupBy("document_key").agg(_last((*STATUS, "last_status_run_id"), F.col("ok")).alias("s"), _last_filled("saved_relative_path", F.col("ok")))
    rest = catalog.drop(*STATUS, "last_status_run_id", "saved_relative_path")
    asked = F.col("seq") > 0
    outcome = judged.agg(
        F.count_if(asked).alias("requested"),
        F.count_if(asked & F.col("ok")).alias("updated"),
        F.count_if(asked & F.col("there") & ~F.col("ok")).alias("stale_noop"),
        F.count_if(asked & ~F.col("there")).alias("missing"),
    )
    return rest.join(new.select("document_key", "s.*", "saved_relative_path"), "document_key").select(*catalog.columns), outcome


def clean_metadata(metadata: Column) -> Column:
    """Metadata without what the catalog has as columns."""
    return F.map_filter(metadata, lambda k, _: ~k.isin(*IDENTITY_METADATA))


def provenance_errors(catalog: DataFrame) -> DataFrame:
    """Source rows in the metadata that aren't positive whole numbers, or that several documents claim: ``source_row, documents``."""
    told = catalog.select(F.try_element_at("source_metadata", F.lit("source_row")).alias("source_row")).where("source_row is not null")
    counted = told.groupBy("source_row").agg(F.count("*").alias("documents"))
    return counted.where(~F.col("source_row").rlike("^[1-9][0-9]*$") | (F.col("documents") > 1))


#: The checks of a catalog row: a name, and what must hold (null counts as held).
CONSTRAINTS = {
    "document_key_format": f"document_key rlike '{DOCUMENT_KEY}'",
    "product_version_key_format": f"product_version_key rlike '{PRODUCT_KEY}'",
    "identity_version": f"identity_version = {KEY_VERSION}",
    "sha256_format": f"sha256 rlike '{SHA256}'",
    "missing_count": "status_missing_count >= 0",
    "file_size": "file_size >= 0",
    "sale_status": "sale_status in ('ACTIVE', 'ENDED', 'UNKNOWN')",
    "file_status": "file_status in ('PENDING', 'AVAILABLE', 'UNAVAILABLE', 'INVALID', 'MANUAL_REVIEW')",
    "document_type": "document_type in ('POLICY', 'SUMMARY', 'METHOD', 'UNKNOWN_DOCUMENT_TYPE')",
    "sale_period": "sale_end_date >= sale_start_date",
    "available_has_sha256": "file_status <> 'AVAILABLE' or sha256 is not null",
}


def constraint_report(catalog: DataFrame, constraints: dict[str, str] | None = None) -> DataFrame:
    """``rule, bad_rows`` of every check, in one pass."""
    rules = constraints or CONSTRAINTS
    counts = catalog.agg(*[F.count_if(F.expr(f"not coalesce({test}, true)")).alias(name) for name, test in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("bad_rows")) for n in rules])).alias("r")
    return counts.select(pairs).select("r.*")


def inspect(catalog: DataFrame) -> DataFrame:
    """One row of counts and clocks for the whole catalog."""
    bad = reduce(lambda a, b: a | b, [~F.coalesce(F.col("document_key").rlike(DOCUMENT_KEY), F.lit(False)), ~F.coalesce(F.col("product_version_key").rlike(PRODUCT_KEY), F.lit(False))])
    return catalog.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("identity_version") == KEY_VERSION).alias("current_identity"),
        F.count_if(~F.equal_null(F.col("identity_version"), F.lit(KEY_VERSION).cast("smallint"))).alias("unsupported_identity"),
        F.count_if(bad).alias("bad_keys"),
        F.count_if(F.col("sha256").isNotNull() & ~F.col("sha256").rlike(SHA256)).alias("bad_sha256"),
        F.count_if((F.col("file_status") == "AVAILABLE") & F.col("sha256").isNull()).alias("available_without_sha256"),
        F.min("last_seen_at").alias("first_seen_at"),
        F.max("last_seen_at").alias("last_seen_at"),
    )


def status_pairs(catalog: DataFrame) -> DataFrame:
    """Documents by file state and last attempt."""
    return catalog.groupBy("file_status", F.coalesce("last_attempt_status", F.lit("NONE")).alias("last_attempt_status")).agg(F.count("*").alias("documents"))


def company_counts(catalog: DataFrame) -> DataFrame:
    """Documents of each company, and how many of them have their file."""
    return catalog.groupBy("company_code").agg(F.count("*").alias("documents"), F.count_if(F.col("file_status") == "AVAILABLE").alias("available"))


def point_lookup(catalog: DataFrame, key: str) -> DataFrame:
    """The catalog row of one document, or none."""
    return catalog.where(F.col("document_key") == key).limit(1)


def bulk_lookup(keys: DataFrame, catalog: DataFrame) -> DataFrame:
    """``keys(document_key, ...)`` with the catalog row of each as ``row``, and whether there is one."""
    known = catalog.select("document_key", F.struct(*catalog.columns).alias("row"))
    return keys.join(known, "document_key", "left").withColumn("found", F.col("row").isNotNull())


def store(catalog: DataFrame, path: str) -> None:
    """The catalog filed by company, so that a company's documents are read without the others'."""
    catalog.write.mode("overwrite").partitionBy("company_code").parquet(path)


def of_company(spark: SparkSession, path: str, code: str) -> DataFrame:
    """A stored catalog's documents of one company; only its folder is read."""
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("company_code") == code)


def record_payloads(records: DataFrame) -> DataFrame:
    """Collected records as the columns of catalog events: ``record_id, operation`` and what the record says, blank texts being null.

    Where a record is silent its version speaks, whose columns begin with ``version_``, or its document (``link_``). Columns that the
    table lacks count as blank. File state, and with it run id and clock of the download, follow from the attempt and its evidence.
    """

    def said(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.trim(F.col(n).cast("string")), F.lit("")) for n in names if n in records.columns], F.lit(None).cast("string"))

    def own(name: str) -> Column:
        return said(name, f"version_{name}", f"link_{name}")

    attempt, path, digest, run = F.upper(said("download_status")), said("saved_relative_path"), F.lower(said("sha256")), said("run_id")
    state = proven_file_state(F.coalesce(attempt, F.lit("")), path, digest)
    name = own("product_name_raw")
    told = {
        "document_key": said("document_key"), "product_version_key": said("product_version_key"), "company_code": own("company_code"), "company_name": own("company_name"), "product_category": own("product_category"),
        "source_product_id": own("source_product_id"), "product_name": name, "product_name_normalized": F.coalesce(said("product_name_normalized"), name),
        "sale_status": sale_state(said("normalized_sale_status", "sale_status", "version_normalized_sale_status")), "sale_status_raw": said("source_sale_status", "sale_status", "version_sale_status"),
        "sale_start_date": parse_date(own("sale_start_date")), "sale_end_date": parse_date(own("sale_end_date")), "status_missing_count": F.coalesce(said("status_missing_count").try_cast("int"), F.lit(0)),
        "document_date": parse_date(own("target_date")), "document_date_basis": own("date_basis"), "document_type": own("document_type"), "document_label": own("document_label"), "source_page_url": own("source_page_url"),
        "document_url": own("document_url"), "original_filename": own("original_filename"), "saved_relative_path": path, "file_size": F.nullif(said("file_size").try_cast("bigint"), F.lit(0)), "sha256": digest, "file_status": state,
        "last_attempt_status": attempt, "error_message": said("error_message"), "downloaded_at": F.try_to_timestamp(only_if_available(state, said("downloaded_at"))), "last_seen_run_id": run,
        "last_download_run_id": only_if_available(state, run), "last_status_run_id": said("status_run_id"), "identity_version": F.lit(KEY_VERSION).cast("smallint"),
    }
    return records.select("record_id", F.when(attempt.isNull(), "upsert_seen").otherwise("upsert_result").alias("operation"), *[c.alias(n) for n, c in told.items()])
