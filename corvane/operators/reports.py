"""Counts and summaries of runs, plans, pages and outboxes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.operators.numbering import numbered_at_scale

from corvane.functions.status import RETRYABLE

KINDS = ("POLICY", "SUMMARY", "METHOD")
PAGE_STATES = ("TEXT", "OCR_REQUIRED", "EMPTY")


def status_counts(records: DataFrame, company: str = "company_code", status: str = "download_status") -> DataFrame:
    """Records by company and state, with a total row (null company) of each state."""
    return records.groupBy(company, status).agg(F.count("*").alias("n")).unionByName(
        records.groupBy(status).agg(F.count("*").alias("n")).withColumn(company, F.lit(None).cast("string"))
    )


def kind_counts(documents: DataFrame, kind: str = "document_type") -> DataFrame:
    return documents.where(F.trim(kind) != "").groupBy(kind).agg(F.count("*").alias("n"))


def missing_kinds(documents: DataFrame, version: list[str], by: list[str]) -> DataFrame:
    """For each of ``by``, how many versions lack a linked document of each kind.

    ``documents`` has a row for every document, and one with nulls for a version without any.
    """
    held = documents.groupBy(*dict.fromkeys([*by, *version])).agg(*[F.coalesce(F.bool_or((F.col("document_type") == k) & F.col("linked")), F.lit(False)).alias(k) for k in KINDS])
    return held.groupBy(*by).agg(F.count("*").alias("versions"), *[F.count_if(~F.col(k)).alias(f"missing_{k.lower()}") for k in KINDS])


def held_kinds(documents: DataFrame, version: list[str], by: list[str]) -> DataFrame:
    """Versions, documents of each kind and versions that lack a linked one, for each of ``by``: one pass over ``documents`` as above."""
    ours = lambda k: F.col("document_type") == k
    per_version = [x for k in KINDS for x in (F.coalesce(F.bool_or(ours(k) & F.col("linked")), F.lit(False)).alias(k), F.count_if(ours(k)).alias(f"n_{k}"))]
    held = documents.groupBy(*dict.fromkeys([*by, *version])).agg(*per_version)
    told = [x for k in KINDS for x in (F.count_if(~F.col(k)).alias(f"missing_{k.lower()}"), F.sum(f"n_{k}").alias(f"{k.lower()}_documents"))]
    return held.groupBy(*by).agg(F.count("*").alias("versions"), *told)


def product_counts(versions: DataFrame) -> DataFrame:
    """Products of each company by name and id, either of which may be missing."""
    return versions.groupBy("company_code").agg(F.count_distinct(F.struct("product_name", "source_product_id")).alias("products"))


def link_counts(documents: DataFrame) -> DataFrame:
    """Linked documents and those whose download may be tried again, by company."""
    return documents.groupBy("company_code").agg(F.count_if("linked").alias("links"), F.count_if(F.col("download_status").isin(*RETRYABLE)).alias("retryable"))


def run_roll(companies: DataFrame) -> DataFrame:
    """``companies(company_code, outcome, records)`` -> one row: totals, who was locked or failed, and the run's state."""
    named = lambda outcome: F.sort_array(F.collect_list(F.when(F.col("outcome") == outcome, F.col("company_code"))))
    one = companies.agg(F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"), named("LOCKED").alias("locked"), named("FAILED").alias("failed"), F.count("*").alias("companies"))
    bad = F.size("locked") + F.size("failed")
    state = F.when(bad == 0, "SUCCESS").when(F.size("locked") == F.col("companies"), "LOCKED").when(bad == F.col("companies"), "FAILED").otherwise("PARTIAL_SUCCESS")
    return one.withColumn("run_status", state)


def outbox_summary(events: DataFrame, failures: DataFrame) -> DataFrame:
    """Pending events and failures by kind as rows ``what, n``."""
    pending = events.agg(F.count("*").alias("n")).select(F.lit("pending").alias("what"), "n")
    return pending.union(failures.groupBy(F.concat(F.lit("failure:"), F.col("failure_kind")).alias("what")).agg(F.count("*").alias("n")))


def event_previews(events: DataFrame) -> DataFrame:
    """Each event's operation, its number of keys and the first ten, cut to twelve characters. ``keys`` is a list column."""
    return events.select("event_id", "operation", F.size("keys").alias("rows"), F.transform(F.slice("keys", 1, 10), lambda k: F.substring(k, 1, 12)).alias("first_keys"))


def monthly_index(plan: DataFrame) -> DataFrame:
    """Plan keys of each month in arrival order, and their number. A month is one row; ``write_by_month`` files months of any size."""
    return plan.groupBy("month").agg(F.count("*").alias("items"), F.transform(F.array_sort(F.collect_list(F.struct("ingest_seq", "plan_key"))), lambda x: x["plan_key"]).alias("plan_keys"))


def monthly_keys(plan: DataFrame) -> DataFrame:
    """The same index as rows ``month, place, plan_key``, places from 1 in arrival order, for months of any size."""
    return numbered_at_scale(plan.select("month", "ingest_seq", "plan_key"), "month", ["ingest_seq"], "place").select("month", "place", "plan_key")


def monthly_counts(plan: DataFrame) -> DataFrame:
    """Plan items of each month."""
    return plan.groupBy("month").agg(F.count("*").alias("items"))


def page_counts(pages: DataFrame) -> DataFrame:
    """Pages of each document by state, and which ones need reading by OCR or are empty."""
    listed = lambda s: F.sort_array(F.collect_list(F.when(F.col("page_status") == s, F.col("page_no"))))
    return pages.groupBy("doc_id").agg(
        F.count("*").alias("pages"), *[F.count_if(F.col("page_status") == s).alias(f"{s.lower()}_pages") for s in PAGE_STATES], listed("OCR_REQUIRED").alias("ocr_page_nos"), listed("EMPTY").alias("empty_page_nos")
    )


def document_states(counts: DataFrame, warnings: DataFrame, core: tuple[str, ...]) -> DataFrame:
    """A document's state from its page counts and the codes of its warnings."""
    codes = warnings.groupBy("doc_id").agg(F.max(F.col("code").isin(*core)).alias("core_warning"))
    ocr, text = F.col("ocr_required_pages") > 0, F.col("text_pages") > 0
    state = F.when(ocr & text, "PARTIAL").when(ocr | ~text, "OCR_REQUIRED").when(F.coalesce("core_warning", F.lit(False)), "PARTIAL").otherwise("SUCCEEDED")
    return counts.join(codes, "doc_id", "left").select("doc_id", state.alias("status"))


def load_status(documents: DataFrame) -> DataFrame:
    """The state of a load from those of its documents, as one row."""
    one = documents.agg(F.count("*").alias("documents"), *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("SUCCEEDED", "PARTIAL", "OCR_REQUIRED", "FAILED")])
    n = F.col("documents")
    return one.withColumn("run_status", F.when(n == F.col("failed"), "FAILED").when(n == F.col("succeeded"), "SUCCEEDED").when(n == F.col("ocr_required"), "OCR_REQUIRED").otherwise("PARTIAL"))


def load_manifest(pages: DataFrame, tables: DataFrame, images: DataFrame, warnings: DataFrame) -> DataFrame:
    """Counters of each document: pages by state and size, tables by verdict, images, warnings."""
    p = pages.groupBy("doc_id").agg(
        F.count("*").alias("pages"), *[F.count_if(F.col("page_status") == s).alias(f"{s.lower()}_pages") for s in PAGE_STATES], F.sum("characters").alias("characters"), F.sum("words").alias("words")
    )
    t = tables.groupBy("doc_id").agg(F.count("*").alias("tables"), *[F.count_if(F.col("status") == s).alias(f"{s.lower()}_tables") for s in ("MEANINGFUL", "FRAGMENT", "REJECTED")])
    i = images.groupBy("doc_id").agg(F.count("*").alias("images"), F.count_distinct("sha256").alias("distinct_images"))
    w = warnings.groupBy("doc_id").agg(F.count("*").alias("warnings"))
    out = p.join(t, "doc_id", "left").join(i, "doc_id", "left").join(w, "doc_id", "left")
    return out.na.fill(0, [c for c in out.columns if c != "doc_id"])


def reconstruction_counts(tables: DataFrame) -> DataFrame:
    """Tables by how their reconstruction ended."""
    return tables.agg(
        F.count("*").alias("tables"), F.count_if("requested").alias("requested"), F.count_if(F.col("final_status") == "SUCCEEDED").alias("succeeded"), F.count_if(F.col("final_status") == "FALLBACK").alias("fallback"), F.count_if(~F.col("requested")).alias("skipped")
    )


def dedup_statistics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and what a dedup takes away, by company, as one pass of partial sums."""
    per_key = rows.groupBy("company_code", *keys).agg(F.count("*").alias("n"), F.max(F.col("target_date").isNull().cast("int")).alias("undated"))
    return per_key.groupBy("company_code").agg(F.sum("n").alias("raw"), F.count("*").alias("deduped"), (F.sum("n") - F.count("*")).alias("duplicates"), F.sum("undated").alias("undated"))


def company_listing(companies: DataFrame, registry: DataFrame) -> DataFrame:
    """All companies, whether there is a rule set for them, and whether a run may take them."""
    known = registry.select("code").distinct().withColumn("registered", F.lit(True))
    out = companies.join(known, "code", "left").withColumn("registered", F.coalesce("registered", F.lit(False)))
    return out.withColumn("runnable", F.col("registered") & (F.col("collection_status") == "ACTIVE"))
