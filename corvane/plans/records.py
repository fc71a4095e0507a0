"""Questions about plans, change events, the catalog, reconciliation, pages, tables and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import cells, responses, text
from corvane.operators import catalog, joins, ordering, pages, reconcile, reports, selection, tables
from corvane.plans import bind
from corvane.plans.bind import SQL, table
from corvane.sources import payloads
from corvane.streaming import events as streams

_E, _P, _C = SQL["e"], SQL["p"], SQL["c"]


# Plans and logs.


def pending_plan(spark, sf):
    p = bind.plan(spark, sf)
    state = ordering.last_wins(p, ["dedupe_key"]).select("plan_key", "download_status", "saved_relative_path")
    files = table(spark, sf, "customer").where("c_custkey % 4 <> 0").select(F.concat(F.lit("files/"), F.col("c_custkey").cast("string")).alias("saved_relative_path"))
    return joins.pending_items(p.select("plan_key", "month"), state, files).groupBy("month").agg(F.count("*").alias("pending"))


def orphan_states(spark, sf):
    p = bind.plan(spark, sf)
    return joins.orphans(p.select("plan_key", "dedupe_key", "month"), p.where("ingest_seq % 10 <> 3").select("plan_key", "dedupe_key")).groupBy("month").agg(F.count("*").alias("orphans"))


def latest_downloads(spark, sf):
    return ordering.latest_by_clock(bind.plan(spark, sf), ["dedupe_key"], "updated_at").select("dedupe_key", "plan_key", "download_status")


def monthly_index(spark, sf):
    return reports.monthly_index(bind.plan(spark, sf)).select("month", "items", F.sha2(F.array_join("plan_keys", ","), 256).alias("keys_digest"))


def monthly_keys(spark, sf):
    return reports.monthly_keys(bind.plan(spark, sf))


def monthly_counts(spark, sf):
    return reports.monthly_counts(bind.plan(spark, sf))


def plan_status_counts(spark, sf):
    p = bind.plan(spark, sf).withColumn("company_code", F.concat(F.lit("C"), F.substring("dedupe_key", 1, 1)))
    return reports.status_counts(p)


def retried(spark, sf):
    p = bind.plan(spark, sf)
    previous = ordering.last_wins(p, ["dedupe_key"]).select("dedupe_key", "download_status", (F.col("ingest_seq") % 3 != 0).alias("file_ok"))
    return selection.retry_selection(p.select("dedupe_key", "month"), previous, "dedupe_key").groupBy("previous_status", "retried").agg(F.count("*").alias("n"))


def changed_plans(spark, sf):
    p = bind.plan(spark, sf).select("plan_key", "month", "download_status")
    after = p.withColumn("download_status", F.when(F.col("month") < "1996-01", F.lit("SUCCESS")).otherwise(F.col("download_status")))
    return selection.changed_rows(p, after, "plan_key").groupBy("month").agg(F.count("*").alias("changed"))


def run_roll(spark, sf):
    c = bind.companies(spark, sf)
    n = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("records"))
    outcome = F.when(F.col("collection_status") == "DISABLED", "LOCKED").when(F.col("collection_status") == "ACCESS_RESTRICTED", "FAILED").otherwise("SUCCESS")
    one = reports.run_roll(c.join(n, "nation", "left").select(F.col("code").alias("company_code"), outcome.alias("outcome"), F.coalesce("records", F.lit(0)).alias("records")))
    return one.select("total_records", F.array_join("locked", ",").alias("locked"), F.array_join("failed", ",").alias("failed"), "run_status")


# Change events and the catalog.


def _catalog_events(spark, sf):
    e = bind.changes(spark, sf)
    done = F.col("attempt_status") == "SUCCESS"
    named = {
        "seq": F.col("seq"), "operation": F.col("operation"), "document_key": F.col("document_key"), "company_code": F.lit("A"), "product_version_key": F.lit("PROD_VER_0000000000"), "product_name": F.col("event_type"),
        "last_seen_run_id": F.concat(F.lit("s"), F.col("event_id").cast("string")), "last_seen_at": F.col("seen_at"), "sale_status": F.when(F.col("value") > 50, "ENDED").otherwise("ACTIVE"), "status_checked_at": F.col("checked_at"),
        "status_missing_count": (F.col("event_id") % 4).cast("int"), "document_label": F.when(F.col("event_id") % 2 == 0, F.col("event_type")), "document_type": F.lit("POLICY"), "document_url": F.lit("u"),
        "file_status": F.when(done, "AVAILABLE").when(F.col("attempt_status") == "DRY_RUN", "PENDING").otherwise("INVALID"), "sha256": F.when(done, F.sha2(F.col("event_id").cast("string"), 256)), "file_size": F.col("event_id"),
        "last_attempt_status": F.col("attempt_status"), "last_attempt_at": F.col("attempt_at"), "downloaded_at": F.when(done, F.col("attempt_at")), "last_download_run_id": F.when(done, F.concat(F.lit("d"), F.col("event_id").cast("string"))),
        "last_status_run_id": F.when(F.col("event_id") % 2 == 1, F.concat(F.lit("t"), F.col("event_id").cast("string"))), "identity_version": F.lit(4).cast("smallint"),
        "source_metadata": F.create_map(F.lit("checkpoint_key"), F.lit("k"), F.when(F.col("event_id") % 2 == 0, "migration").otherwise("final_url"), F.col("event_id").cast("string")),
    }
    kinds = dict(part.split(" ", 1) for part in catalog.SCHEMA.split(", "))
    rest = {c: F.lit(None).cast(kinds[c]) for c in catalog.COLUMNS if c not in named}
    return e.select(*[c.alias(n) for n, c in (named | rest).items()])


def _catalog(spark, sf):
    return catalog.merge_events(spark.createDataFrame([], catalog.SCHEMA), _catalog_events(spark, sf))


def catalog_states(rows):
    """The columns of catalog rows that events set, as they are compared with SQL's."""
    clock = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return rows.select(
        "document_key", "product_name", "last_seen_run_id", clock("last_seen_at"), "sale_status", clock("status_checked_at"), "status_missing_count", "document_label", "file_status", "sha256", "file_size",
        "last_attempt_status", clock("last_attempt_at"), clock("downloaded_at"), "last_download_run_id", "last_status_run_id", F.try_element_at("source_metadata", F.lit("migration")).alias("migration"), F.try_element_at("source_metadata", F.lit("final_url")).alias("final_url"),
    )


def merged_catalog(spark, sf):
    """Events out of order, merged into the latest state of each document."""
    return catalog_states(_catalog(spark, sf))


def catalog_report(spark, sf):
    return catalog.constraint_report(_catalog(spark, sf))


def catalog_overview(spark, sf):
    return catalog.inspect(_catalog(spark, sf)).select("row_count", "current_identity", "unsupported_identity", "bad_keys", "bad_sha256", "available_without_sha256")


def _faulty_catalog(spark, sf):
    """Catalog rows, one for each event, with faults that follow from its number."""
    n = F.col("event_id")
    faults = {
        "document_key": F.when(n % 11 == 0, "DOC_1").otherwise(F.col("document_key")), "product_version_key": F.when(n % 13 == 0, "PROD_VER_").otherwise("PROD_VER_0000000000"), "identity_version": F.when(n % 17 == 0, 3).otherwise(4).cast("smallint"),
        "sha256": F.when(n % 19 == 0, "zz").when(n % 19 == 1, None).otherwise(F.sha2(n.cast("string"), 256)), "status_missing_count": F.when(n % 23 == 0, -1).otherwise(0), "file_size": F.when(n % 29 == 0, -5).otherwise(n), "sale_status": F.when(n % 31 == 0, "SOLD").otherwise("ACTIVE"),
        "file_status": F.when(n % 37 == 0, "LOST").otherwise("AVAILABLE"), "document_type": F.when(n % 41 == 0, "OTHER").otherwise("POLICY"), "sale_start_date": F.to_date("ts"), "sale_end_date": F.date_add(F.to_date("ts"), F.when(n % 43 == 0, -1).otherwise(1)),
    }
    kinds = dict(part.split(" ", 1) for part in catalog.SCHEMA.split(", "))
    e = bind.changes(spark, sf)
    return e.select(*[faults.get(c, F.lit(None).cast(kinds[c])).alias(c) for c in catalog.COLUMNS])


def catalog_violations(spark, sf):
    """How many rows of a catalog with faults break each rule."""
    return catalog.constraint_report(_faulty_catalog(spark, sf))


def catalog_faults(spark, sf):
    """Counts over a catalog with faults."""
    return catalog.inspect(_faulty_catalog(spark, sf)).select("row_count", "current_identity", "unsupported_identity", "bad_keys", "bad_sha256", "available_without_sha256")


def catalog_status_pairs(spark, sf):
    return catalog.status_pairs(_catalog(spark, sf))


def status_update_outcomes(spark, sf):
    base = _catalog(spark, sf)
    e = bind.changes(spark, sf).where("event_id % 2 = 1")
    late = e.select("seq", F.when(F.col("event_id") % 9 == 1, F.concat(F.lit("DOC_x"), F.col("event_id").cast("string"))).otherwise(F.col("document_key")).alias("document_key"), F.coalesce("checked_at", "seen_at").alias("status_checked_at"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("last_status_run_id"))
    kinds = dict(part.split(" ", 1) for part in catalog.SCHEMA.split(", "))
    fill = [F.lit(None).cast(kinds[c]).alias(c) for c in catalog.STATUS if c != "status_checked_at"]
    _, outcome = catalog.apply_status_updates(base, late.select("*", *fill, F.lit(None).cast("string").alias("saved_relative_path")))
    return outcome


def all_status_updates(spark, sf):
    """The outcomes of one status update for each event."""
    e = bind.changes(spark, sf)
    late = e.select("seq", F.when(F.col("event_id") % 9 == 1, F.concat(F.lit("DOC_x"), F.col("event_id").cast("string"))).otherwise(F.col("document_key")).alias("document_key"), F.coalesce("checked_at", "seen_at").alias("status_checked_at"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("last_status_run_id"))
    kinds = dict(part.split(" ", 1) for part in catalog.SCHEMA.split(", "))
    fill = [F.lit(None).cast(kinds[c]).alias(c) for c in catalog.STATUS if c != "status_checked_at"]
    return catalog.apply_status_updates(_catalog(spark, sf), late.select("*", *fill, F.lit(None).cast("string").alias("saved_relative_path")))[1]


def identity_collisions(spark, sf):
    e = _catalog_events(spark, sf).withColumn("source_product_id", F.when(F.col("seq") % 100 == 7, "other").otherwise("same"))
    return catalog.identity_collisions(spark.createDataFrame([], catalog.SCHEMA), e)


def pending_events(spark, sf):
    e = bind.changes(spark, sf)
    left = joins.pending_events(e, e.where("event_type = 'view'").select("event_id"), e.where("event_id % 13 = 0").select("event_id"))
    return left.groupBy("operation", "event_type").agg(F.count("*").alias("pending"))


def compacted(spark, sf):
    e = bind.changes(spark, sf)
    return streams.compact(e, e.where("event_type <> 'error'").select("event_id"))[1]


def failures(spark, sf):
    e = bind.changes(spark, sf).withColumn("failure_kind", F.when(F.col("event_id") % 3 == 0, "transient").when(F.col("event_id") % 3 == 1, "permanent"))
    return streams.failures_by_kind(e)


def absent_versions(spark, sf):
    e = bind.changes(spark, sf)
    runs = e.groupBy(F.col("document_key").alias("key"), F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("run")).agg(F.bool_or(F.col("event_type") == "purchase").alias("found"), F.bool_and(F.col("event_id") % 11 != 0).alias("complete"))
    return streams.absences(runs)


def reconciled(spark, sf, last_day=False):
    """States of documents against a day's sightings, and what a run does about it. ``last_day``: the sightings are all events of the last day that each document has any."""
    e = bind.changes(spark, sf)
    rows = ordering.first_wins(e, ["document_key"], "seq").select(
        F.col("document_key").alias("key"), F.col("seq").alias("ingest_seq"), F.concat(F.lit("C"), F.substring("document_key", 14, 1)).alias("company_code"), F.when(F.col("event_type") == "error", "ENDED").otherwise("ACTIVE").alias("state"),
        (F.col("event_id") % 2).cast("int").alias("status_missing_count"), F.concat(F.lit("r/판매중__"), F.col("document_key"), F.lit("/f.pdf")).alias("saved_relative_path"), F.lit("f.pdf").alias("saved_filename"),
    )
    if last_day:
        latest = e.groupBy("document_key").agg(F.max(F.to_date("ts")).alias("_day"))
        sighted = e.join(latest, "document_key").where((F.to_date("ts") == F.col("_day")) & (F.col("event_type") != "error"))
    else:
        sighted = e.where("event_type in ('view', 'signup') and event_id % 40 = 0")
    seen = sighted.select(F.col("document_key").alias("key"), F.when(F.col("value") > 40, "ENDED").otherwise("ACTIVE").alias("state"), F.col("event_type").alias("raw_status"), F.when(F.col("event_id") % 3 == 0, F.to_date("ts")).alias("sale_end_date"), "seq")
    coverage = rows.select("company_code").distinct().withColumn("complete", ~F.col("company_code").isin("C3", "C4"))
    return rows, reconcile.decisions(rows, reconcile.observations(seen), coverage)


def reconcile_stats(spark, sf):
    return reconcile.stats(reconciled(spark, sf)[1])


def reconcile_actions(spark, sf):
    return reconcile.actions(reconciled(spark, sf)[1]).select("key", "old_state", "new_state", "old_path", "new_path", "reason", "sale_end_date", "raw_status", "move_required", "missing_count")


def reconciled_rows(spark, sf):
    rows, decided = reconciled(spark, sf)
    return reconcile.updated_rows(rows, decided).select("key", "state", "status_missing_count", "saved_relative_path", "status_check_result")


def all_reconcile_stats(spark, sf):
    """The same where a run sees all that happened on each document's last day."""
    return reconcile.stats(reconciled(spark, sf, last_day=True)[1])


def all_reconcile_actions(spark, sf):
    return reconcile.actions(reconciled(spark, sf, last_day=True)[1]).select("key", "old_state", "new_state", "old_path", "new_path", "reason", "sale_end_date", "raw_status", "move_required", "missing_count")


def all_reconciled_rows(spark, sf):
    rows, decided = reconciled(spark, sf, last_day=True)
    return reconcile.updated_rows(rows, decided).select("key", "state", "status_missing_count", "saved_relative_path", "status_check_result")


# Pages, links, tables, images, responses.


def links(spark, sf):
    found = payloads.html_links(table(spark, sf, "pages"))
    return found.select("page_id", "pos", "href", "label")


def link_targets(spark, sf):
    """Links as whole addresses; where the base has no path or the link odd signs SQL has no rule, so addresses are counted by host and depth."""
    found = payloads.html_links(table(spark, sf, "pages"))
    safe = text.scrub_url(F.col("url"))
    return found.groupBy(F.regexp_extract(safe, r"^https?://([^/]*)", 1).alias("host")).agg(F.count("*").alias("links"), F.count_distinct("href").alias("targets"))


def carried_types(spark, sf):
    e = bind.changes(spark, sf)
    down = ordering.carried_down(e, ["document_key"], "seq", F.col("event_type") == "signup", F.col("event_id"), "section")
    return down.groupBy("section").agg(F.count("*").alias("rows"))


def repeated_page_lines(spark, sf):
    p = bind.text_pages(spark, sf)
    zones = pages.first_and_last_lines(p.select(F.struct("source", "page_no").alias("at"), "text"), "at", "text")
    told = zones.select(F.col("at.source").alias("doc_id"), F.col("at.page_no").alias("page_no"), "location", F.trim(F.regexp_replace(F.lower("line"), r"\s+", " ")).alias("key"))
    return pages.repeated_lines(told, p.groupBy(F.col("source").alias("doc_id")).agg(F.count("*").alias("pages")), share=0.1)


def page_statuses(spark, sf):
    p = bind.text_pages(spark, sf).withColumn("characters", pages.meaningful_characters(F.col("text")))
    p = p.withColumn("page_status", pages.page_status(F.when(F.col("doc_id") % 17 == 0, 0).otherwise(F.col("characters")), F.when(F.col("doc_id") % 2 == 0, 0.9).otherwise(0.1), F.col("doc_id") % 5 == 0, F.col("doc_id") % 50 == 0))
    counts = reports.page_counts(p.withColumnRenamed("doc_id", "page_id").withColumnRenamed("source", "doc_id"))
    warnings = p.where("doc_id % 23 = 0").select(F.col("source").alias("doc_id"), F.lit("TABLE_FAILED").alias("code"))
    return counts.join(reports.document_states(counts, warnings, ("TABLE_FAILED",)), "doc_id").select("doc_id", "pages", "text_pages", "ocr_required_pages", "empty_pages", F.array_join(F.transform("ocr_page_nos", lambda x: x.cast("string")), ",").alias("ocr"), F.array_join(F.transform("empty_page_nos", lambda x: x.cast("string")), ",").alias("empty"), "status")


def table_metrics(spark, sf):
    t = bind.cell_tables(spark, sf).withColumn("m", cells.metrics(F.col("rows")))
    verdict = cells.assess(F.col("rows"), F.col("m"))
    return t.select("conv_id", "m.*", verdict["status"].alias("status"), verdict["reason"].alias("reason"), cells.representation(F.col("rows"), F.lit(False)).alias("representation"))


def table_texts(spark, sf):
    t = bind.cell_tables(spark, sf)
    return t.select("conv_id", F.sha2(cells.text_fingerprint(F.col("rows")), 256).alias("fingerprint"), F.length(cells.markdown(cells.clean_rows(F.col("rows")))).alias("markdown_chars"))


def word_differences(spark, sf):
    """How the words of a conversation's user and assistant differ as multisets."""
    c = table(spark, sf, "conversations").select("conv_id", "role", F.explode(F.split(F.regexp_replace("text", r"\s+", " "), " ")).alias("token"))
    diff = joins.multiset_difference(c.where("role = 'user'"), c.where("role = 'assistant'"), ["conv_id"], "token")
    return diff.groupBy("conv_id").agg(F.sum("missing").alias("missing"), F.sum("added").alias("added"))


def _images(spark, sf):
    return table(spark, sf, "documents").select(F.col("lang").alias("doc_id"), F.col("doc_id").cast("int").alias("page_no"), F.sha2("text", 256).alias("sha256"), F.col("doc_id").alias("image_id"), *[F.lit(0.0).alias(c) for c in ("x0", "top", "x1", "bottom")])


def image_occurrences(spark, sf):
    """Every occurrence of an image as a row."""
    return pages.image_occurrences(_images(spark, sf)).select("doc_id", "sha256", "image_id", "occurrence_no", "page_no")


def distinct_images(spark, sf):
    return pages.unique_images(_images(spark, sf)).select("doc_id", "sha256", "image_id", "occurrence_count", F.array_join(F.transform("occurrences", lambda o: o["page_no"].cast("string")), ",").alias("page_nos"))


def response_checks(spark, sf):
    r = bind.responses(spark, sf)
    c = responses.check_response(F.col("status_code"), F.col("content_type"), F.col("extension"), F.col("body"))
    return r.select("response_id", c["ok"].alias("ok"), c["status"].alias("status"), c["reason"].alias("reason"))


def stored_checks(spark, sf):
    d = bind.responses(spark, sf).where("response_id like 'd%'")
    size = F.when(F.octet_length("body") % 10 == 3, F.octet_length("body") + 1).otherwise(F.octet_length("body"))
    c = responses.check_stored(F.col("body"), size, F.col("extension"))
    return d.groupBy(c["ok"].alias("ok"), c["reason"].alias("reason")).agg(F.count("*").alias("n"))


def attempt_selection(spark, sf):
    """Turns of a conversation as attempts to rebuild its first one; answers of fewer than 40 words are bad."""
    c = table(spark, sf, "conversations")
    told = c.select(F.col("conv_id").cast("string").alias("table_id"), (F.col("turn") + 1).cast("int").alias("attempt_no"), F.col("text").alias("source_markdown"), F.col("text").alias("response_markdown"), F.when(F.regexp_count("text", F.lit(" ")) < 40, "SHORT").alias("code"))
    return tables.selected_attempts(told).select("table_id", "attempts", "selected_attempt", "final_status", F.length("final_markdown").alias("chars"))


def decoded_payloads(spark, sf):
    """Whole pages in the encodings of sites, decoded."""
    return payloads.decoded(bind.encoded_pages(spark, sf)).select("page_id", "charset", "replaced", "text")


def decoded_documents(spark, sf):
    """All texts as UTF-8 bytes whose header says so, says nothing, or names an encoding that nobody knows."""
    header = F.when(F.col("doc_id") % 3 == 0, "text/html; charset=UTF-8").when(F.col("doc_id") % 3 == 1, "text/html").otherwise("text/html; charset=x-none")
    bodies = table(spark, sf, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("body"), header.alias("content_type"))
    return payloads.decoded(bodies).select("doc_id", "charset", "replaced", F.sha2("text", 256).alias("text_sha256"))


def union_of_channels(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    both = joins.union_tabs({"on_sale": o.where("o_orderstatus = 'O'"), "ended": o.where("o_orderstatus = 'F'")})
    return both.groupBy("tab_status").agg(F.count("*").alias("n"))


def missing_companies(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))
    return joins.missing_values(s.where("nation % 3 <> 0"), bind.companies(spark, sf).select("nation"), "nation")


QUERIES = {
    f.__name__: f
    for f in (
        pending_plan, orphan_states, latest_downloads, monthly_index, monthly_keys, image_occurrences, monthly_counts, all_status_updates, all_reconcile_stats, all_reconcile_actions, all_reconciled_rows, plan_status_counts, retried, changed_plans, run_roll, merged_catalog, catalog_report, catalog_overview, catalog_violations, catalog_faults, catalog_status_pairs, status_update_outcomes, identity_collisions,
        pending_events, compacted, failures, absent_versions, reconcile_stats, reconcile_actions, reconciled_rows, links, link_targets, carried_types, repeated_page_lines, page_statuses, table_metrics, table_texts, word_differences,
        distinct_images, response_checks, stored_checks, attempt_selection, decoded_payloads, decoded_documents, union_of_channels, missing_companies,
    )
}

_K = f"""{_E},
k AS (
  SELECT *, row_number() OVER (PARTITION BY document_key ORDER BY seq) = 1 AS base, operation = 'upsert_result' AS result, CASE WHEN operation = 'upsert_result' THEN attempt_at END AS tried_at, attempt_status = 'SUCCESS' AS done FROM e
),
n AS (
  SELECT *, base OR coalesce(seen_at >= max(seen_at) OVER w OR max(seen_at) OVER w IS NULL, false) AS ns,
    base OR (result AND coalesce(max(CASE WHEN result OR base THEN tried_at END) OVER w IS NULL OR tried_at >= max(CASE WHEN result OR base THEN tried_at END) OVER w, false)) AS na
  FROM k WINDOW w AS (PARTITION BY document_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
f AS (
  SELECT *, base OR (ns AND coalesce(max(CASE WHEN ns THEN checked_at END) OVER w IS NULL OR checked_at >= max(CASE WHEN ns THEN checked_at END) OVER w, false)) AS st, base OR (result AND (na OR ns)) AS told
  FROM n WINDOW w AS (PARTITION BY document_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
g AS (
  SELECT document_key, arg_max(event_type, seq) FILTER (ns) AS product_name, 's' || arg_max(event_id, seq) FILTER (ns) AS last_seen_run_id, arg_max(seen_at, seq) FILTER (ns) AS last_seen_at,
    arg_max(CASE WHEN value > 50 THEN 'ENDED' ELSE 'ACTIVE' END, seq) FILTER (st) AS sale_status, arg_max_null(checked_at, seq) FILTER (st) AS status_checked_at, arg_max(event_id % 4, seq) FILTER (st) AS status_missing_count,
    arg_max(event_type, seq) FILTER (told AND event_id % 2 = 0) AS document_label, arg_max(attempt_status, seq) FILTER (na) AS last_attempt_status, arg_max_null(tried_at, seq) FILTER (na) AS last_attempt_at,
    max(CASE WHEN done THEN attempt_at END) FILTER (told) AS downloaded_at, 'd' || arg_max(event_id, seq) FILTER (na AND done) AS last_download_run_id, 't' || arg_max(event_id, seq) FILTER ((base OR (result AND st)) AND event_id % 2 = 1) AS last_status_run_id,
    arg_max(event_id, seq) FILTER (na AND (base OR attempt_status <> 'DRY_RUN')) AS real_id, arg_max(event_id, seq) FILTER (na) AS any_id, arg_min(event_id, seq) FILTER (ns AND event_id % 2 = 0) AS migration, arg_max(event_id, seq) FILTER (ns AND event_id % 2 = 1) AS final_url
  FROM f GROUP BY document_key
),
cat AS (
  SELECT g.*, x.event_id AS file_id, x.done, CASE WHEN x.done THEN 'AVAILABLE' WHEN x.attempt_status = 'DRY_RUN' THEN 'PENDING' ELSE 'INVALID' END AS file_status
  FROM g JOIN e r ON r.event_id = real_id JOIN k x ON x.event_id = CASE WHEN r.attempt_status = 'SUCCESS' THEN real_id ELSE any_id END
)"""
_R = f"""{_E},
r AS (
  SELECT document_key AS key, seq, 'C' || substr(document_key, 14, 1) AS company_code, CASE WHEN event_type = 'error' THEN 'ENDED' ELSE 'ACTIVE' END AS old_state, event_id % 2 AS missing, 'r/판매중__' || document_key AS old_path
  FROM (SELECT *, row_number() OVER (PARTITION BY document_key ORDER BY seq) AS rn FROM e) WHERE rn = 1
),
s AS (SELECT document_key AS key, CASE WHEN value > 40 THEN 'ENDED' ELSE 'ACTIVE' END AS state, event_type AS raw_status, CASE WHEN event_id % 3 = 0 THEN ts::DATE END AS sale_end_date, seq FROM e WHERE event_type IN ('view', 'signup') AND event_id % 40 = 0),
o AS (SELECT key, count(DISTINCT state) = 1 AS ok, min(state) AS state FROM s GROUP BY key),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY sale_end_date IS NULL, seq) AS rn FROM s) WHERE rn = 1),
d AS (
  SELECT r.*, coalesce(o.ok, false) AS found, o.key IS NOT NULL AND NOT o.ok AS failed, o.key IS NULL AND old_state = 'ACTIVE' AND company_code NOT IN ('C3', 'C4') AS absent, o.state AS seen, b.raw_status, b.sale_end_date
  FROM r LEFT JOIN o USING (key) LEFT JOIN b USING (key)
),
z AS (
  SELECT *, CASE WHEN found THEN seen WHEN absent AND missing + 1 >= 2 THEN 'UNKNOWN' ELSE old_state END AS new_state, CASE WHEN found THEN 0 WHEN absent THEN missing + 1 ELSE missing END AS missing_count,
    CASE WHEN found THEN 'explicit_observation' WHEN absent AND missing + 1 >= 2 THEN 'consecutive_complete_absence' WHEN absent THEN 'first_complete_absence_grace' END AS reason
  FROM d
),
y AS (SELECT *, CASE WHEN found OR absent THEN replace(old_path, '판매중__', CASE new_state WHEN 'ACTIVE' THEN '판매중__' WHEN 'ENDED' THEN '판매완료__' ELSE '상태미상__' END) ELSE old_path END AS new_path FROM z)"""
_RA = _R.replace("FROM e WHERE event_type IN ('view', 'signup') AND event_id % 40 = 0", "FROM (SELECT *, max(ts::DATE) OVER (PARTITION BY document_key) AS last_day FROM e) WHERE event_type <> 'error' AND ts::DATE = last_day")
_L = "l AS (SELECT page_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS x FROM (SELECT page_id, regexp_extract_all(html, '<a [^>]*?href=\"[^\"]*\"[^>]*>.*?</a>') AS a FROM pages)), h AS (SELECT page_id, pos, regexp_extract(x, 'href=\"([^\"]*)\"', 1) AS href, regexp_extract(x, '>([^<]*)</a>', 1) AS label FROM l)"
_M = f"""{SQL["cells"]}, u AS (SELECT conv_id, turn, len(cells) AS n, unnest(cells) AS c FROM w),
m AS (
  SELECT conv_id, count(DISTINCT turn) AS row_count, max(n) AS column_count, count(*) FILTER (trim(c) <> '') AS nonempty_cell_count, count(*) FILTER (regexp_matches(c, '[0-9]|%|％')) AS value_cell_count,
    count(*) FILTER (length(c) >= 10) AS long_text_cell_count, count(*) FILTER (regexp_matches(c, '[:：?？]')) AS relation_cell_count, count(*) AS cells, max(length(trim(c))) AS longest FROM u GROUP BY 1
),
x AS (SELECT conv_id, count(*) FILTER (k >= 2) AS multi_cell_row_count FROM (SELECT conv_id, turn, count(*) FILTER (trim(c) <> '') AS k FROM u GROUP BY 1, 2) GROUP BY 1)"""
_BODY = "CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 2 = 0 THEN '%PDF-1.4 ' || text ELSE 'DATA ' || text END"
_EXT = "['.pdf', '.zip', '.txt', '.hwp', ''][doc_id % 5 + 1]"
_MAGIC = f"({_EXT} IN ('.txt', '') OR ({_EXT} = '.pdf' AND {_BODY} LIKE '%PDF-%' AND starts_with({_BODY}, '%PDF-')))"

ORACLES = {
    "pending_plan": f"""WITH {_P}, s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedupe_key ORDER BY ingest_seq DESC) AS rn FROM p) WHERE rn = 1)
SELECT p.month, count(*) AS pending FROM p LEFT JOIN s ON s.plan_key = p.plan_key LEFT JOIN customer ON c_custkey % 4 <> 0 AND 'files/' || c_custkey = s.saved_relative_path
WHERE NOT coalesce(s.download_status IN ('SUCCESS', 'DUPLICATE_SKIPPED') AND c_custkey IS NOT NULL, false) GROUP BY 1""",
    "orphan_states": f"WITH {_P} SELECT month, count(*) AS orphans FROM p WHERE ingest_seq % 10 = 3 GROUP BY 1",
    "latest_downloads": f"WITH {_P} SELECT dedupe_key, plan_key, download_status FROM (SELECT *, row_number() OVER (PARTITION BY dedupe_key ORDER BY updated_at DESC, ingest_seq DESC) AS rn FROM p) WHERE rn = 1",
    "monthly_index": f"WITH {_P} SELECT month, count(*) AS items, sha256(string_agg(plan_key, ',' ORDER BY ingest_seq)) AS keys_digest FROM p GROUP BY 1",
    "decoded_documents": "SELECT doc_id, 'utf-8' AS charset, false AS replaced, sha256(coalesce(text, '')) AS text_sha256 FROM documents",
    "monthly_keys": f"WITH {_P} SELECT month, row_number() OVER (PARTITION BY month ORDER BY ingest_seq) AS place, plan_key FROM p",
    "image_occurrences": "SELECT lang AS doc_id, sha256(text) AS sha256, min(doc_id) OVER (PARTITION BY lang, sha256(text)) AS image_id, row_number() OVER (PARTITION BY lang, sha256(text) ORDER BY doc_id) AS occurrence_no, doc_id AS page_no FROM documents",
    "monthly_counts": f"WITH {_P} SELECT month, count(*) AS items FROM p GROUP BY 1",
    "plan_status_counts": f"WITH {_P} SELECT 'C' || substr(dedupe_key, 1, 1) AS company_code, download_status, count(*) AS n FROM p GROUP BY 1, 2 UNION ALL SELECT NULL, download_status, count(*) FROM p GROUP BY 2",
    "retried": f"""WITH {_P}, s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dedupe_key ORDER BY ingest_seq DESC) AS rn FROM p) WHERE rn = 1)
SELECT s.download_status AS previous_status, s.download_status = 'DOWNLOAD_FAILED' OR s.ingest_seq % 3 = 0 AS retried, count(*) AS n FROM p JOIN s USING (dedupe_key) GROUP BY 1, 2""",
    "changed_plans": f"WITH {_P} SELECT month, count(*) AS changed FROM p WHERE month < '1996-01' AND download_status <> 'SUCCESS' GROUP BY 1",
    "run_roll": f"""WITH {_C}, n AS (SELECT code, collection_status, (SELECT count(*) FROM supplier WHERE s_nationkey = nation) AS records FROM c)
SELECT sum(records)::BIGINT AS total_records, string_agg(code, ',' ORDER BY code) FILTER (collection_status = 'DISABLED') AS locked, string_agg(code, ',' ORDER BY code) FILTER (collection_status = 'ACCESS_RESTRICTED') AS failed, 'PARTIAL_SUCCESS' AS run_status FROM n""",
    "merged_catalog": f"""WITH {_K} SELECT document_key, product_name, last_seen_run_id, strftime(last_seen_at, '%Y-%m-%d %H:%M:%S.%f') AS last_seen_at, sale_status, strftime(status_checked_at, '%Y-%m-%d %H:%M:%S.%f') AS status_checked_at, status_missing_count, document_label,
  file_status, CASE WHEN done THEN sha256(file_id::VARCHAR) END AS sha256, file_id AS file_size, last_attempt_status, strftime(last_attempt_at, '%Y-%m-%d %H:%M:%S.%f') AS last_attempt_at, strftime(downloaded_at, '%Y-%m-%d %H:%M:%S.%f') AS downloaded_at, last_download_run_id, last_status_run_id,
  migration::VARCHAR AS migration, final_url::VARCHAR AS final_url FROM cat""",
    "catalog_report": "SELECT unnest(['" + "', '".join(catalog.CONSTRAINTS) + "']) AS rule, 0::BIGINT AS bad_rows",
    "catalog_overview": "SELECT count(DISTINCT user_id) AS row_count, count(DISTINCT user_id) AS current_identity, 0 AS unsupported_identity, 0 AS bad_keys, 0 AS bad_sha256, 0 AS available_without_sha256 FROM events",
    "catalog_violations": """WITH r AS (SELECT unnest([11, 13, 17, 19, 23, 29, 31, 37, 41, 43]) AS k, unnest(['document_key_format', 'product_version_key_format', 'identity_version', 'sha256_format', 'missing_count', 'file_size', 'sale_status', 'file_status', 'document_type', 'sale_period']) AS rule)
SELECT rule, (SELECT count(*) FROM events WHERE event_id % k = 0) AS bad_rows FROM r UNION ALL SELECT 'available_has_sha256', count(*) FROM events WHERE event_id % 37 <> 0 AND event_id % 19 = 1""",
    "catalog_faults": """SELECT count(*) AS row_count, count(*) FILTER (event_id % 17 <> 0) AS current_identity, count(*) FILTER (event_id % 17 = 0) AS unsupported_identity, count(*) FILTER (event_id % 11 = 0 OR event_id % 13 = 0) AS bad_keys, count(*) FILTER (event_id % 19 = 0) AS bad_sha256,
  count(*) FILTER (event_id % 37 <> 0 AND event_id % 19 = 1) AS available_without_sha256 FROM events""",
    "catalog_status_pairs": f"WITH {_K} SELECT file_status, last_attempt_status, count(*) AS documents FROM cat GROUP BY 1, 2",
    "status_update_outcomes": f"""WITH {_K}, a AS (
  SELECT 0 AS seq, document_key, status_checked_at AS t FROM cat UNION ALL SELECT seq, CASE WHEN event_id % 9 = 1 THEN 'DOC_x' || event_id ELSE document_key END, coalesce(checked_at, seen_at) FROM e WHERE event_id % 2 = 1
), j AS (SELECT *, bool_or(seq = 0) OVER (PARTITION BY document_key) AS there, max(t) OVER (PARTITION BY document_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM a)
SELECT count(*) AS requested, count(*) FILTER (there AND (latest IS NULL OR t >= latest)) AS updated, count(*) FILTER (there AND t < latest) AS stale_noop, count(*) FILTER (NOT there) AS missing FROM j WHERE seq > 0""",
    "all_status_updates": f"""WITH {_K}, a AS (
  SELECT 0 AS seq, document_key, status_checked_at AS t FROM cat UNION ALL SELECT seq, CASE WHEN event_id % 9 = 1 THEN 'DOC_x' || event_id ELSE document_key END, coalesce(checked_at, seen_at) FROM e
), j AS (SELECT *, bool_or(seq = 0) OVER (PARTITION BY document_key) AS there, max(t) OVER (PARTITION BY document_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest FROM a)
SELECT count(*) AS requested, count(*) FILTER (there AND (latest IS NULL OR t >= latest)) AS updated, count(*) FILTER (there AND t < latest) AS stale_noop, count(*) FILTER (NOT there) AS missing FROM j WHERE seq > 0""",
    "identity_collisions": f"""WITH {_E}, i AS (SELECT *, seq % 100 = 7 AS other, arg_min(seq % 100 = 7, seq) OVER (PARTITION BY document_key) AS first_other FROM e) SELECT document_key, seq FROM i WHERE other <> first_other""",
    "pending_events": f"WITH {_E} SELECT operation, event_type, count(*) AS pending FROM e WHERE event_type <> 'view' AND event_id % 13 <> 0 GROUP BY 1, 2",
    "compacted": "SELECT count(*) AS before, count(*) FILTER (event_type <> 'error') AS removed, count(*) FILTER (event_type = 'error') AS retained FROM events",
    "failures": "SELECT ['transient', 'permanent', 'unclassified'][event_id % 3 + 1] AS failure_kind, count(*) AS failures FROM events GROUP BY 1",
    "absent_versions": f"""WITH {_E}, r AS (SELECT document_key AS key, date_diff('day', DATE '2024-01-01', ts::DATE) AS run, bool_or(event_type = 'purchase') AS found, bool_and(event_id % 11 <> 0) AS complete FROM e GROUP BY 1, 2),
s AS (SELECT *, count(*) FILTER (found) OVER (PARTITION BY key ORDER BY run) AS spell FROM r), n AS (SELECT *, row_number() OVER (PARTITION BY key, spell ORDER BY run) AS missing FROM s WHERE NOT found AND complete)
SELECT key, run, missing FROM n WHERE missing = 2""",
    "reconcile_stats": f"""WITH {_R} SELECT count(*) FILTER (old_state = 'ACTIVE') AS candidates, count(*) FILTER ((found OR absent) AND new_state = 'ACTIVE') AS still_active, count(*) FILTER ((found OR absent) AND new_state = 'ENDED') AS ended,
  count(*) FILTER ((found OR absent) AND new_state = 'UNKNOWN') AS unknown, count(*) FILTER (reason = 'first_complete_absence_grace') AS missing_grace, count(*) FILTER (failed) AS partial_or_failed, count(*) FILTER (NOT (found OR absent OR failed)) AS unchanged FROM y""",
    "all_reconcile_stats": f"""WITH {_RA} SELECT count(*) FILTER (old_state = 'ACTIVE') AS candidates, count(*) FILTER ((found OR absent) AND new_state = 'ACTIVE') AS still_active, count(*) FILTER ((found OR absent) AND new_state = 'ENDED') AS ended,
  count(*) FILTER ((found OR absent) AND new_state = 'UNKNOWN') AS unknown, count(*) FILTER (reason = 'first_complete_absence_grace') AS missing_grace, count(*) FILTER (failed) AS partial_or_failed, count(*) FILTER (NOT (found OR absent OR failed)) AS unchanged FROM y""",
    "reconcile_actions": f"""WITH {_R} SELECT key, old_state, new_state, old_path, new_path, reason, CASE WHEN found THEN sale_end_date END AS sale_end_date, CASE WHEN found THEN raw_status END AS raw_status, new_path <> old_path AS move_required, missing_count FROM y WHERE found OR absent""",
    "all_reconcile_actions": f"""WITH {_RA} SELECT key, old_state, new_state, old_path, new_path, reason, CASE WHEN found THEN sale_end_date END AS sale_end_date, CASE WHEN found THEN raw_status END AS raw_status, new_path <> old_path AS move_required, missing_count FROM y WHERE found OR absent""",
    "reconciled_rows": f"""WITH {_R} SELECT key, new_state AS state, missing_count AS status_missing_count, new_path || '/f.pdf' AS saved_relative_path, CASE WHEN found THEN 'CONFIRMED' WHEN absent THEN 'MISSING' END AS status_check_result FROM y""",
    "all_reconciled_rows": f"""WITH {_RA} SELECT key, new_state AS state, missing_count AS status_missing_count, new_path || '/f.pdf' AS saved_relative_path, CASE WHEN found THEN 'CONFIRMED' WHEN absent THEN 'MISSING' END AS status_check_result FROM y""",
    "links": f"WITH {_L} SELECT page_id, pos, href, label FROM h",
    "link_targets": f"WITH {_L} SELECT regexp_extract(url, '^https?://([^/]*)', 1) AS host, count(*) AS links, count(DISTINCT href) AS targets FROM h JOIN pages USING (page_id) GROUP BY 1",
    "carried_types": f"WITH {_E}, s AS (SELECT last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY document_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM e) SELECT section, count(*) AS rows FROM s GROUP BY 1",
    "repeated_page_lines": """WITH p AS (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_no, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents),
z AS (SELECT source AS doc_id, page_no, 'HEADER' AS location, l[1] AS line FROM p WHERE len(l) > 0 UNION ALL SELECT source, page_no, 'FOOTER', l[-1] FROM p WHERE len(l) > 0),
k AS (SELECT *, trim(regexp_replace(lower(line), '\\s+', ' ', 'g')) AS key FROM z), n AS (SELECT source AS doc_id, count(*) AS pages FROM p GROUP BY 1)
SELECT doc_id, location, key, count(DISTINCT page_no) AS match_pages, greatest(3, ceil(round(pages * 0.1, 9)))::BIGINT AS required FROM k JOIN n USING (doc_id) WHERE key <> '' AND pages >= 3 GROUP BY ALL HAVING count(DISTINCT page_no) >= greatest(3, ceil(round(pages * 0.1, 9)))""",
    "page_statuses": """WITH p AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_no, CASE WHEN doc_id % 17 = 0 THEN 0 ELSE len(regexp_extract_all(text, '[가-힣A-Za-z0-9]')) END AS c FROM documents),
s AS (SELECT *, CASE WHEN doc_id % 50 = 0 THEN 'OCR_REQUIRED' WHEN doc_id % 5 <> 0 AND c <= 10 AND doc_id % 2 = 0 THEN 'OCR_REQUIRED' WHEN doc_id % 5 <> 0 AND c = 0 THEN 'EMPTY' ELSE 'TEXT' END AS st FROM p),
n AS (SELECT source AS doc_id, count(*) AS pages, count(*) FILTER (st = 'TEXT') AS text_pages, count(*) FILTER (st = 'OCR_REQUIRED') AS ocr_required_pages, count(*) FILTER (st = 'EMPTY') AS empty_pages,
  coalesce(string_agg(page_no, ',' ORDER BY page_no) FILTER (st = 'OCR_REQUIRED'), '') AS ocr, coalesce(string_agg(page_no, ',' ORDER BY page_no) FILTER (st = 'EMPTY'), '') AS empty, bool_or(doc_id % 23 = 0) AS warned FROM s GROUP BY 1)
SELECT * EXCLUDE (warned), CASE WHEN ocr_required_pages > 0 AND text_pages > 0 THEN 'PARTIAL' WHEN ocr_required_pages > 0 OR text_pages = 0 THEN 'OCR_REQUIRED' WHEN warned THEN 'PARTIAL' ELSE 'SUCCEEDED' END AS status FROM n""",
    "table_metrics": f"""WITH {_M}, q AS (SELECT *, value_cell_count + long_text_cell_count + relation_cell_count > 0 AS signal FROM m JOIN x USING (conv_id)),
v AS (SELECT *, CASE WHEN nonempty_cell_count = 0 THEN 'REJECTED EMPTY_TABLE' WHEN nonempty_cell_count = 1 THEN 'REJECTED SINGLE_CELL_LAYOUT' WHEN row_count = 1 THEN 'FRAGMENT SINGLE_ROW_DATA_FRAGMENT' WHEN column_count = 1 THEN 'FRAGMENT ONE_COLUMN_FRAGMENT' WHEN value_cell_count > 0 THEN 'MEANINGFUL VALUE_TABLE' ELSE 'MEANINGFUL STRUCTURED_TEXT_TABLE' END AS s FROM q)
SELECT conv_id, row_count, column_count, nonempty_cell_count, multi_cell_row_count, value_cell_count, long_text_cell_count, relation_cell_count, split_part(s, ' ', 1) AS status, split_part(s, ' ', 2) AS reason,
  CASE WHEN (cells - nonempty_cell_count) / cells >= 0.25 OR longest >= 120 THEN 'STRUCTURED_MARKDOWN' ELSE 'MARKDOWN_TABLE' END AS representation FROM v""",
    "table_texts": f"""WITH {SQL["cells"]}, r AS (SELECT conv_id, turn, list_aggregate(list_transform(cells, lambda c: lower(regexp_replace(c, '[^가-힣A-Za-z0-9%]+', '', 'g'))), 'string_agg', '') AS f, len(cells) AS n, list_sum(list_transform(cells, lambda c: length(c) + length(c) - length(replace(c, '|', '')))) AS chars FROM w),
t AS (SELECT conv_id, sha256(string_agg(f, '' ORDER BY turn)) AS fingerprint, max(n) AS width, count(*) AS rows, sum(chars)::BIGINT AS chars FROM r GROUP BY 1)
SELECT conv_id, fingerprint, chars + rows * (4 + 3 * (width - 1)) + (4 + 3 * width + 3 * (width - 1)) + rows AS markdown_chars FROM t""",
    "word_differences": """WITH c AS (SELECT conv_id, role, unnest(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS token FROM conversations), n AS (SELECT conv_id, token, count(*) FILTER (role = 'user') AS l, count(*) FILTER (role = 'assistant') AS r FROM c WHERE role IN ('user', 'assistant') GROUP BY 1, 2)
SELECT conv_id, sum(greatest(l - r, 0))::BIGINT AS missing, sum(greatest(r - l, 0))::BIGINT AS added FROM n WHERE l <> r GROUP BY 1""",
    "distinct_images": "SELECT lang AS doc_id, sha256(text) AS sha256, min(doc_id) AS image_id, count(*) AS occurrence_count, string_agg(doc_id, ',' ORDER BY doc_id) AS page_nos FROM documents GROUP BY 1, 2",
    "response_checks": f"""WITH p AS (SELECT 'p' || page_id AS response_id, CASE WHEN page_id % 9 = 0 THEN 'HTTP 403' WHEN page_id % 11 = 0 THEN 'HTTP status' ELSE 'HTML page' END AS reason FROM pages),
d AS (SELECT 'd' || doc_id AS response_id, CASE WHEN doc_id % 7 = 0 THEN 'empty body' WHEN {_EXT} = '.txt' THEN 'extension' WHEN NOT {_MAGIC} THEN 'signature' WHEN doc_id % 3 <> 0 AND {_EXT} = '' THEN 'content type' ELSE '' END AS reason FROM documents)
SELECT response_id, reason = '' AS ok, CASE reason WHEN '' THEN '' WHEN 'HTTP 403' THEN 'ACCESS_DENIED' WHEN 'empty body' THEN 'INVALID_FILE' WHEN 'extension' THEN 'INVALID_FILE' WHEN 'signature' THEN 'INVALID_FILE' ELSE 'INVALID_RESPONSE' END AS status, reason FROM (FROM p UNION ALL FROM d)""",
    "stored_checks": f"""WITH d AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'empty' WHEN strlen({_BODY}) % 10 = 3 THEN 'size' WHEN NOT {_MAGIC} THEN 'signature' ELSE '' END AS reason FROM documents) SELECT reason = '' AS ok, reason, count(*) AS n FROM d GROUP BY 1, 2""",
    "attempt_selection": """WITH c AS (SELECT conv_id::VARCHAR AS table_id, turn + 1 AS no, text, length(text) - length(replace(text, ' ', '')) >= 40 AS good FROM conversations WHERE turn < 2),
s AS (SELECT table_id, count(*) AS attempts, min(no) FILTER (good) AS selected_attempt, arg_min(text, no) AS source, arg_min(text, no) FILTER (good) AS picked FROM c GROUP BY 1)
SELECT table_id, attempts, selected_attempt, CASE WHEN selected_attempt IS NULL THEN 'FALLBACK' ELSE 'SUCCEEDED' END AS final_status, length(coalesce(picked, source)) AS chars FROM s""",
    "union_of_channels": "SELECT CASE o_orderstatus WHEN 'O' THEN 'on_sale' ELSE 'ended' END AS tab_status, count(*) AS n FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1",
    "missing_companies": "SELECT n_nationkey AS nation FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey % 3 <> 0)",
}
