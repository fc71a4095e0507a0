"""Sale states across runs: observations, transitions, and the moves that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.functions.paths import moved_path, saved_version_dir, with_state_prefix

#: Runs in a row that a version must be missing from a complete list before its state becomes unknown.
THRESHOLD = 2


def observations(matches: DataFrame, coverage_complete: bool = True) -> DataFrame:
    """``matches(key, state, raw_status, sale_end_date, seq)`` -> one observation of each key.

    Versions that disagree on the state make it unusable; else the first one with an end date speaks, or the first.
    """
    spoken = F.min_by(F.struct("state", "raw_status", "sale_end_date"), F.struct(F.col("sale_end_date").isNull(), F.col("seq")))
    one = matches.groupBy("key").agg(F.count_distinct("state").alias("states"), spoken.alias("o"))
    agreed = F.col("states") == 1
    return one.select(
        "key",
        F.when(agreed, F.col("o.state")).otherwise("UNKNOWN").alias("state"),
        F.when(agreed, F.col("o.raw_status")).alias("raw_status"),
        F.when(agreed, F.col("o.sale_end_date")).alias("sale_end_date"),
        (agreed & F.lit(coverage_complete)).alias("coverage_complete"),
        agreed.alias("request_ok"),
        agreed.alias("found"),
        F.when(~agreed, "conflicting_status_observations").alias("error"),
    )


def decisions(rows: DataFrame, observed: DataFrame, coverage: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """One decision of each version: ``key, old_state, new_state, missing_count, outcome, reason, old_path, new_path, move_required, ...``.

    ``rows(key, ingest_seq, company_code, state, status_missing_count, saved_relative_path, saved_filename)``; the first row of a
    key stands for it. ``observed(key, state, raw_status, sale_end_date, found, request_ok)``; ``coverage(company_code, complete)``.
    A version that is found takes the state observed. One on sale that a complete list lacks counts as missing, and becomes
    unknown at the threshold. Failed or incomplete lists change nothing.
    """
    if threshold < 2:
        raise ValueError("a version may be missing once")
    fields = ("company_code", "state", "status_missing_count", "saved_relative_path", "saved_filename")
    first = rows.groupBy("key").agg(F.min_by(F.struct(*fields), "ingest_seq").alias("r")).select("key", "r.*").withColumnRenamed("state", "old_state")
    told = observed.select("key", F.col("state").alias("seen_state"), "raw_status", "sale_end_date", "found", "request_ok", F.lit(True).alias("observed"))
    listed = coverage.select("company_code", F.col("complete").alias("complete"))
    d = first.join(told, "key", "left").join(listed, "company_code", "left")
    observed_at_all = F.coalesce(F.col("observed"), F.lit(False))
    on_sale = F.col("old_state") == "ACTIVE"
    absent = ~observed_at_all & on_sale & F.coalesce(F.col("complete"), F.lit(False)) | observed_at_all & F.col("request_ok") & ~F.col("found") & on_sale
    found = observed_at_all & F.col("request_ok") & F.col("found")
    failed = observed_at_all & ~F.col("request_ok")
    missing = F.greatest(F.coalesce("status_missing_count", F.lit(0)), F.lit(0)) + 1
    reason = F.when(found, "explicit_observation").when(absent & (missing >= threshold), "consecutive_complete_absence").when(absent, "first_complete_absence_grace")
    d = d.select(
        "key",
        "company_code",
        "old_state",
        F.when(found, F.col("seen_state")).when(absent & (missing >= threshold), "UNKNOWN").otherwise(F.col("old_state")).alias("new_state"),
        F.when(found, 0).when(absent, missing).otherwise(F.coalesce("status_missing_count", F.lit(0))).alias("missing_count"),
        F.when(failed, "partial_or_failed").when(found | absent, "decided").otherwise("unchanged").alias("outcome"),
        reason.alias("reason"),
        F.coalesce(found, F.lit(False)).alias("found"),
        F.when(found, F.col("raw_status")).alias("raw_status"),
        F.when(found, F.col("sale_end_date")).alias("sale_end_date"),
        saved_version_dir(F.col("saved_relative_path"), F.col("saved_filename")).alias("old_path"),
    )
    new_path = F.when((F.col("old_path") != "") & (F.col("outcome") == "decided"), with_state_prefix(F.col("old_path"), F.col("new_state"))).otherwise(F.col("old_path"))
    return d.withColumn("new_path", new_path).withColumn("move_required", F.col("new_path") != F.col("old_path"))


def actions(decided: DataFrame) -> DataFrame:
    """Decisions that do something: another state, a move, a sighting, or a count of absence."""
    acts = (F.col("old_state") != F.col("new_state")) | F.col("move_required") | F.col("found") | (F.col("missing_count") > 0)
    return decided.where((F.col("outcome") == "decided") & acts).select("key", "old_state", "new_state", "old_path", "new_path", "reason", "sale_end_date", "raw_status", "move_required", "missing_count")


def updated_rows(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """All rows with the state of their version's decision, paths moved along."""
    acts = decided.where("outcome = 'decided'").select("key", "new_state", "missing_count", "found", "old_path", "new_path", "move_required")
    j = rows.join(acts, "key", "left")
    moved = F.col("move_required") & (F.coalesce(F.col("saved_relative_path"), F.lit("")) != "")
    out = j.withColumn("saved_relative_path", F.when(moved, moved_path(F.col("saved_relative_path"), F.col("old_path"), F.col("new_path"))).otherwise(F.col("saved_relative_path")))
    out = out.withColumn("status_check_result", F.when(F.col("found"), "CONFIRMED").when(F.col("missing_count") > 0, "MISSING"))
    out = out.withColumn("state", F.coalesce("new_state", "state")).withColumn("status_missing_count", F.coalesce("missing_count", "status_missing_count"))
    return out.select(*rows.columns, "status_check_result")


def stats(decided: DataFrame) -> DataFrame:
    """Seven counts of a run, over versions."""
    done = F.col("outcome") == "decided"
    return decided.agg(
        F.count_if(F.col("old_state") == "ACTIVE").alias("candidates"),
        F.count_if(done & (F.col("new_state") == "ACTIVE")).alias("still_active"),
        F.count_if(done & (F.col("new_state") == "ENDED")).alias("ended"),
        F.count_if(done & (F.col("new_state") == "UNKNOWN")).alias("unknown"),
        F.count_if(F.col("reason") == "first_complete_absence_grace").alias("missing_grace"),
        F.count_if(F.col("outcome") == "partial_or_failed").alias("partial_or_failed"),
        F.count_if(F.col("outcome") == "unchanged").alias("unchanged"),
    )


def committed(before: DataFrame, after: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Rows as they are once folders were moved: new ones where the move of their version worked or none was due, else the old ones.

    ``outcomes(key, moved, destination, proposed)``: whether it worked, and where the folder really went.
    """
    columns = [c for c in after.columns if c not in ("key", "ingest_seq")]
    old = before.select("key", "ingest_seq", *[F.col(c).alias(f"_{c}") if c in before.columns else F.lit(None).alias(f"_{c}") for c in columns])
    j = after.join(old, ["key", "ingest_seq"]).join(outcomes, "key", "left")
    worked = F.coalesce(F.col("moved"), F.lit(True))
    real = F.when(worked & F.col("destination").isNotNull(), moved_path(F.col("saved_relative_path"), F.col("proposed"), F.col("destination"))).otherwise(F.col("saved_relative_path"))
    j = j.withColumn("saved_relative_path", real)
    return j.select("key", "ingest_seq", *[F.when(worked, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in columns])


def open_moves(journal: DataFrame, paths: DataFrame) -> DataFrame:
    """What to do about moves that a stopped run left open: ``journal(action_id, ingest_seq, phase, source, destination, logical_key, ...)``.

    Closed ones are left out. By which of the two folders is there (``paths(path)``): MOVED, REDO, CONFLICT or PENDING.
    """
    closed = F.max(F.col("phase").isin("COMMITTED", "FAILED", "CONFLICT"))
    last = F.max_by(F.struct("source", "destination", "logical_key", "old_state", "new_state"), "ingest_seq")
    left = journal.groupBy("action_id").agg(closed.alias("closed"), last.alias("e")).where("not closed").select("action_id", "e.*")
    there = paths.select("path").distinct()
    left = left.join(there.select(F.col("path").alias("source"), F.lit(True).alias("_s")), "source", "left").join(there.select(F.col("path").alias("destination"), F.lit(True).alias("_d")), "destination", "left")
    s, d = F.coalesce("_s", F.lit(False)), F.coalesce("_d", F.lit(False))
    what = F.when(~s & d, "MOVED").when(s & ~d, "REDO").when(s & d, "CONFLICT").otherwise("PENDING")
    return left.withColumn("decision", what).drop("_s", "_d")


def reapply_moves(rows: DataFrame, moves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows after recovered moves, and counts ``moved, conflicts, pending, unmatched`` of the moves."""
    own = moves.select(F.col("logical_key").alias("key"), "source", "destination", F.col("new_state").alias("_state"), "decision")
    j = rows.join(own.where("decision in ('MOVED', 'REDO')"), "key", "left")
    hit = F.col("decision").isNotNull()
    out = j.withColumn("state", F.coalesce("_state", "state")).withColumn("saved_relative_path", F.when(hit, moved_path(F.col("saved_relative_path"), F.col("source"), F.col("destination"))).otherwise(F.col("saved_relative_path")))
    known = rows.select("key").distinct().withColumn("_known", F.lit(True))
    done = F.col("decision").isin("MOVED", "REDO")
    counts = own.join(known, "key", "left").agg(
        F.count_if(done & F.col("_known").isNotNull()).alias("moved"), F.count_if(F.col("decision") == "CONFLICT").alias("conflicts"), F.count_if(F.col("decision") == "PENDING").alias("pending"), F.count_if(done & F.col("_known").isNull()).alias("unmatched")
    )
    return out.select(*rows.columns), counts
