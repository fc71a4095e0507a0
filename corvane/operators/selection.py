"""Which versions, companies, images and rows a run takes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.functions import dates
from corvane.functions.status import COMPLETED, RETRYABLE
from corvane.operators.ordering import _extreme

MODES = ("new_or_revised", "overlap")


def selected(target: Column, sale_start: Column, sale_end: Column, start: dt.date, end: dt.date, mode: str = "new_or_revised") -> Column:
    """Whether a version belongs to a period. Undated ones do, for review, unless they ended before it."""
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode!r}")
    first, last = F.lit(start), F.lit(end)
    dated = dates.in_period(target, first, last) if mode == "new_or_revised" else dates.overlaps(sale_start, sale_end, first, last)
    return F.when(target.isNull(), F.coalesce(sale_end >= first, F.lit(True))).otherwise(dated)


def select_versions(versions: DataFrame, start: dt.date, end: dt.date, mode: str = "new_or_revised") -> DataFrame:
    """Versions (``target_date, sale_start_date, sale_end_date``) of a period: one filter, which reaches the scan."""
    return versions.where(selected(F.col("target_date"), F.col("sale_start_date"), F.col("sale_end_date"), start, end, mode))


def candidates(rows: DataFrame, active: DataFrame, keys: list[str], in_period: Column) -> DataFrame:
    """List rows of the period, and those that match an active row whatever their dates; undated rows pass.

    The active side is reduced to its distinct keys, so it stays small; Spark broadcasts it if it is.
    """
    known = active.select(*keys).distinct().withColumn("_active", F.lit(True))
    return rows.join(known, keys, "left").where(F.coalesce(in_period, F.lit(True)) | F.col("_active")).drop("_active")


def enriched_candidates(rows: DataFrame, details: DataFrame, key: str, listed_start: str, start: dt.date, end: dt.date, mode: str = "new_or_revised") -> DataFrame:
    """A cheap filter on the list row first, the details only for what is left, then the exact rule."""
    cheap = rows.where(F.col(listed_start).isNull() | (F.col(listed_start) <= F.lit(end)))
    return select_versions(cheap.join(details, key), start, end, mode)


def check_companies(wanted: DataFrame, companies: DataFrame) -> DataFrame:
    """Codes asked for, normalized and once each, with ``verdict``: ACCEPTED, or why not."""
    codes = wanted.select(F.upper(F.trim("code")).alias("code")).where("code <> ''").distinct()
    known = companies.select("code", "collection_status")
    verdict = F.when(F.col("collection_status").isNull(), "UNKNOWN_COMPANY").when(F.col("collection_status") == "ACTIVE", "ACCEPTED").otherwise(F.col("collection_status"))
    return codes.join(known, "code", "left").select("code", verdict.alias("verdict"))


def active_representatives(rows: DataFrame, key: str = "logical_key", seq: str = "ingest_seq") -> DataFrame:
    """One active row of each version, one with a stored path if there is any."""
    active = rows.where("state = 'ACTIVE'")
    pathless = F.coalesce(F.col("saved_relative_path"), F.lit("")) == ""
    return _extreme(active, [key], F.min_by, F.struct(pathless, F.col(seq)))


def retry_selection(rows: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """Rows of a retry run with ``retried``: their last state can be tried again, or was done but the file isn't right."""
    state = previous.select(key, F.col("download_status").alias("previous_status"), F.col("file_ok"))
    again = F.col("previous_status").isin(*RETRYABLE) | (F.col("previous_status").isin(*COMPLETED) & ~F.col("file_ok"))
    return rows.join(state, key, "left").withColumn("retried", F.coalesce(again, F.lit(False)))


def in_scope(log: DataFrame, scope: str, schema_version: int, adapter_version: str) -> DataFrame:
    """Checkpoint rows that a run may use; apply it before folding the log."""
    return log.where((F.col("scope") == scope) & (F.col("schema_version") == schema_version) & (F.col("adapter_version") == adapter_version))


def usable_images(images: DataFrame, least_side: int = 64, least_area: float = 0.005) -> DataFrame:
    """Images that aren't tiny: by their pixels, and by their share of the page."""
    return images.where((F.least("pixel_width", "pixel_height") >= least_side) & (F.col("area_ratio") >= least_area))


def changed_rows(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows of ``after`` that differ from ``before`` in any column, nulls being values."""
    columns = [c for c in after.columns if c != key]
    old = before.select(F.col(key), F.struct(*columns).alias("_old"))
    return after.join(old, key, "left").where(~F.equal_null(F.struct(*columns), F.col("_old"))).drop("_old")
