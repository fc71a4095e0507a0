"""Named queries over the given tables, with SQL equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.plans import feeds, layout, records, sites, versions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**versions.QUERIES, **records.QUERIES, **feeds.QUERIES, **layout.QUERIES, **sites.QUERIES}
ORACLES: dict[str, str] = {**versions.ORACLES, **records.ORACLES, **feeds.ORACLES, **layout.ORACLES, **sites.ORACLES}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.period_overview(spark, sf_dir)
