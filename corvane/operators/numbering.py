"""Row numbers in groups of any size: no task holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.sources.scratch import fresh_path


def dealt_by_range(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows dealt to ranges of (group, order), written, with the number of their range as ``_range``."""
    path = fresh_path(rows.sparkSession, "ranges")
    dealt = rows.repartitionByRange(F.col(group), *[F.col(o) for o in order]).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    return rows.sparkSession.read.schema(dealt.schema).parquet(path)


def numbered_at_scale(rows: DataFrame, group: str, order: list[str], name: str = "n") -> DataFrame:
    """Rows numbered from 1 in each group, in order of columns that tell its rows apart; null groups are one.

    Rows are dealt to ranges and numbered in each; a group's rows in a range go on from the sizes of those in the ranges ahead, of which there
    is one row for each group and range. Rows that are equal in ``order`` are numbered in any order.
    """
    dealt = dealt_by_range(rows, group, order)
    sizes = dealt.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_part")).agg(F.count("*").alias("_size"))
    ahead = F.sum("_size").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_group", "_part", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    joined = dealt.withColumn(name, inside).join(starts, F.equal_null(F.col(group), F.col("_group")) & (F.col("_range") == F.col("_part")))
    return joined.withColumn(name, F.col(name) + F.col("_ahead")).select(*rows.columns, name)
