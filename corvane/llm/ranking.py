"""Row numbers over a whole table without a task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.store import discard, materialize


def global_ranks(rows: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """``rows`` with their places 1, 2, 3, ... in ``order`` as column ``rank``.

    Rows are dealt to ranges of the order and numbered inside each; a range starts after the rows of those ahead of it (one count for
    each range passes through the driver). Rows that are equal in ``order`` are dealt on by an arbitrary number, so many of them
    don't meet in one task; which of them comes first isn't defined.
    """
    spark = rows.sparkSession
    dealt = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*order, F.col("_tie"))
    dealt = materialize(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_range"], r["n"]) for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect())
    starts, ahead = [], 0
    for number, n in sizes:
        starts.append((number, ahead))
        ahead += n
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order, F.col("_tie")))
    numbered = dealt.withColumn(rank, inside.cast("long")).join(spark.createDataFrame(starts, "_range int, _ahead long"), "_range")
    out = materialize(numbered.withColumn(rank, F.col(rank) + F.col("_ahead")).drop("_range", "_ahead", "_tie"), "ranks")
    discard(dealt)
    return out
