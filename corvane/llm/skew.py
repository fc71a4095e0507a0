"""Joins whose keys may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with more than this many rows, and more than 1 / MOST of all rows, is hot; so there are at most MOST such keys.
HOT, MOST, SALTS = 1_000, 10_000, 64


def join_hot(rows: DataFrame, few: DataFrame, keys: list[str], by: str, total: int | None = None) -> DataFrame:
    """``rows`` joined with ``few``, which has one row for each key and in ``n`` the number of its rows.

    The rows of hot keys are dealt to SALTS tasks by column ``by``, and the few rows they meet are repeated for each. Hot keys are
    broadcast: by their definition there are at most MOST. ``total``: the number of rows, by default the sum of ``n``.
    """
    if total is None:
        total = few.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") > max(HOT, total // MOST)
    salts = F.broadcast(few.where(hot).select(*keys, F.lit(SALTS).alias("_salts")))
    dealt = rows.join(salts, keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    spread = few.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("n")
    return dealt.join(spread, [*keys, "_salt"]).drop("_salt")
