"""First and last of a key, numbering, caps and carrying values down. Arrival order is a column, as Spark keeps none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: list[str], seq: str = "ingest_seq") -> DataFrame:
    """The first row of each key in arrival order; null keys are keys.

    A key's rows meet as one minimum each (map-side), not as a sorted group, so a hot key costs no more than others.
    """
    return _extreme(df, keys, F.min_by, F.col(seq), seq)


def last_wins(df: DataFrame, keys: list[str], seq: str = "ingest_seq") -> DataFrame:
    """The last row of each key in arrival order: the state that a log folds to."""
    return _extreme(df, keys, F.max_by, F.col(seq), seq)


def latest_by_clock(df: DataFrame, keys: list[str], clock: str, seq: str = "ingest_seq") -> DataFrame:
    """The row of each key with the latest clock (nulls first), the later row on ties."""
    return _extreme(df, keys, F.max_by, F.struct(F.col(clock).isNotNull(), clock, seq))


def _extreme(df: DataFrame, keys: list[str], pick, order, seq: str | None = None) -> DataFrame:
    """Keys, and the order where it is one column, are taken along once, not again in the row: rows are then compared by order first, and equal orders by the rest.

    Maps can't be compared, so rows with a map keep the order beside them.
    """
    rest = [c for c in df.columns if c not in keys and c != seq]
    told = {k: F.col(f"_k{i}") for i, k in enumerate(keys)}
    groups = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    if seq is None or any("map<" in df.schema[c].dataType.simpleString() for c in rest):
        row = pick(F.struct(*[F.col(c) for c in df.columns if c not in keys]), order)
    else:
        least = F.min if pick is F.min_by else F.max
        row = least(F.when(order.isNotNull(), F.struct(order, *[F.col(c) for c in rest])))
    return groups.agg(row.alias("_row")).select(*[told.get(c, F.col(f"_row.{c}")).alias(c) for c in df.columns])


def capped(df: DataFrame, group: list[str], limit: int, order: list[Column]) -> DataFrame:
    """At most ``limit`` rows of each group in order, with ``group_rows`` and whether rows were skipped (``coverage_capped``).

    Sizes are counted apart, so that the ranking has a limit which Spark applies before the shuffle.
    """
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_n") <= limit).drop("_n")
    sizes = df.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(F.count("*").alias("group_rows"))
    same = reduce(lambda a, b: a & b, [F.equal_null(F.col(g), F.col(f"_g{i}")) for i, g in enumerate(group)])
    joined = ranked.join(sizes, same).drop(*[f"_g{i}" for i in range(len(group))])
    return joined.withColumn("coverage_capped", F.col("group_rows") > limit)


def samples(df: DataFrame, group: list[str], value: str, order: str, limit: int = 5) -> DataFrame:
    """The first values of each group that aren't blank, as a list in order."""
    filled = df.where(F.coalesce(F.col(value), F.lit("")) != "")
    ranked = filled.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(order))).where(F.col("_n") <= limit)
    listed = F.array_sort(F.collect_list(F.struct("_n", F.col(value).alias("_v"))))
    return ranked.groupBy(*group).agg(F.transform(listed, lambda x: x["_v"]).alias("samples"))


def collision_names(df: DataFrame, path: str, digest: str, seq: str = "ingest_seq") -> DataFrame:
    """Where contents share a path, the second gets ``_2`` and so on; equal contents are stored once.

    Adds ``stored_path`` and ``outcome`` (SUCCESS or DUPLICATE_SKIPPED). Rows are dealt by path once, which serves both windows.
    """
    df = df.repartition(path)
    first = F.min(seq).over(Window.partitionBy(path, digest))
    ranked = df.withColumn("_first", first).withColumn("_n", F.dense_rank().over(Window.partitionBy(path).orderBy("_first")))
    stem, end = F.regexp_extract(path, r"^(.*?)(\.[A-Za-z0-9]{1,10})?$", 1), F.regexp_extract(path, r"^(.*?)(\.[A-Za-z0-9]{1,10})?$", 2)
    stored = F.when(F.col("_n") == 1, F.col(path)).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), end))
    outcome = F.when(F.col(seq) == F.col("_first"), "SUCCESS").otherwise("DUPLICATE_SKIPPED")
    return ranked.withColumn("stored_path", stored).withColumn("outcome", outcome).drop("_first", "_n")


def names_beside_stored(df: DataFrame, path: str, digest: str, stored: DataFrame, seq: str = "ingest_seq") -> DataFrame:
    """The same where files are stored already, ``stored(stored_path, digest)``: ``x_3.pdf`` takes number 3 of ``x.pdf`` (and 1 of itself).

    A content that a path has under any of its numbers isn't stored again; new ones take the numbers that are free, in order of arrival.
    With a path's taken numbers in order, the i-th being t, those up to the k-th free one are the ones with t - i + 1 <= k; a running count over
    taken and new numbers together says how many.
    """
    form = r"^(.*?)(?:_(\d+))?(\.[A-Za-z0-9]{1,10})?$"
    number = F.regexp_extract("stored_path", form, 2)
    own = stored.select(F.col("stored_path").alias("_path"), F.lit(1).cast("long").alias("_taken"), F.col("digest").alias("_digest"), "stored_path")
    base = F.concat(F.regexp_extract("stored_path", form, 1), F.regexp_extract("stored_path", form, 3))
    of_base = stored.where(number.try_cast("long") >= 2).where(~F.startswith(number, F.lit("0"))).select(base, number.cast("long"), "digest", "stored_path")
    family = own.union(of_base)
    held = family.groupBy("_path", "_digest").agg(F.min_by("stored_path", "_taken").alias("_held"))
    told = df.join(held, (F.col(path) == F.col("_path")) & (F.col(digest) == F.col("_digest")), "left").drop("_path", "_digest")
    known = told.where("_held is not null").withColumn("stored_path", F.col("_held")).withColumn("outcome", F.lit("DUPLICATE_SKIPPED")).drop("_held")
    new = told.where("_held is null").drop("_held").repartition(path)
    first = F.min(seq).over(Window.partitionBy(path, digest))
    ranked = new.withColumn("_first", first).withColumn("_k", F.dense_rank().over(Window.partitionBy(path).orderBy("_first")).cast("long"))
    taken = family.select("_path", "_taken").distinct().withColumn("_at", F.col("_taken") - F.row_number().over(Window.partitionBy("_path").orderBy("_taken")) + 1)
    both = taken.select("_path", "_at", F.lit(0).alias("_new")).union(ranked.select(path, "_k", F.lit(1)).distinct())
    before = F.count_if(F.col("_new") == 0).over(Window.partitionBy("_path").orderBy("_at", "_new").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbers = both.withColumn("_n", F.col("_at") + before).where("_new = 1").select(F.col("_path").alias("_p"), F.col("_at").alias("_a"), "_n")
    placed = ranked.join(numbers, (F.col(path) == F.col("_p")) & (F.col("_k") == F.col("_a")))
    stem, end = F.regexp_extract(path, r"^(.*?)(\.[A-Za-z0-9]{1,10})?$", 1), F.regexp_extract(path, r"^(.*?)(\.[A-Za-z0-9]{1,10})?$", 2)
    name = F.when(F.col("_n") == 1, F.col(path)).otherwise(F.concat(stem, F.lit("_"), F.col("_n").cast("string"), end))
    outcome = F.when(F.col(seq) == F.col("_first"), "SUCCESS").otherwise("DUPLICATE_SKIPPED")
    out = placed.withColumn("stored_path", name).withColumn("outcome", outcome).drop("_first", "_k", "_p", "_a", "_n")
    return known.unionByName(out)


def first_wins_counted(df: DataFrame, keys: list[str], seq: str = "ingest_seq", undated: str | None = None) -> tuple[DataFrame, Observation, Observation]:
    """``first_wins`` that counts on the way: ``raw`` rows before, ``kept`` rows after (and ``undated`` ones, whose column is null).

    The counts are there once the result has been written or collected; they cost no scan of their own.
    """
    before, after = Observation(), Observation()
    kept = first_wins(df.observe(before, F.count(F.lit(1)).alias("raw")), keys, seq)
    counts = [F.count(F.lit(1)).alias("kept"), *([F.count_if(F.col(undated).isNull()).alias("undated")] if undated else [])]
    return kept.observe(after, *counts), before, after


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str = "n") -> DataFrame:
    """Rows numbered from 1 in each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def table_id(page: Column, n: Column) -> Column:
    return F.format_string("page_%04d_table_%03d", page, n)


def carried_down(df: DataFrame, group: list[str], order: str, is_header: Column, value: Column, name: str) -> DataFrame:
    """Rows with the value of the last header row above them (or their own)."""
    above = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(F.when(is_header, value), ignorenulls=True).over(above))


def longest(df: DataFrame, keys: list[str], text: str, seq: str = "ingest_seq") -> DataFrame:
    """The row with the longest text of each key, the first of equals."""
    return _extreme(df, keys, F.max_by, F.struct(F.length(text), -F.col(seq)))


def duplicate_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with ``copies``."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
