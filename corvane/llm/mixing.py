"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.store import materialize

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#$%&*|!<>{}@"
CAP = 3
#: Keys are dealt to coarse ranges, so many for each factor of two, and those of the range that a budget ends in to STEPS finer ones.
OCTAVE, STEPS = 32, 512


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain prose, less the more symbols there are for each word."""
    symbols = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.lit(1.0) / (F.lit(1.0) + symbols / size)


def _drawn(docs: DataFrame, seed: int, *more: Column) -> DataFrame:
    """Each row with its size and its exponential key, and the ranges that the key falls in."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), text.alias("_text"), *more)
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}"))), 1, 13), 16, 10).cast("long")
    weight = F.when(F.col("size") > 0, quality_weight(F.col("_text"), F.col("size"))).otherwise(1.0)
    keyed = base.withColumn("key", -F.log((draw + F.lit(0.5)) / F.lit(float(1 << 52))) / weight).drop("_text")
    reach = F.log2("key") * OCTAVE
    coarse = F.floor(reach)
    return keyed.withColumn("coarse", coarse.cast("int")).withColumn("fine", F.least(F.floor((reach - coarse) * STEPS), F.lit(STEPS - 1)).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """``sizes(source, source_size)`` -> also ``target``: shares of the total by weight, none above ``cap`` times its source.

    Sources by code point, null last, take the weights in turn. With sources in order of cap / weight, the level at
    which the uncapped ones share what the capped ones leave is the largest of the levels reached on the way.
    """
    ranked = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int")).cast("long"))
    by_cap = Window.orderBy((cap * F.col("source_size")) / F.col("weight"), "place")
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(cap * F.col("source_size")).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = left / F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", level).withColumn("level", F.max("level").over(Window.partitionBy()))
    target = F.least((cap * F.col("source_size")).cast("double"), F.col("level") * F.col("weight"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def _ending(sums: DataFrame, step: str, before: str) -> DataFrame:
    """The range of keys in which each source's budget ends, and the words ahead of it."""
    ahead = F.sum("words").over(Window.partitionBy("source").orderBy(step)) - F.col("words") + F.col(before)
    return sums.withColumn("ahead", ahead).where("ahead < budget and budget <= ahead + words")


def _plan(drawn: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    targets = source_targets(drawn.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(CAP))).otherwise(0).cast("long")
    plan = targets.withColumn("epochs", epochs).withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size") + 0.5).cast("long"))
    plan = materialize(plan.withColumn("zero", F.lit(0).cast("long")).withColumnRenamed("source", "of"), "targets")
    same = F.col("source").eqNullSafe(F.col("of"))
    coarse = drawn.groupBy("source", "coarse").agg(F.sum("size").alias("words")).join(plan, same)
    ends = materialize(_ending(coarse, "coarse", "zero").select("of", F.col("coarse").alias("coarse_end"), F.col("ahead").alias("coarse_ahead")), "ends")
    inside = drawn.join(ends, same & (F.col("coarse") == F.col("coarse_end"))).groupBy("source", "fine").agg(F.sum("size").alias("words"))
    fine = inside.join(plan, same).drop("of").join(ends, same)
    ends2 = _ending(fine, "fine", "coarse_ahead").select("of", "coarse_end", F.col("fine").alias("fine_end"), "ahead")
    return materialize(plan.withColumnRenamed("of", "source").join(ends2.withColumnRenamed("of", "_of"), F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of", "zero").withColumnRenamed("source", "of"), "plan")


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7, carry: bool = False) -> DataFrame:
    """How many words of each document a mix takes.

    One row per row of ``docs(doc_id, text, source, ...)``: ``doc_id, size, source_size, target, taken, source, epochs``;
    with ``carry`` also ``row``, the whole input row as a struct. A source's documents are taken as often as its target
    holds all of them; what is left of the target goes to the documents with the smallest keys -ln(u) / quality weight,
    u drawn from doc_id and seed, so reruns agree. The document in which the budget ends is taken in part
    (its first words), so a source's taken words differ from its target by less than one word.

    Null or blank texts have size 0 and are never taken; null sources are one source, the last; rows of equal doc_id and
    size are told apart by nothing and may be taken in any order; an empty table gives an empty one. Prefix sums run
    over ranges of keys first, so no task sorts a whole source. Ranges are steps of the key's logarithm: a weight only shifts it, so
    whatever the weights are, a coarse range holds less than 1 % of a source in expectation, and only one finer range of it
    is ordered singly.
    """
    drawn = materialize(_drawn(docs, seed), "drawn")
    plan = _plan(drawn, weights)
    rows = _drawn(docs, seed, F.struct(*docs.columns).alias("row")) if carry else drawn
    rows = rows.join(plan, F.col("source").eqNullSafe(F.col("of")))
    at_end = F.coalesce((F.col("coarse") == F.col("coarse_end")) & (F.col("fine") == F.col("fine_end")), F.lit(False))
    ahead_of_end = F.struct("coarse", "fine") < F.struct(F.col("coarse_end").alias("coarse"), F.col("fine_end").alias("fine"))
    clear = rows.where(~at_end).withColumn("extra", F.when(F.col("fine_end").isNotNull() & ahead_of_end, F.col("size")).otherwise(F.lit(0).cast("long")))
    in_order = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.col("budget") - F.col("ahead") - (F.sum("size").over(in_order) - F.col("size"))
    last = rows.where(at_end).withColumn("extra", F.greatest(F.lit(0).cast("long"), F.least("size", left)))
    return clear.unionByName(last).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs") + F.col("extra")).alias("taken"), "source", "epochs", *["row"] * carry)
