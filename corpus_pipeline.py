"""The corpus pipeline: five stages, each over all that its predecessor kept.

Every stage takes (spark, docs, sf_dir), where docs has the columns of the table ``documents``, and returns the
same columns; the last returns what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm.decontam import without_contaminated
from corvane.llm.minhash import without_near_duplicates
from corvane.llm.mixing import mix_sources
from corvane.llm.quality import keep_good
from corvane.llm.store import materialize
from corvane.llm.substring import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near duplicates."""
    return without_near_duplicates(docs, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that an earlier document has."""
    return without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: the document's columns, its size and how many of its words go in, repeats counted.

    A column of the documents keeps its name; one of the mix that would clash with it gets the prefix "mix_".
    """
    taken = mix_sources(docs, carry=True).where("taken > 0")
    own = {c.lower() for c in docs.columns}
    told = [F.col(c).alias(f"mix_{c}" if c in own else c) for c in ("size", "source_size", "target", "taken")]
    return taken.select(*[F.col("row")[c].alias(c) for c in docs.columns], *told)


STAGES = [
    ("quality classifier", quality),
    ("minhash near-dedup", near_dedup),
    ("substring dedup", substrings),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]

#: The classifier is fitted, so SQL can't express the rows; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
