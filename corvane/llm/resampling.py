"""Importance resampling of documents towards the word distribution of a target.

Overlapped scanning: separators collapse to single spaces, and one regular expression for each n, tried at every word, emits the spans of all
runs of n words. A span's CRC names its bucket. Documents become sparse counts of buckets in one scan of the texts; everything after
works on those.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.ranking import global_ranks
from corvane.llm.store import discard, materialize
from corvane.llm.textkit import list_array, per_row_sum, slices

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
_VECTOR = "doc_id long, n_words long, n_features long, buckets array<int>, counts array<int>"
#: Letters and digits in ASCII and everything beyond it stay (capitals become small), the rest separates.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def scanners(longest: int) -> list[regex.Pattern]:
    """For each n a pattern that matches n words between separators (or the text's ends) of a text with single spaces."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}+(?![^ ])" % (n - 1)) for n in range(1, longest + 1)]


def collapsed(text: bytes) -> bytes:
    return b" ".join(text.translate(_FOLD).split())


def bucket_ids(text: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """The bucket of every feature of a collapsed text, repeats included."""
    found = [np.fromiter((crc32(text[a:b]) for a, b in (m.span() for m in p.finditer(text, overlapped=True))), np.uint32) for p in patterns]
    return (np.concatenate(found) % np.uint32(buckets)).astype(np.int32)


def _vectors(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = scanners(longest)
        for batch in batches:
            ids = batch.column("doc_id")
            for s in slices(batch.column("text")):
                words, features, at, n = [], [], [], []
                for a, b in zip(s.offs[:-1].tolist(), s.offs[1:].tolist(), strict=True):
                    text = collapsed(s.data[a:b].tobytes())
                    words.append(text.count(b" ") + 1 if text else 0)
                    found = bucket_ids(text, patterns, buckets)
                    features.append(len(found))
                    where, how_many = np.unique(found, return_counts=True)
                    at.append(where)
                    n.append(how_many.astype(np.int32))
                sizes = np.array([len(x) for x in at])
                columns = [ids.slice(s.first, s.rows), pa.array(words, pa.int64()), pa.array(features, pa.int64()), list_array(np.concatenate(at), sizes), list_array(np.concatenate(n), sizes)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "buckets", "counts"])

    return run


def feature_vectors(texts: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """``texts(doc_id, text)`` -> words, features, and how many features fall into each bucket (only those that have some)."""
    return texts.mapInArrow(_vectors(buckets, longest), _VECTOR)


def bucket_totals(vectors: DataFrame, buckets: int) -> list[int]:
    """Features of all rows in each bucket: one row for each bucket passes through the driver."""
    each = vectors.select(F.explode(F.arrays_zip("buckets", "counts")).alias("f")).groupBy("f.buckets").agg(F.sum("f.counts").alias("n"))
    totals = [0] * buckets
    for r in each.collect():
        totals[r["buckets"]] = r["n"]
    return totals


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln of a bucket's share of the target over its share of the source), with one feature more in each bucket."""
    n, all_s, all_t = len(source), sum(source) + len(source), sum(target) + len(target)
    return np.array([math.floor(1000 * math.log((float(target[i] + 1) * float(all_s)) / (float(source[i] + 1) * float(all_t)))) for i in range(n)], np.int64)


def _weighed(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = batch.column("buckets"), batch.column("counts")
            ends = np.concatenate([[0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            weights = per_row_sum(gain[at.flatten().to_numpy()] * n.flatten().to_numpy().astype(np.int64), ends)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "n_words", "n_features")] + [pa.array(weights.astype(np.int64))], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def importance_resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = 1, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Draw ``percent`` of the documents of at least ``least_words`` words, likelier the more they look like ``target``.

    One row per row of ``docs(doc_id, text, ...)``: ``doc_id, n_features, weight, score, rank``. Features are runs of 1 to
    ``longest`` words; weight sums the gains of a document's features; score adds Gumbel noise drawn from doc_id and seed, so the highest scores are a draw
    without replacement and reruns agree. ``rank`` is the place among the drawn, null for others. ``target`` needs a column ``text``.

    Null and empty texts have no features, weight 0, and are never drawn; ties of score go to the smaller doc_id (null
    first); repeated rows are drawn each for itself; an empty table of documents gives an empty one, an empty target is
    uniform; other columns are ignored. Only ``buckets`` totals pass through the driver. Counts cover all texts, whole.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = target.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vectors = materialize(feature_vectors(own, buckets, longest), "vectors")
    gain = gains(bucket_totals(vectors, buckets), bucket_totals(feature_vectors(wanted, buckets, longest), buckets))
    weighed = vectors.mapInArrow(_weighed(gain), "doc_id long, n_words long, n_features long, weight long")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = materialize(weighed.withColumn("score", (F.col("weight") + noise).cast("long")), "scored")
    discard(vectors)
    able = scored.where(F.col("n_words") >= least_words)
    last = able.count() * percent // 100
    ranked = global_ranks(able, [F.col("score").desc(), F.col("doc_id").asc_nulls_first()])
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= last, F.col("rank")))
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
