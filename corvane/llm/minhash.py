"""Near duplicates: circulant MinHash, banding, exact Jaccard on full sets.

Two permutations make every signature coordinate: the first places a shingle, the second, shifted
circularly by k, gives coordinate k. Bands of the signature only say which documents could be
alike; whether they are is decided on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import textkit as tk
from corvane.llm.components import connected_components
from corvane.llm.store import materialize

SHINGLE = 5
ROWS, MISSED = 5, 1e-6
UNIVERSE = 1 << 18
BLOCK_DOCS, BLOCK_SHINGLES = 256, 400_000

_SKETCH = "doc_id long, text_key binary, n_words long, n_shingles long, key1 long, key2 long, bands array<long>"


def bands_for(percent: int) -> int:
    """Bands of ROWS coordinates, so many that a pair at the very threshold shares none with a chance of MISSED."""
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** ROWS)) if percent < 100 else 1


def _permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    place = np.argsort(tk.stream(11, UNIVERSE)).astype(np.int32)
    rank = np.argsort(tk.stream(12, UNIVERSE)).astype(np.int32)
    return place, np.concatenate([rank, rank[:coordinates]])


def _sketch_slice(s: tk.Slice, place: np.ndarray, rank: np.ndarray, count: int) -> dict[str, np.ndarray]:
    w = tk.words(s, tk.LOWER_ASCII[s.data])
    n_words = np.diff(w.ptr)
    g, ok = tk.grams(w, SHINGLE)
    g, row = g[ok], w.row[ok]
    n = tk.distinct_per_row(g, row, s.rows)
    n[(n_words > 0) & (n_words < SHINGLE)] = 1
    at = place[(g >> tk.U(46)).astype(np.int32)]
    full = np.flatnonzero(n_words >= SHINGLE)
    first = np.searchsorted(row, full)
    bands = np.zeros((s.rows, count), tk.U)
    if len(full):
        for b in range(count):
            acc = np.full(len(full), tk.U(b + 1))
            for k in range(b * ROWS, (b + 1) * ROWS):
                acc = tk.mix(acc * tk.U(0x9E3779B97F4A7C15) + np.minimum.reduceat(rank[k:].take(at), first).astype(tk.U))
            bands[full, b] = acc
    key1, key2 = tk.sequence_keys(w, s.rows)
    return {"n_words": n_words, "n": n, "key1": key1, "key2": key2, "bands": bands[full], "per_row": np.where(n_words >= SHINGLE, count, 0)}


def _sketches(count: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, rank = _permutations(count * ROWS)
        for batch in batches:
            ids = batch.column(0)
            for s in tk.slices(batch.column(1)):
                with np.errstate(over="ignore"):
                    x = _sketch_slice(s, place, rank, count)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.first, s.rows), batch.column(2).slice(s.first, s.rows), pa.array(x["n_words"]), pa.array(x["n"]), tk.signed(x["key1"]), tk.signed(x["key2"]), tk.list_array(x["bands"].ravel().view(np.int64), x["per_row"])],
                    names=["doc_id", "text_key", "n_words", "n_shingles", "key1", "key2", "bands"],
                )

    return run


def shingle_sets(texts: pd.Series) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted."""
    out = []
    for s in tk.slices(pa.array(texts, pa.large_string())):
        w = tk.words(s, tk.LOWER_ASCII[s.data])
        g, ok = tk.grams(w, SHINGLE)
        for i in range(s.rows):
            a, b = w.ptr[i], w.ptr[i + 1]
            out.append(np.unique(g[a:b][ok[a:b]]))
    return out


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], percent: int, left: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the graph whose links are 100 * |A & B| >= percent * |A | B|, by exact counts.

    With ``left`` only the first ``left`` sets are compared with the others, else all with all. Every pair that shares a shingle
    is counted through the posting lists; only links that join two trees are returned.
    """
    m = len(ids)
    first, left = (0, m) if left is None else (left, left)
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(m), sizes)
    flat = np.concatenate(sets) if m else np.zeros(0, tk.U)
    listed = np.flatnonzero(owner >= first)
    order = listed[np.argsort(flat[listed], kind="stable")]
    known, start, many = np.unique(flat[order], return_index=True, return_counts=True)
    post = owner[order]
    edge = np.concatenate([[0], np.cumsum(sizes)])
    parent = list(range(m))

    def find(a: int) -> int:
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    links = []
    for x in range(left if len(known) else 0):
        mine = flat[edge[x] : edge[x + 1]]
        at = np.minimum(np.searchsorted(known, mine), len(known) - 1)
        at = at[known[at] == mine]
        if not len(at):
            continue
        reps = many[at]
        spot = np.repeat(start[at] - np.concatenate([[0], np.cumsum(reps)[:-1]]), reps) + np.arange(reps.sum())
        common = np.bincount(post[spot], minlength=m)
        low = max(x + 1, first)
        hit = np.flatnonzero(100 * common[low:] >= percent * (sizes[x] + sizes[low:] - common[low:])) + low
        for y in hit[common[hit] > 0]:
            a, b = find(x), find(int(y))
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((int(ids[x]), int(ids[y])))
    return links


def comparisons(groups: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Which blocks of documents are compared: ``doc_id, component, bin, i, other, j, side``, one row per document and comparison.

    ``groups(id, component)`` are candidate groups, ``sizes(id, n_shingles)`` sizes of sets. Linked sets differ in size by a factor of
    100 / percent at most, so the bins of a large group are that wide (and 0.1 % wider, for rounding) and a bin meets itself and the
    next one only. Each bin is cut into blocks; each pair of blocks of the same or of neighbouring bins is one comparison.
    """

    def blocks() -> Column:
        return F.greatest(F.ceil(F.count("*") / BLOCK_DOCS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")

    width = math.log(100 / percent) + 1e-3
    sized = groups.join(sizes, "id")
    large = sized.groupBy("component").agg(blocks()).select("component", (F.col("blocks") > 1).alias("large"))
    binned = sized.join(large, "component").withColumn("bin", F.when(F.col("large"), F.floor(F.log(F.col("n_shingles")) / width)).otherwise(0).cast("int"))
    shape = binned.groupBy("component", "bin").agg(blocks())
    placed = binned.join(shape, ["component", "bin"]).withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) as int)"))
    near = shape.select("component", F.col("bin").alias("met"), F.col("blocks").alias("met_blocks"), F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"))
    pairs = placed.join(near, ["component", "bin"]).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("met_blocks") - 1)))
    here, there = F.struct(F.col("bin"), F.col("block")), F.struct(F.col("met").alias("bin"), F.col("with").alias("block"))
    low, high = F.least(here, there), F.greatest(here, there)
    return pairs.select(F.col("id").alias("doc_id"), "component", low["bin"].alias("bin"), low["block"].alias("i"), high["bin"].alias("other"), high["block"].alias("j"), (here > low).cast("int").alias("side"))


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, n_shingles, component_id``."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketches = materialize(source.withColumn("text_key", _text_key(F.col("text"))).mapInArrow(_sketches(bands_for(percent)), _SKETCH), "sketches")
    solid = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = solid.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"))
    # A node stands for one text; where a doc_id is the first of several texts, all but one get a number of their own.
    namesakes = F.row_number().over(Window.partitionBy("rep").orderBy("key1", "key2"))
    nodes = materialize(classes.withColumn("node", F.when(namesakes == 1, F.col("rep")).otherwise(F.xxhash64("rep", "key1", "key2"))), "nodes")

    firsts = solid.select("doc_id", "key1", "key2", "bands").join(nodes.select("key1", "key2", F.col("rep").alias("doc_id"), "node"), ["key1", "key2", "doc_id"])
    buckets = firsts.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("v"), F.max("node").alias("top")).where("v < top").drop("top")
    near = buckets.join(shared, "bucket").select(F.col("node").alias("u"), "v").where("u <> v").distinct()
    groups = materialize(connected_components(near), "groups")

    dealt = comparisons(groups, nodes.select(F.col("node").alias("id"), "n_shingles"), percent)
    dealt = dealt.withColumnRenamed("doc_id", "node").join(nodes.select("node", "rep", "key1", "key2"), "node")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        same = np.zeros(len(group), bool)
        for s in tk.slices(pa.array(group["text"], pa.large_string())):
            key1, key2 = (k.view(np.int64) for k in tk.sequence_keys(tk.words(s, tk.LOWER_ASCII[s.data]), s.rows))
            rows = slice(s.first, s.first + s.rows)
            same[rows] = (key1 == group["key1"].to_numpy()[rows]) & (key2 == group["key2"].to_numpy()[rows])
        group = group[same].drop_duplicates("node").sort_values(["side", "node"])
        across = (group["bin"] != group["other"]) | (group["i"] != group["j"])
        left = int((group["side"] == 0).sum()) if across.any() else None
        found = spanning_links(group["node"].to_numpy(), shingle_sets(group["text"]), percent, left)
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    shipped = source.withColumnRenamed("doc_id", "rep").join(dealt, "rep")
    verified = shipped.groupBy("component", "bin", "i", "other", "j").applyInPandas(compare, "u long, v long")
    linked = connected_components(verified).withColumnsRenamed({"id": "node", "component": "label"}).join(nodes.select("node", "key1", "key2", "rep"), "node")
    linked = materialize(linked, "linked")
    named = linked.join(linked.groupBy("label").agg(F.min("rep").alias("first")), "label").select("key1", "key2", "first")
    return (
        sketches.join(nodes.select("key1", "key2", "rep"), ["key1", "key2"], "left")
        .join(named, ["key1", "key2"], "left")
        .select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("first", "rep")).otherwise(F.col("doc_id"))).alias("component_id"))
    )


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> one row per row: ``doc_id, n_shingles, component_id, kept``.

    A-Z is lower-cased; a set holds the distinct 5-word shingles, with fewer words the whole sequence as one.
    Two documents are linked if 100 * |A & B| >= percent * |A | B|; ``component_id`` is the smallest doc_id that can be
    reached and ``kept`` says whether it is the row's own.

    Null or blank texts have no shingle and are linked with nothing; a row without doc_id keeps a null component and is
    kept; repeated rows get the same answer each; different texts of one doc_id are linked as if they were different documents; an
    empty table gives an empty one; other columns are not read, so
    their names don't matter. Equal texts are first reduced to one representative, so a group of copies of any size
    costs one row each. Documents that share a band form a candidate group; a large group is cut by size of set, then into
    blocks, and each pair of blocks that can hold a link is compared on its own, so that no task holds more than two blocks.
    """
    rows = _grouped(docs, percent).drop("text_key")
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` less the rows that ``near_duplicates`` doesn't keep, by doc_id and text; equal rows stay or go together. Columns stay."""
    told = _grouped(docs, percent).where("doc_id is not null").select("doc_id", "text_key", (F.col("doc_id") != F.col("component_id")).alias("out"))
    told = materialize(told.distinct(), "told")
    # Most ids have one text: those that lose all they have are known by their number alone, which keeps that table small.
    ids = told.groupBy("doc_id").agg(F.bool_or("out").alias("some"), F.bool_and("out").alias("all")).where("some")
    ids = materialize(ids, "ids")
    gone = materialize(ids.where("all").select(F.col("doc_id").alias("gone_id")), "gone")
    mixed = materialize(told.where("out").join(ids.where("not all"), "doc_id", "left_semi").select(F.col("doc_id").alias("mixed_id"), F.col("text_key").alias("mixed_key")), "mixed")
    row = docs.select(F.col("doc_id").cast("long").alias("id"), _text_key(F.col("text")).alias("text_key"), F.struct(*docs.columns).alias("row"))
    left = row.join(gone, F.col("id") == F.col("gone_id"), "left_anti")
    return left.join(mixed, (F.col("id") == F.col("mixed_id")) & (F.col("text_key") == F.col("mixed_key")), "left_anti").select("row.*")
