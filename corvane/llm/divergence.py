"""How far the sources of a language differ in their words.

Terms are counted by packing: up to eight bytes are one 64-bit word, up to sixteen two, sorted by radix and counted by runs; longer terms stand in
buckets by length and are sorted as bytes. Spark adds the counts of slices up; the rest is integer arithmetic on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.store import materialize
from corvane.llm.textkit import LOWER_ASCII, Slice, slices

LEAST_DOCUMENTS, SHOWN, ADDED, SCALE = 30, 50, 5, 1_000_000_000
SLICE_BYTES = 1 << 23
#: Sizes of the blocks that pairs of sources are compared in: terms, and sources on either side.
BLOCK_TERMS, TILE_SOURCES = 4096, 256
_COUNTS = "lang string, source string, term string, n long, docs long"
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True


def radix_order(words: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """A stable order by group, then by the 64-bit words, the first counting most: least digit of 16 bits first."""
    order = np.arange(len(group))
    for word in [*words[::-1], group.astype(np.uint64)]:
        for shift in range(0, 64, 16):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if digit.size and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed(data: np.ndarray, start: np.ndarray, length: np.ndarray, at: int) -> np.ndarray:
    """Eight bytes of each term from its byte ``at`` on, as big-endian words, 0 beyond its end; ``data`` has 16 bytes to spare."""
    words = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,))[start + at].astype(np.uint64)
    spare = (8 * np.clip(8 + at - length, 0, 8)).astype(np.uint64)
    low = np.minimum(spare, np.uint64(63))
    return np.where(spare == 64, np.uint64(0), (words >> low) << low)


def _runs(group: np.ndarray, row: np.ndarray, changes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where runs of one term in one group begin, their lengths, and in how many rows they are; all is in order, ``changes`` tells where terms do."""
    first = np.ones(len(group), bool)
    first[1:] = changes | (group[1:] != group[:-1])
    anew = first.copy()
    anew[1:] |= row[1:] != row[:-1]
    begin = np.flatnonzero(first)
    return begin, np.diff(np.append(begin, len(group))), np.add.reduceat(anew.astype(np.int64), begin)


def term_runs(s: Slice, code: np.ndarray) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]]:
    """The terms of a slice whose row i is of group ``code[i]``: group, term, occurrences and rows, each pair of group and term once."""
    n = len(s.data)
    if not n:
        return
    data = np.zeros(n + 16, np.uint8)
    data[:n] = LOWER_ASCII[s.data]
    solid = _LETTER[s.data]
    border = np.zeros(n + 1, bool)
    border[s.offs] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | border[1:n]
    ends[:-1] &= ~solid[1:] | border[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    length = end - start
    row = np.searchsorted(s.offs, start, "right") - 1
    group = code[row]
    raw = data.tobytes()

    def told(pick: np.ndarray, begin: np.ndarray) -> list[bytes]:
        return [raw[a:b] for a, b in zip(start[pick[begin]].tolist(), end[pick[begin]].tolist(), strict=True)]

    for count, pick in ((1, np.flatnonzero(length <= 8)), (2, np.flatnonzero((length > 8) & (length <= 16)))):
        if not len(pick):
            continue
        words = [packed(data, start[pick], length[pick], 8 * i) for i in range(count)]
        order = radix_order(words, group[pick])
        pick, words = pick[order], [w[order] for w in words]
        changes = np.logical_or.reduce([w[1:] != w[:-1] for w in words])
        begin, occurs, rows = _runs(group[pick], row[pick], changes)
        yield group[pick][begin], told(pick, begin), occurs, rows
    long = np.flatnonzero(length > 16)
    width = np.left_shift(1, np.ceil(np.log2(np.maximum(length[long], 1))).astype(np.int64))
    for w in np.unique(width).tolist():
        pick = long[width == w]
        wide = np.concatenate([data, np.zeros(w, np.uint8)])
        cells = np.lib.stride_tricks.sliding_window_view(wide, w)[start[pick]]
        cells[np.arange(w) >= length[pick][:, None]] = 0
        terms = np.ascontiguousarray(cells).view(f"S{w}").ravel()
        order = np.lexsort((row[pick], terms, group[pick]))
        pick, terms = pick[order], terms[order]
        begin, occurs, rows = _runs(group[pick], row[pick], terms[1:] != terms[:-1])
        yield group[pick][begin], told(pick, begin), occurs, rows


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of terms for each slice, and for each of its groups one row without a term."""
    for batch in batches:
        lang, source = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
        both = lang.indices.to_numpy().astype(np.int64) * max(len(source.dictionary), 1) + source.indices.to_numpy()
        for s in slices(batch.column("text"), SLICE_BYTES):
            found, code = np.unique(both[s.first : s.first + s.rows], return_inverse=True)
            langs = lang.dictionary.take(pa.array(found // max(len(source.dictionary), 1)))
            sources = source.dictionary.take(pa.array(found % max(len(source.dictionary), 1)))
            none = np.zeros(len(found), np.int64)
            yield pa.RecordBatch.from_arrays([langs, sources, pa.nulls(len(found), pa.string()), pa.array(none), pa.array(none)], names=["lang", "source", "term", "n", "docs"])
            for group, terms, occurs, rows in term_runs(s, code):
                of = pa.array(group)
                yield pa.RecordBatch.from_arrays([langs.take(of), sources.take(of), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(occurs), pa.array(rows)], names=["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of each term in each group of ``docs(lang, source, text)`` and the documents that have it.

    Each group also has one row whose term is null, even if its texts have no terms. Nulls of the three columns are empty strings.
    """
    told = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return told.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 5) / (total + 5 kept)), exactly, as a long; null where no term is kept."""
    wide = "decimal(28,0)"
    whole = F.nullif((total + ADDED * kept).cast(wide), F.lit(0).cast(wide))
    return F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (count + ADDED).cast(wide), whole).cast("long") + 1


def _block_sums(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Differences of all sources of two tiles, summed over one block of terms; rows without a term tell a source's share of terms it lacks."""
    lacks = rows[rows["term"].isna()].drop_duplicates("source").sort_values("source")
    names, tile = lacks["source"].to_numpy(object), lacks["tile"].to_numpy()
    has = rows[rows["term"].notna()]
    at, terms = pd.factorize(has["term"])
    share = np.repeat(lacks["p"].to_numpy(np.int64)[:, None], len(terms), axis=1)
    share[pd.Index(names).get_indexer(has["source"]), at] = has["p"].to_numpy(np.int64)
    near, far = np.flatnonzero(tile == key[2]), np.flatnonzero(tile == key[3])
    one, other, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in near:
        others = far[far != i]
        one.append(np.full(len(others), i))
        other.append(others)
        sums.append(np.abs(share[others] - share[i]).sum(axis=1))
    one, other, sums = np.concatenate(one), np.concatenate(other), np.concatenate(sums)
    if key[2] != key[3]:
        one, other, sums = np.concatenate([one, other]), np.concatenate([other, one]), np.concatenate([sums, sums])
    return pd.DataFrame({"lang": pd.Series([key[0]] * len(one), dtype=object), "source": pd.Series(names[one], dtype=object), "item": pd.Series(names[other], dtype=object), "value": sums})


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Summed differences of each source from each other one of its language, over blocks of terms and tiles of sources."""
    tiles = F.greatest(F.lit(1), F.ceil(F.col("sources") / TILE_SOURCES)).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") / BLOCK_TERMS)).cast("int")
    tile = F.pmod(F.xxhash64("source"), tiles).cast("int").alias("tile")
    has = shares.select("lang", "source", "term", "p", tile, F.pmod(F.xxhash64("term"), blocks).cast("int").alias("block"), tiles.alias("tiles"))
    none = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.coalesce(_share(F.lit(0), F.col("total"), F.col("kept")), F.lit(1)).alias("p"), tile, F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), tiles.alias("tiles"))
    spread = has.unionByName(none).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.select("lang", "block", F.least("tile", "other").alias("near"), F.greatest("tile", "other").alias("far"), "source", "term", "p", "tile")
    sums = spread.groupBy("lang", "block", "near", "far").applyInPandas(_block_sums, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, shown: int = SHOWN) -> DataFrame:
    """How each source of a language differs from the others, and in which terms from the language.

    ``docs(lang, source, text, ...)`` -> ``lang, source, part, item, value, rank``. A language keeps the terms that at least
    ``least_documents`` of its documents have. Shares are integers, smoothed. Part ``pair``: the summed difference from each other source;
    part ``term``: the ``shown`` terms whose share exceeds the language's most.

    Nulls are empty strings; a language whose terms are all rare has pairs of value 0 and no terms; equal values rank by the
    item's bytes; repeated rows are documents each; an empty table gives an empty one; other columns are ignored. Counts cover all texts,
    whole; no list of terms passes through the driver.
    """
    counts = materialize(term_counts(docs), "counts")
    one = Window.partitionBy("lang", "term")
    of_term = counts.where("term is not null").withColumn("df", F.sum("docs").over(one)).withColumn("total_of_term", F.sum("n").over(one)).withColumn("place", F.row_number().over(one.orderBy("source")))
    kept = materialize(of_term.where(F.col("df") >= least_documents).select("lang", "source", "term", "n", "total_of_term", (F.col("place") == 1).cast("long").alias("opens")), "kept")
    names = counts.where("term is null").select("lang", "source")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.sum("opens").alias("opens"))
    groups = names.join(totals, ["lang", "source"], "left").na.fill(0, ["total", "opens"])
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("opens").alias("kept"), F.count("*").alias("sources"))
    groups = materialize(groups.drop("opens").join(langs, "lang"), "groups")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("total"), F.col("kept")))
    above = shares.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - _share(F.col("total_of_term"), F.col("lang_total"), F.col("kept"))).alias("value")).where("value > 0")
    pairs = _pairs(shares, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    ranks = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return pairs.withColumn("rank", ranks).unionByName(above.withColumn("rank", ranks).where(F.col("rank") <= shown))
