"""Substring dedup by prefix-partitioned suffix trees, sparse ones.

A passage of 50 words repeats if two suffixes of documents begin with it. Suffixes are not all kept: each window of 50 words
chooses the one that begins at its least 10-word hash, so equal windows choose equal suffixes, and what stands ahead of the
suffix comes as its left context.

1. Suffixes are grouped by their first 10 words; groups of one document are leaves, and go. Suffixes whose whole
   surroundings are equal are one path, of which the smallest document is noted. A path that a document repeats, as lines
   that it says over and over do, is one row of that document, with all its places.
2. Groups that are small enough for memory become trees: the suffixes in order with the lengths of their common prefixes
   are the tree's leaves and inner nodes. Two trees are made, of right and of left contexts; a window is an inner node of the
   one at 50 - k words and of the other at k words, and repeats if these two share a leaf of a smaller document.
3. Groups that are too large have their prefixes grown to all 50 words. Each is one node then, and its smallest document is found by
   an aggregation that no task has to hold.

Words are compared as they stand inside a tree; paths, and nodes of large groups, by 128 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import textkit as tk
from corvane.llm.skew import join_hot
from corvane.llm.store import discard, materialize

WINDOW, ANCHOR = 50, 10
#: A group of so many words is the largest that becomes a tree in memory; smaller groups are worked off together up to so many bytes of text.
GROUP_WORDS, BATCH_BYTES = 1_000_000, 1 << 23

_RUN = "struct<anchor:long,path1:long,path2:long,starts:array<int>,len:int,lead:int>"
_PROFILE = f"doc_id long, text_key binary, n_words long, key1 long, key2 long, words_sha256 string, runs array<{_RUN}>"
_SUFFIX = "anchor long, path1 long, path2 long, doc_id long, lead int, len int, text binary"
_REPEAT = "anchor long, path1 long, path2 long, doc_id long, at int, n int"
_NODE = "anchor long, path1 long, path2 long, doc_id long, at int, node1 long, node2 long"
_CUT = "doc_id long, key1 long, key2 long, n_removed long, kept_text string, kept_sha256 string"
_PATH = ["anchor", "path1", "path2"]


def _range_hashes(w: tk.Words, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the words start:end, for each pair of these arrays."""
    up, down = tk._power_tables(len(w.hash) + 1)
    out = []
    with np.errstate(over="ignore"):
        for values in (w.hash, tk.mix(w.hash ^ tk.U(0x452821E638D01377))):
            total = np.concatenate([np.zeros(1, tk.U), np.cumsum(values * up[: len(values)], dtype=tk.U)])
            out.append(tk.mix((total[end] - total[start]) * down[start] + (end - start).astype(tk.U) + np.asarray(salt, tk.U) * tk.U(0x9E3779B97F4A7C15)))
    return out[0], out[1]


def _first_least(x: np.ndarray, k: int) -> np.ndarray:
    """Where the first minimum of each ``k`` consecutive values is, by doubling."""
    at, reach = np.arange(len(x)), 1

    def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(x[b] < x[a], b, a)

    while 2 * reach <= k:
        at = least(at[:-reach], at[reach:])
        reach *= 2
    n, rest = len(x) - k + 1, k - reach
    return least(at[:n], at[rest : rest + n]) if rest else at


def _runs(w: tk.Words, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows, suffix's place in the first window, its prefix's hash and path hashes of each run of windows that choose one suffix."""
    none = np.zeros(0, np.int64)
    empty = (none, none, none, none, none.astype(tk.U), none.astype(tk.U), none.astype(tk.U))
    if len(w.hash) < window:
        return empty
    prefix = tk.rolling(w, anchor)
    chosen = _first_least(prefix, window - anchor + 1)
    row = w.row[: len(chosen)]
    valid = np.flatnonzero(np.arange(len(chosen)) + window <= w.ptr[1:][row])
    if not len(valid):
        return empty
    suffix = chosen[valid]
    new = np.ones(len(valid), bool)
    new[1:] = suffix[1:] != suffix[:-1]
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(valid)))
    first, suffix = valid[at], suffix[at]
    path1, path2 = _range_hashes(w, first, first + length + window - 1, suffix - first)
    r = row[first]
    return r, first - w.ptr[:-1][r], length, suffix - first, prefix[suffix], path1, path2


def _once(row: np.ndarray, path1: np.ndarray, path2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts the runs of one row with one path together, and where each such group begins (and the last one ends)."""
    order = np.lexsort((path2, path1, row))
    keys = np.stack([row.astype(tk.U), path1, path2])[:, order]
    new = np.ones(len(row) + 1, bool)
    new[1:-1] = (keys[:, 1:] != keys[:, :-1]).any(0)
    return order, np.flatnonzero(new)


def _profiles(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for s in tk.slices(batch.column(1)):
                w = tk.words(s)
                text, ptr = tk.joined(s, w)
                sha = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
                row, start, length, lead, a, path1, path2 = _runs(w, window, anchor)
                key1, key2 = tk.sequence_keys(w, s.rows)
                order, group = _once(row, path1, path2)
                first = order[group[:-1]]
                starts = pa.ListArray.from_arrays(pa.array(group.astype(np.int32)), pa.array(start[order].astype(np.int32)))
                entries = pa.StructArray.from_arrays(
                    [*(tk.signed(x[first]) for x in (a, path1, path2)), starts, *(pa.array(x[first].astype(np.int32)) for x in (length, lead))], names=["anchor", "path1", "path2", "starts", "len", "lead"]
                )
                edge = np.concatenate([[0], np.cumsum(np.bincount(row[first], minlength=s.rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(s.first, s.rows), batch.column(2).slice(s.first, s.rows), pa.array(np.diff(w.ptr)), tk.signed(key1), tk.signed(key2), pa.array(sha), pa.ListArray.from_arrays(pa.array(edge), entries)],
                    names=["doc_id", "text_key", "n_words", "key1", "key2", "words_sha256", "runs"],
                )

    return run


def _spans(column: pa.Array, i: int) -> np.ndarray:
    """The (first window, number of windows) pairs of row ``i``, whose spans lie ``at`` windows behind each of their ``starts``."""
    x = column.slice(i, 1).flatten()
    many = x.field("starts").value_lengths().to_numpy() if len(x) else np.zeros(0, np.int64)
    if not many.sum():
        return np.zeros((0, 2), np.int64)
    at, n = (np.repeat(x.field(c).to_numpy(), many) for c in ("at", "len"))
    return np.stack([x.field("starts").flatten().to_numpy() + at, n], 1).astype(np.int64)


def _same(s: tk.Slice, w: tk.Words, batch: pa.RecordBatch) -> np.ndarray:
    """Which rows hold the very words that their keys were made from."""
    key1, key2 = tk.sequence_keys(w, s.rows)
    at = slice(s.first, s.first + s.rows)
    return (key1.view(np.int64) == batch.column("key1").to_numpy()[at]) & (key2.view(np.int64) == batch.column("key2").to_numpy()[at])


def _opened(window: int, nodes: bool):
    """The runs asked for of ``(doc_id, text, key1, key2, runs)``: each with its text, or (``nodes``) with the hashes of its windows, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column("runs")
            for s in tk.slices(batch.column("text")):
                w = tk.words(s)
                own = np.flatnonzero(_same(s, w, batch))
                if not len(own):
                    continue
                told = [runs.slice(s.first + int(i), 1).flatten() for i in own]
                asked = pa.concat_arrays(told)
                row = np.repeat(own, [len(x) for x in told])
                start, n = (asked.field(c).to_numpy() for c in ("start", "len"))
                first = w.ptr[:-1][row] + start
                ids = batch.column("doc_id").take(pa.array(row + s.first))
                if nodes:
                    many = np.repeat(np.arange(len(first)), n)
                    at = np.arange(len(many)) - np.repeat(np.cumsum(n) - n, n)
                    begin = first[many] + at
                    one, two = _range_hashes(w, begin, begin + window)
                    take = pa.array(many)
                    yield pa.RecordBatch.from_arrays([*(asked.field(c).take(take) for c in _PATH), ids.take(take), pa.array(at.astype(np.int32)), tk.signed(one), tk.signed(two)], names=[*_PATH, "doc_id", "at", "node1", "node2"])
                else:
                    texts = [s.data[a:b].tobytes() for a, b in zip(w.start[first], w.end[first + n + window - 2], strict=True)]
                    yield pa.RecordBatch.from_arrays([*(asked.field(c) for c in _PATH), ids, asked.field("lead"), asked.field("len"), pa.array(texts, pa.binary())], names=[*_PATH, "doc_id", "lead", "len", "text"])

    return run


def _tree(group: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix trees of all groups: order of the leaves, and how many words each has in common with the leaf ahead (-1: other group)."""
    wide = np.column_stack([group, contexts]).astype(">u4")
    order = np.argsort(np.ascontiguousarray(wide).view(f"V{4 * wide.shape[1]}")[:, 0], kind="stable")
    leaves = wide[order]
    differ = leaves[1:] != leaves[:-1]
    common = np.where(differ.any(1), differ.argmax(1), wide.shape[1]) - 1
    return order, np.concatenate([[-1], common])


def _nodes(tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """Each leaf's ancestor at a depth, as the number of the first leaf below it."""
    order, common = tree
    first = np.maximum.accumulate(np.where(common < depth, np.arange(len(order)), 0))
    out = np.empty(len(order), np.int64)
    out[order] = first
    return out


def _word_numbers(data: np.ndarray, w: tk.Words) -> np.ndarray:
    """Numbers from 1 that tell the words apart as they stand."""
    solid = data[~tk.IS_SEP[data]]
    edge = np.concatenate([[0], np.cumsum(w.end - w.start)]).astype(np.int64)
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(w.start), [None, pa.py_buffer(edge), pa.py_buffer(solid)])
    return array.dictionary_encode().indices.to_numpy() + 1


def repeated_windows(table: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of whole groups of suffixes: which rows have windows that a smaller document has too, and where, as spans (row, first window, number)."""
    none = np.zeros(0, np.int64)
    if not table.num_rows:
        return none, none, none
    texts = pc.cast(table.column("text"), pa.large_binary()).combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    s = next(tk.slices(texts.view(pa.large_string()), 1 << 62))
    w = tk.words(s)
    word = _word_numbers(s.data, w)
    anchor, doc, lead, n = (table.column(c).to_numpy() for c in ("anchor", "doc_id", "lead", "len"))
    _, group = np.unique(anchor, return_inverse=True)
    begin, end = w.ptr[:-1], w.ptr[1:]
    at = begin + lead

    def context(step: np.ndarray) -> np.ndarray:
        place = at[:, None] + step
        inside = (place >= begin[:, None]) & (place < end[:, None])
        return np.where(inside, word[np.clip(place, 0, len(word) - 1)], 0)

    width = int(lead.max())
    right, left = _tree(group, context(np.arange(window))), _tree(group, context(-1 - np.arange(width)))
    again = np.zeros((len(doc), width + 3), bool)
    for k in range(width + 1):
        rows = np.flatnonzero((lead >= k) & (lead - n + 1 <= k))
        if not len(rows):
            continue
        node = _nodes(right, window - k)[rows] * len(doc) + _nodes(left, k)[rows]
        order = np.argsort(node, kind="stable")
        new = np.ones(len(rows), bool)
        new[1:] = node[order][1:] != node[order][:-1]
        least = np.minimum.reduceat(doc[rows][order], np.flatnonzero(new))[np.cumsum(new) - 1]
        hit = rows[order[least < doc[rows][order]]]
        again[hit, lead[hit] - k + 1] = True
    row, first = np.nonzero(again[:, 1:] & ~again[:, :-1])
    _, last = np.nonzero(again[:, :-1] & ~again[:, 1:])
    return row, first, last - first


def _trees(window: int):
    """Work off groups of suffixes that come in order of their prefix, whole groups at a time."""

    def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        row, at, n = repeated_windows(table, window)
        take = pa.array(row)
        told = [table.column(c).take(take).combine_chunks() for c in (*_PATH, "doc_id")]
        told = [x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type) for x in told]
        return pa.RecordBatch.from_arrays([*told, pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=[*_PATH, "doc_id", "at", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not len(batch):
                continue
            anchor = batch.column("anchor").to_numpy()
            change = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            if held and held[-1].column("anchor")[-1].as_py() != anchor[0]:
                change = np.concatenate([[0], change])
            if len(change) and size + batch.nbytes > BATCH_BYTES:
                cut = int(change[-1])
                yield answer([*held, batch.slice(0, cut)])
                held, size, batch = [], 0, batch.slice(cut)
            held.append(batch)
            size += batch.nbytes
        if held:
            yield answer(held)

    return run


def _cut(window: int):
    """Take the words covered by repeated windows out of ``(doc_id, text, key1, key2, spans)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            for s in tk.slices(batch.column("text")):
                w = tk.words(s)
                same = _same(s, w, batch)
                depth = np.zeros(len(w.hash) + 1, np.int64)
                for i in np.flatnonzero(same):
                    x = _spans(spans, s.first + int(i)) + w.ptr[i]
                    np.add.at(depth, x[:, 0], 1)
                    np.add.at(depth, x.sum(1) - w.ptr[i] + window - 1, -1)
                keep = np.cumsum(depth[:-1]) == 0
                text, ptr = tk.joined(s, w, keep)
                parts = [text[a:b].tobytes() for a, b in zip(ptr[:-1], ptr[1:], strict=True)]
                out = pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(s.first, s.rows) for c in ("doc_id", "key1", "key2")]
                    + [pa.array(tk.per_row_sum(~keep, w.ptr)), pa.array(parts, pa.binary()).cast(pa.string()), pa.array([hashlib.sha256(p).hexdigest() for p in parts])],
                    names=["doc_id", "key1", "key2", "n_removed", "kept_text", "kept_sha256"],
                )
                yield out.filter(pa.array(same))

    return run


def repeated_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame]:
    """Windows of ``window`` words that also start in a document with a smaller doc_id.

    Returns ``profiles(doc_id, text_key, n_words, key1, key2, words_sha256, rep)``, one row per row of ``docs(doc_id, text, ...)``, and
    ``cuts(doc_id, key1, key2, n_removed, kept_text, kept_sha256)`` for the documents that lose some words. A row whose ``rep``
    is smaller than its doc_id has the same words as that document, and loses all of them if it has a window at all.

    Words are runs of bytes other than blanks and line ends, as they stand. Null and blank texts have no words; rows without
    doc_id lose nothing and take nothing; rows with the same doc_id don't repeat each other, whether their texts are the same or not; an empty
    table gives empty tables. Only ``doc_id`` and ``text`` are read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = materialize(source.withColumn("text_key", text_key(F.col("text"))).mapInArrow(_profiles(window, anchor), _PROFILE), "profiles")
    able = profile.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    classes = able.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    copied = materialize(classes.where("copies > 1").drop("copies"), "copied")

    firsts = able.join(copied, ["key1", "key2"], "left").where("rep is null or rep = doc_id")
    runs = firsts.select("doc_id", "key1", "key2", F.explode("runs").alias("run")).select("doc_id", "key1", "key2", "run.*")
    spread = [F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")]
    inner = materialize(runs.groupBy("anchor").agg(*spread).where("low < high").select("anchor", "n"), "inner")
    alive = materialize(join_hot(runs, inner, ["anchor"], "doc_id"), "alive")
    paths = materialize(alive.groupBy(*_PATH).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "paths")
    traced = materialize(join_hot(alive, paths, _PATH, "doc_id"), "traced")
    discard(inner, alive, paths)

    whole = traced.where("doc_id > least").select("doc_id", "key1", "key2", "starts", F.lit(0).alias("at"), "len")
    unique = traced.where("doc_id = least").withColumn("start", F.col("starts")[0]).drop("starts").dropDuplicates(_PATH)
    forks = unique.groupBy("anchor").agg(*spread, F.sum(F.col("len") + (window - 1)).alias("words")).where("low < high").select("anchor", "n", (F.col("words") > GROUP_WORDS).alias("large"))
    forked = join_hot(unique, materialize(forks, "forks"), ["anchor"], "doc_id")
    wanted = forked.groupBy("doc_id", "key1", "key2", "large").agg(F.collect_list(F.struct(*_PATH, "start", "len", "lead")).alias("runs"))
    wanted = materialize(wanted, "wanted")
    affected = materialize(source.join(traced.select("doc_id").distinct(), "doc_id"), "affected")
    opened = affected.join(wanted, "doc_id").select("doc_id", "text", "key1", "key2", "runs", "large")

    suffixes = opened.where("not large").drop("large").mapInArrow(_opened(window, False), _SUFFIX)
    small = suffixes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_trees(window), _REPEAT)
    nodes = materialize(opened.where("large").drop("large").mapInArrow(_opened(window, True), _NODE), "nodes")
    firstly = materialize(nodes.groupBy("node1", "node2").agg(*spread).where("low < high").select("node1", "node2", "low", "n"), "firstly")
    large = join_hot(nodes, firstly, ["node1", "node2"], "path1").where("doc_id > low").select(*_PATH, "doc_id", "at", F.lit(1).alias("n"))
    repeats = materialize(small.union(large).distinct(), "repeats")
    part = repeats.join(traced.where("doc_id = least").select(*_PATH, "doc_id", "key1", "key2", "starts"), [*_PATH, "doc_id"])
    part = part.select("doc_id", "key1", "key2", "starts", "at", F.col("n").alias("len"))

    spans = whole.union(part).groupBy("doc_id", "key1", "key2").agg(F.collect_list(F.struct("starts", "at", "len")).alias("spans"))
    cuts = affected.join(spans, "doc_id").select("doc_id", "text", "key1", "key2", "spans").mapInArrow(_cut(window), _CUT)
    cuts = cuts.dropDuplicates(["doc_id", "key1", "key2"])
    profiles = profile.drop("runs").join(copied, ["key1", "key2"], "left")
    return profiles, cuts


def text_key(text: Column) -> Column:
    """What tells texts apart, null counting as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: ``doc_id, n_words, n_removed, kept_sha256``; see ``repeated_passages``."""
    profiles, cuts = repeated_passages(docs, window)
    copy = (F.col("rep") < F.col("doc_id")) & (F.col("n_words") >= window)
    return profiles.join(cuts.drop("kept_text"), ["doc_id", "key1", "key2"], "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "words_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text`` (and ``n_chars`` counted anew); other texts stay as they are.

    A text that loses words has the rest joined by single spaces. Columns and rows stay, rows being known by doc_id and text.
    """
    profiles, cuts = repeated_passages(docs, window)
    told = profiles.select("doc_id", "text_key", "key1", "key2", "n_words", "rep").distinct()
    copy = (F.col("rep") < F.col("doc_id")) & (F.col("n_words") >= window)
    lost = told.where(copy).select("doc_id", "text_key", F.lit("").alias("kept"))
    cut = cuts.where("n_removed > 0").select("doc_id", "key1", "key2", F.col("kept_text").alias("kept"))
    lost = lost.union(told.where(~F.coalesce(copy, F.lit(False))).join(cut, ["doc_id", "key1", "key2"]).select("doc_id", "text_key", "kept"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"))
    out = rows.join(lost, ["doc_id", "text_key"], "left")
    new = {"text": F.coalesce(F.col("kept"), F.col("row.text")), "n_chars": F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("row")["n_chars"]) if "n_chars" in docs.columns else None}
    return out.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
