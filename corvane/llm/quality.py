"""Quality classifier: a generalised additive model with pairwise interactions.

Features are cut into bins once; boosting visits them in turn and adds a shallow tree over the bins
of one feature (or of one pair) to that feature's lookup table. A score is a sum of table entries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import textkit as tk
from corvane.llm.store import materialize

FEATURES = (
    "log_words", "word_bytes", "distinct_words", "repeated_neighbours", "symbols", "capitals", "digits",
    "exclamations", "bars", "sentence_ends", "words_per_line", "repeated_passages", "non_ascii",
)
BINS, COARSE, PAIRS = 32, 8, 6
ROUNDS, RATE, SMOOTH = 120, 0.15, 1.0
#: At most about so many labelled rows are fitted; which ones, a hash of the doc_id decides.
FIT_ROWS = 30_000


def _class(chars: str) -> np.ndarray:
    x = np.zeros(256, bool)
    x[list(chars.encode())] = True
    return x


_SYMBOL, _DIGIT, _BANG, _BAR, _END = map(_class, ("#$%&*<>{}[]\\^~=_@", "0123456789", "!", "|", ".!?;:"))
_UPPER, _LETTER, _LINE = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"), _class("\n")
_HIGH = np.arange(256) >= 128


def features(s: tk.Slice) -> np.ndarray:
    """The features of each row of a slice; all zero for a text without words."""
    w = tk.words(s)
    n, size, row = np.diff(w.ptr), np.diff(s.offs), w.row
    words, room = np.maximum(n, 1), np.maximum(size, 1)

    def share(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
        return tk.per_row_sum(kind[s.data], s.offs) / of

    neighbours = np.zeros(len(w.hash), bool)
    neighbours[1:] = (w.hash[1:] == w.hash[:-1]) & (row[1:] == row[:-1])
    g, ok = tk.grams(w, 5)
    passages = np.bincount(row[ok], minlength=s.rows)
    lines = tk.per_row_sum(_LINE[s.data], s.offs) + 1
    out = np.stack(
        [
            np.log1p(n),
            tk.per_row_sum(w.end - w.start, w.ptr) / words,
            tk.distinct_per_row(w.hash, row, s.rows) / words,
            tk.per_row_sum(neighbours, w.ptr) / words,
            share(_SYMBOL, room),
            share(_UPPER, np.maximum(tk.per_row_sum(_LETTER[s.data], s.offs), 1)),
            share(_DIGIT, room),
            share(_BANG, words),
            share(_BAR, words),
            tk.per_row_sum(_END[s.data[w.end - 1]] if len(w.end) else np.zeros(0, bool), w.ptr) / words,
            np.log1p(n / lines),
            1 - tk.distinct_per_row(g[ok], row[ok], s.rows) / np.maximum(passages, 1),
            share(_HIGH, room),
        ],
        axis=1,
    )
    out[passages == 0, FEATURES.index("repeated_passages")] = 0
    out[n == 0] = 0
    return out


@dataclass
class Model:
    """Lookup tables: ``tables[f]`` over the bins of feature f, ``grids[i]`` over the coarse bins of ``pairs[i]``."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for (a, b), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[np.searchsorted(self.coarse[a], x[:, a], "right"), np.searchsorted(self.coarse[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins with gradient and curvature sums g, h."""
    if len(g) < 2:
        return 0.0, 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a**2 / (b + SMOOTH) + (g.sum() - a) ** 2 / (h.sum() - b + SMOOTH) - g.sum() ** 2 / (h.sum() + SMOOTH)
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return RATE * g.sum() / (h.sum() + SMOOTH)


def _line_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of up to four leaves over the bins of one feature, as a table."""
    out = np.zeros(len(g))
    _, mid = _best_cut(g, h)
    for lo, hi in ((0, mid), (mid, len(g))):
        gain, at = _best_cut(g[lo:hi], h[lo:hi])
        for a, b in ((lo, lo + at), (lo + at, hi)) if gain > 1e-9 else ((lo, hi),):
            if b > a:
                out[a:b] = _leaf(g[a:b], h[a:b])
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree over two features: one cut of the rows of the grid, then one of the columns on either side."""
    best, out = 0.0, np.zeros_like(g)
    for cut in range(1, g.shape[0]):
        gain, table = 0.0, np.zeros_like(g)
        for part in (slice(0, cut), slice(cut, None)):
            gs, hs = g[part].sum(0), h[part].sum(0)
            more, at = _best_cut(gs, hs)
            gain += more + gs.sum() ** 2 / (hs.sum() + SMOOTH)
            for cols in (slice(0, at), slice(at, None)):
                table[part, cols] = _leaf(gs[cols], hs[cols]) if gs[cols].size else 0
        if gain > best:
            best, out = gain, table
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of single features first, then of the pairs that explain most of what is left."""
    rate = (y.sum() + 0.5) / (len(y) + 1)
    edges = [_cut_points(x[:, f], BINS) for f in range(x.shape[1])]
    coarse = [_cut_points(x[:, f], COARSE) for f in range(x.shape[1])]
    model = Model(edges, coarse, float(np.log(rate / (1 - rate))), [np.zeros(len(e) + 1) for e in edges])
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]
    wide = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(coarse)]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            r, c = slopes()
            size = len(model.tables[f])
            step = _line_tree(np.bincount(b, r, size), np.bincount(b, c, size))
            model.tables[f] += step
            total += step[b]

    shapes = [len(e) + 1 for e in coarse]

    def grid(a: int, b: int, r: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell, size = wide[a] * shapes[b] + wide[b], shapes[a] * shapes[b]
        return np.bincount(cell, r, size).reshape(shapes[a], shapes[b]), np.bincount(cell, c, size).reshape(shapes[a], shapes[b])

    r, c = slopes()
    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_grid_tree(*grid(*p, r, c))[0])
    model.pairs = ranked[:PAIRS]
    model.grids = [np.zeros((shapes[a], shapes[b])) for a, b in model.pairs]
    for _ in range(ROUNDS // 4):
        for i, (a, b) in enumerate(model.pairs):
            _, step = _grid_tree(*grid(a, b, *slopes()))
            model.grids[i] += step
            total += step[wide[a], wide[b]]
    return model


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in tk.slices(batch.column(1)):
            x = features(s)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(s.first, s.rows), tk.list_array(x.ravel(), np.full(s.rows, x.shape[1]))], names=["doc_id", "x"])


def document_features(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the features of every row of ``docs(doc_id, text, ...)``, over whole texts."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_feature_rows, "doc_id long, x array<double>")


def held_out(fold: int, folds: int):
    """Whether the checksum of the doc_id as text falls in the fold kept from learning; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit_quality(measured: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model from ``measured(doc_id, x)`` and ``labels(doc_id, quality)``, on rows outside the fold that is kept back.

    Rows whose quality is null teach nothing; a document with several labels counts with each of them. Without any label,
    or with labels of one kind, scores are that kind's share.
    """
    known = labels.where("quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    known = known.join(measured, "doc_id").where(~held_out(1, 3))
    n = known.count()
    spread = F.shiftrightunsigned(F.xxhash64("doc_id"), 2)
    rows = known.where(spread < math.ceil((1 << 62) * min(1.0, fit_rows / max(n, 1)))).orderBy("doc_id", "y", "x").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy(float))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: ``doc_id, held_out, score, predicted``.

    Scores depend on the text alone. Null and blank texts have all features 0 and are scored like any other; equal
    texts get equal scores; an empty table gives an empty one; other columns are not read.
    """
    measured = materialize(document_features(docs), "features")
    model = measured.sparkSession.sparkContext.broadcast(fit_quality(measured, labels))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model.value.score(np.array(x.tolist(), float).reshape(len(x), len(FEATURES))))

    scored = measured.select("doc_id", held_out(1, 3).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; texts are measured where they lie and not shuffled."""
    measured = materialize(document_features(docs), "features")
    model = measured.sparkSession.sparkContext.broadcast(fit_quality(measured, labels))
    place = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in tk.slices(batch.column(place)):
                yield batch.slice(s.first, s.rows).filter(pa.array(model.value.score(features(s)) >= 0.5))

    return docs.mapInArrow(good, docs.schema)
