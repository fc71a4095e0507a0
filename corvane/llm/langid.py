"""Language identification, word first: known words by their frequency in each language, others by shorter and shorter n-grams."""

from __future__ import annotations

import math
import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.store import discard, materialize

#: Longest n-gram an unseen word backs off to, and the factor that each step back costs.
LONGEST, BACK_OFF = 4, 0.4
#: At most about so many documents of each language are learned from, chosen by a hash; what they say once only is not learned.
FIT_DOCS, SEEN = 5_000, 2
#: A worker remembers so many words, and those of the texts at hand, of which it takes so many together.
REMEMBERED, TOGETHER = 300_000, 64

def _ranges(kinds: str) -> str:
    """The code points of some general categories (by their first letter), as ranges of a character class."""
    spans: list[list[int]] = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c))[0] in kinds:
            if spans and spans[-1][1] == c - 1:
                spans[-1][1] = c
            else:
                spans.append([c, c])
    return "".join(rf"\U{a:08x}-\U{b:08x}" for a, b in spans)


#: A word is a letter, and letters and marks (vowel signs, accents) that follow it.
_WORD = re.compile(f"[{_ranges('L')}][{_ranges('LM')}]*")
#: The same for texts of the first 256 code points, which have no marks and whose small letters are few.
_WEST = re.compile("[a-zªµºß-öø-ÿ]+")


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word with its edges marked; single letters are taken without edges."""
    marked = word if n == 1 else f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def tokens(text: str) -> list[str]:
    low = text.lower()
    try:
        low.encode("latin-1")
    except UnicodeEncodeError:
        return _WORD.findall(low)
    return _WEST.findall(low)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (size 0) and n-grams (size n) by language, summed over each batch."""
    for batch in batches:
        words = defaultdict(Counter)
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words[lang].update(tokens(text or ""))
        rows = []
        for lang, seen in words.items():
            pieces = [Counter() for _ in range(LONGEST)]
            for word, n in seen.items():
                for size in range(1, LONGEST + 1):
                    for g in grams(word, size):
                        pieces[size - 1][g] += n
            rows += [(lang, size, k, n) for size, c in enumerate([seen, *pieces]) for k, n in c.items()]
        for i in range(0, len(rows), 50_000):
            part = rows[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*part, strict=True), (pa.string(), pa.int32(), pa.string(), pa.int64()), strict=True)], names=["lang", "size", "entry", "n"])


def learning(fold: int = 2, folds: int = 4):
    """Whether a row may be learned from: it has a language and is outside the fold that is kept back."""
    return F.col("lang").isNotNull() & ~held_out(fold, folds)


def held_out(fold: int = 2, folds: int = 4):
    """Whether the checksum of the doc_id as text falls in the fold; false without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


class Model:
    """Log frequencies of words (table 0) and n-grams (table n); an entry has numbers for the languages it was seen in only.

    ``places[size]`` numbers the entries of a table; entry i has the languages ``langs_of[size][start:end]`` and as many values,
    start and end being ``edges[size][i:i + 2]``.
    """

    def __init__(self, langs: list[str], counts: Iterable[tuple[str, int, str, int]], totals: dict[tuple[str, int], int]):
        self.langs = langs
        place = {x: i for i, x in enumerate(langs)}
        sums = [np.array([totals.get((x, size), 0) for x in langs], float) + 1 for size in range(LONGEST + 1)]
        self.floor = [-np.log(total * 2) for total in sums]
        self.places: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        told: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in range(LONGEST + 1)]
        for lang, size, entry, n in counts:
            for column, x in zip(told[size], (self.places[size].setdefault(entry, len(self.places[size])), place[lang], n), strict=True):
                column.append(x)
        self.edges, self.langs_of, self.values = [], [], []
        for size, (entry, lang, n) in enumerate(told):
            order = np.argsort(np.array(entry, np.int64), kind="stable")
            of = np.array(lang, np.int64)[order]
            self.edges.append(np.searchsorted(np.array(entry, np.int64)[order], np.arange(len(self.places[size]) + 1)))
            self.langs_of.append(of)
            self.values.append(np.log((np.array(n, float)[order] + 0.5) / sums[size][of]))
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(langs)))

    def _entries(self, size: int, at: list[int]) -> np.ndarray:
        """The log frequencies of entries in all languages; where one was not seen, half a count."""
        out = np.tile(self.floor[size], (len(at), 1))
        start, end = self.edges[size][at], self.edges[size][np.array(at, np.int64) + 1]
        n = end - start
        flat = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
        out[np.repeat(np.arange(len(at)), n), self.langs_of[size][flat]] = self.values[size][flat]
        return out

    def learn(self, words: list[str]) -> np.ndarray:
        """Log frequencies of words: their own if they are known, else the mean of their n-grams', which back off to shorter ones where most are unseen."""
        out = np.tile(self.floor[0], (len(words), 1))
        own = [self.places[0].get(w) for w in words]
        found = [i for i, x in enumerate(own) if x is not None]
        if found:
            out[found] = self._entries(0, [own[i] for i in found])
        left = [i for i, x in enumerate(own) if x is None]
        for size in range(LONGEST, 0, -1):
            place, done, flat, hits, pieces, rest = self.places[size].get, [], [], [], [], []
            for i in left:
                parts = grams(words[i], size)
                seen = [x for x in map(place, parts) if x is not None]
                if len(seen) * 2 > len(parts):
                    done.append(i)
                    flat += seen
                    hits.append(len(seen))
                    pieces.append(len(parts))
                else:
                    rest.append(i)
            if done:
                n, parts = np.array(hits), np.array(pieces)[:, None]
                total = np.add.reduceat(self._entries(size, flat), np.cumsum(n) - n, axis=0)
                out[done] = (total + (parts - n[:, None]) * self.floor[size]) / parts + (LONGEST - size + 1) * math.log(BACK_OFF)
            left = rest
        return out

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Each text's likeliest language and its posterior; ``und`` with 0 if there is no letter or no language."""
        if not self.langs:
            return [("und", 0.0)] * len(texts)
        counted = [Counter(tokens(t)) if t else None for t in texts]
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        new = list({w: None for c in counted if c for w in c if w not in self.known})
        if new:
            begin = len(self.known)
            self.known.update(zip(new, range(begin, begin + len(new)), strict=True))
            if len(self.known) > len(self.rows):
                self.rows = np.concatenate([self.rows[:begin], np.zeros((max(len(self.known), 2 * begin) - begin, len(self.langs)))])
            self.rows[begin : begin + len(new)] = self.learn(new)
        out = []
        for c in counted:
            if not c:
                out.append(("und", 0.0))
                continue
            total = np.fromiter(c.values(), float, len(c)) @ self.rows[np.fromiter(map(self.known.__getitem__, c), np.int64, len(c))]
            total = np.exp(np.maximum(total - total.max(), -700))
            best = int(np.argmax(total))
            out.append((self.langs[best], float(total[best] / total.sum())))
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def fit_languages(docs: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """Learn from ``docs(doc_id, text, lang)``: counts are made by Spark, entries that were seen twice are collected.

    Every language has the same quota, so that a rare one is learned as well as one that most documents are in, and what is
    collected is bounded by the quota and the number of languages; an entry costs room for the languages that have it only.
    """
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(learning())
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], [], {})
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, math.ceil((1 << 62) * min(1.0, fit_docs / n)))])
    chosen = usable.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 2) < share[F.col("lang")])
    counts = chosen.select("lang", "text").mapInArrow(_counted, "lang string, size int, entry string, n long").groupBy("lang", "size", "entry").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "counts")
    totals = {(r.lang, r.size): r.n for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    learned = counts.where(F.col("n") >= SEEN).toArrow()
    model = Model(sorted(sizes), zip(*(learned.column(c).to_pylist() for c in ("lang", "size", "entry", "n")), strict=True), totals)
    discard(counts)
    return model


def identify(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang, ...)``: ``doc_id, held_out, lang_pred, score``.

    A prediction depends on the text alone. Null texts and texts without a letter are ``und`` with score 0, and so is everything
    if there is nothing to learn from; ties go to the first language by name; repeated rows come out repeated; an
    empty table gives an empty one; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_languages(docs, fit_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i in range(0, len(batch), TOGETHER):
                found += model.value.predict_all(batch.column(1).slice(i, TOGETHER).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
