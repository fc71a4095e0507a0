"""Benchmark decontamination by template windows: questions are found again with other numbers, names and units.

Numbers (digits or words), names and units become typed placeholders; windows of five such tokens are joined by hash. A word
that opens a sentence may be a name or not, so its windows come both ways. The same windows come as case-folded words
without placeholders too, as a copy in other capitals has other names. Where a document's windows line up with an item's, numbers
are free by their position; each name and unit must map to one, and different names to different ones. An item without such
a window is looked for by its case-folded words alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import textkit as tk
from corvane.llm.store import materialize

WINDOW, LITERALS, COVERAGE = 5, 3, 0.8
#: An item of one or two words tells nothing ("the", "a lot") unless these take so many bytes.
TELLING_BYTES = 10
#: Size of the bit table that benchmark windows are noted in, whatever their number: 2 ** 23 bits are 1 MB.
TABLE_BITS = 23

#: Units of measure, lower case.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l gal s sec secs min mins h hr hrs hz khz mhz ghz v w kw kwh j kj cal kcal pa bar k "
    "usd eur gbp percent meter meters metre metres kilometer kilometers kilometre kilometres mile miles foot feet inch inches yard yards "
    "gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes hour hours day days "
    "week weeks month months year years dollar dollars euro euros cent cents"
).split()

#: Numbers in words, lower case.
NUMBER_WORDS = (
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()

_MARKS = np.zeros(256, bool)
_MARKS[list(b".,;:!?()[]{}\"'`")] = True
_STOPS = np.zeros(256, bool)
_STOPS[list(b".!?:\n\r")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
#: Which code points below 0x800 (one and two bytes) are capital letters.
_CAPITAL = np.array([chr(c).isupper() for c in range(0x800)])
_NUM, _NAME, _UNIT = tk.stream(21, 3)
#: The two lowest bits of a filler say what it fills: a number (or a word that may be a name), a unit, a name.
_FREE, _OF_UNIT, _OF_NAME, _KIND = tk.U(0), tk.U(2), tk.U(3), tk.U(3)


def _folded_text(texts: pa.Array) -> pa.Array:
    """Small letters, with those as one that share a capital form; texts that are no UTF-8 change in A-Z only."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        if len(texts) > 1:
            return pa.concat_arrays([_folded_text(texts.slice(i, 1)) for i in range(len(texts))])
        return pa.array([texts.cast(pa.large_binary())[0].as_py().lower()], pa.large_binary()).view(pa.large_string())
    return pc.replace_substring(pc.replace_substring(pc.utf8_lower(texts), "ß", "ss"), "ς", "σ")


def _folded(s: tk.Slice, texts: pa.Array) -> np.ndarray:
    """Hashes of the case-folded words of a slice, whose texts these are."""
    if not len(s.data) or s.data.max() < 0x80:
        own = tk.Slice(s.first, tk.LOWER_ASCII[s.data], s.offs)
    else:
        own = next(tk.slices(_folded_text(texts), 1 << 40))
    return tk.words(tk.Slice(own.first, _trimmed(own.data, own.offs), own.offs)).hash


def _trimmed(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Marks at either edge of a word become blanks."""
    out = data.copy()
    if not len(out):
        return out
    edge = np.zeros(len(out) + 1, bool)
    edge[offs] = True
    for _ in range(3):
        blank = tk.IS_SEP[out]
        left = np.append(True, blank[:-1]) | edge[:-1]
        right = np.append(blank[1:], True) | edge[1:]
        out[_MARKS[out] & (left | right)] = 0x20
    return out


def _hashes(words: Iterable[str]) -> np.ndarray:
    return np.sort(tk.words(next(tk.slices(pa.array([" ".join(words)])))).hash)


_Lexicon = tuple[np.ndarray, np.ndarray]


def lexicon() -> _Lexicon:
    """Sorted hashes of the units and of the numbers in words."""
    return _hashes(UNITS), _hashes(NUMBER_WORDS)


def _filler(word: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """A filler is never 0, which stands for a literal."""
    return (word & ~_KIND | tk.U(4)) | kind


def templates(s: tk.Slice, texts: pa.Array, known: _Lexicon) -> tuple[tk.Words, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Tokens of a slice, whose texts these are: words, two readings of them as (hashes with placeholders, fillers), and which words open a sentence with a capital.

    The first reading takes opening words as literals, the second takes those with a capital as names that may be any.
    """
    w = tk.words(tk.Slice(s.first, _trimmed(s.data, s.offs), s.offs))
    w.hash = _folded(s, texts)
    if not len(w.hash):
        return w, [(w.hash, w.hash)] * 2, np.zeros(0, bool)
    stops = np.concatenate([[0], np.cumsum(_STOPS[s.data])])
    opens = np.ones(len(w.hash), bool)
    opens[1:] = (stops[w.start[1:]] > stops[w.end[:-1]]) | (w.row[1:] != w.row[:-1])
    first = s.data[w.start]
    second = s.data[np.minimum(w.start + 1, len(s.data) - 1)]
    wide = w.end - w.start > 1
    units, numbers = known
    number = _DIGIT[first] | (wide & np.isin(first, np.frombuffer(b"+-$#", np.uint8)) & _DIGIT[second]) | np.isin(w.hash, numbers)
    unit = ~number & (np.isin(w.hash, units) | ((first == 0x25) & ~wide))
    point = np.where(first < 0x80, first, np.where((first >= 0xC2) & (first < 0xE0), ((first & 0x1F).astype(np.int64) << 6) | (second & 0x3F), 0))
    capital = ~number & ~unit & _CAPITAL[point]
    name, maybe = capital & ~opens, capital & opens
    typed = np.where(number, _NUM, np.where(unit, _UNIT, np.where(name, _NAME, w.hash)))
    fill = np.where(number | unit | name, _filler(w.hash, np.where(name, _OF_NAME, np.where(unit, _OF_UNIT, _FREE))), tk.U(0))
    return w, [(typed, fill), (np.where(maybe, _NAME, typed), np.where(maybe, _filler(w.hash, _FREE), fill))], maybe


def _within(flags: np.ndarray) -> np.ndarray:
    """How many of each window's tokens are flagged."""
    total, n = np.concatenate([[0], np.cumsum(flags)]), np.zeros(len(flags), np.int64)
    if len(flags) >= WINDOW:
        n[: len(flags) - WINDOW + 1] = total[WINDOW:] - total[:-WINDOW]
    return n


def _windows(s: tk.Slice, texts: pa.Array, known: _Lexicon, sizes: Iterable[int] | None = None) -> tuple[np.ndarray, ...]:
    """Row, place, hash, slot fillers and number of words of the windows of a slice: of items, or of documents if ``sizes`` is given.

    Each window that has enough literal tokens comes with placeholders, once for each reading that differs. Each that has slots
    comes as plain words too, of a document without fillers: equal words fill the slots as the item does. An item without a
    window that has enough literals comes as plain words only: all its windows, or all its words where they are fewer than a
    window has. ``sizes``: numbers of words of such short items, which documents are cut to as well.
    """
    w, readings, maybe = templates(s, texts, known)
    words, whole = tk.grams(w, WINDOW)
    row, length = w.row, np.diff(w.ptr)
    parts: list[tuple[np.ndarray, np.ndarray, int, np.ndarray | None]] = []
    for reading, (typed, fill) in enumerate(readings):
        g, ok = tk.grams(tk.Words(w.start, w.end, typed, w.ptr), WINDOW)
        slots = _within(fill != 0)
        ok &= slots <= WINDOW - LITERALS
        if reading == 0:
            wanted = ok | (tk.per_row_sum(ok, w.ptr) == 0)[row] if sizes is None else whole
            plain = np.flatnonzero(wanted & whole & (slots > 0))
        else:
            ok &= _within(maybe) > 0
        parts.append((np.flatnonzero(ok), g[ok], WINDOW, fill))
    parts.append((plain, words[plain], WINDOW, readings[0][1] if sizes is None else None))
    for size in range(1, WINDOW) if sizes is None else sizes:
        short, fits = tk.grams(w, size)
        at = w.ptr[:-1][length == size] if sizes is None else np.flatnonzero(fits)
        if sizes is None and size <= 2:
            at = at[w.end[at + size - 1] - w.start[at] >= TELLING_BYTES]
        parts.append((at, short[at], size, None))
    at = np.concatenate([p[0] for p in parts])
    filled = np.zeros((len(at), WINDOW), tk.U)
    edge = 0
    for spots, _, _, fill in parts:
        if fill is not None:
            for i in range(WINDOW):
                filled[edge : edge + len(spots), i] = fill[spots + i]
        edge += len(spots)
    return row[at], at - w.ptr[:-1][row[at]], np.concatenate([p[1] for p in parts]), filled, np.concatenate([np.full(len(p[0]), p[2]) for p in parts])


def _emit(ids: pa.Array, s: tk.Slice, row: np.ndarray, place: np.ndarray, g: np.ndarray, fill: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids.slice(s.first, s.rows).take(pa.array(row)), pa.array(place), tk.signed(g), tk.list_array(fill.ravel().view(np.int64), np.full(len(g), WINDOW)), pa.array(size, pa.int32())],
        names=["id", "place", "hash", "fill", "size"],
    )


_HITS = "id long, place long, hash long, fill array<long>, size int"


def _all_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = lexicon()
    for batch in batches:
        for s in tk.slices(batch.column(1)):
            yield _emit(batch.column(0), s, *_windows(s, batch.column(1).slice(s.first, s.rows), known))


def _noted(windows: DataFrame) -> np.ndarray:
    """The bit table of the windows' hashes: at most 2 ** (TABLE_BITS - 5) words, collected as such."""
    bit = f"shiftrightunsigned(hash, {64 - TABLE_BITS})"
    word = windows.selectExpr(f"cast(shiftright({bit}, 5) as int) as word", f"shiftleft(1L, cast({bit} & 31 as int)) as bits")
    table = np.zeros(1 << (TABLE_BITS - 5), np.uint32)
    for r in word.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():
        table[r.word] = r.bits
    return table


def _candidates(found: DataFrame, own: DataFrame, counts: DataFrame, coverage: float) -> DataFrame:
    """Pairs ``doc_id, item_id`` of which the document holds one of the item's least frequent windows, as many as can't all be missing."""
    frequency = found.groupBy("hash", "size").agg(F.count("*").alias("met"))
    told = own.select("item_id", "spot", "hash", "size").distinct()
    spots = told.join(frequency, ["hash", "size"], "left").groupBy("item_id", "spot").agg(F.sum(F.coalesce("met", F.lit(0))).alias("met"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("met", "spot"))
    probes = spots.withColumn("rank", rank).join(counts, "item_id").where(F.col("rank") <= F.col("n_windows") - F.ceil(coverage * F.col("n_windows")) + 1)
    probes = told.join(probes.select("item_id", "spot"), ["item_id", "spot"]).select("item_id", "hash", "size").distinct()
    return found.select("doc_id", "hash", "size").join(probes, ["hash", "size"]).select("doc_id", "item_id").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Pairs ``doc_id, item_id, n_windows, matched, changed``: documents that hold a benchmark item, as it is or re-parameterised.

    ``n_windows`` counts the item's windows of five tokens with three literals at least, ``matched`` those found in the
    document at one offset or another, with consistent slots or in the same words (in any case), ``changed`` the slot values that differ at the best offset. A pair is given if
    matched >= coverage * n_windows.

    An item without such a window counts its windows of plain words, and one shorter than a window all its words as one; one
    of a word or two with fewer than TELLING_BYTES bytes is not looked for, as any document may hold these.
    A number may become any other, wherever it stands; a unit or name becomes one unit or name throughout, and different names
    stay different, else the windows of that offset don't count.

    Null and blank texts and rows without id give no pair; repeated rows give one;
    empty tables an empty one. Only ids and texts are read. Documents' windows are first tried against a bit table of fixed
    size, then joined exactly, so a larger benchmark costs a larger join and not a larger broadcast.

    A document that lacks more than a share of 1 - coverage of an item's windows is no pair, so it holds one at least of any set that
    exceeds this share. Candidates are the documents that hold one of the item's least frequent windows, so many; windows that
    many items and documents share are only looked at for these.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null")
    wanted = materialize(items.mapInArrow(_all_windows, _HITS), "items")
    table = docs.sparkSession.sparkContext.broadcast(_noted(wanted))
    sizes = sorted(r.size for r in wanted.select("size").distinct().collect() if r.size < WINDOW)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lexicon()
        for batch in batches:
            for s in tk.slices(batch.column(1)):
                row, place, g, fill, size = _windows(s, batch.column(1).slice(s.first, s.rows), known, sizes)
                bit = g >> tk.U(64 - TABLE_BITS)
                hit = (table.value[(bit >> tk.U(5)).astype(np.int64)] >> (bit & tk.U(31)).astype(np.uint32)) & 1 == 1
                yield _emit(batch.column(0), s, row[hit], place[hit], g[hit], fill[hit], size[hit])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null")
    found = materialize(texts.mapInArrow(hits, _HITS).select(F.col("id").alias("doc_id"), "place", "hash", "size", "fill"), "hits")
    own = wanted.select(F.col("id").alias("item_id"), F.col("place").alias("spot"), "hash", "size", F.col("fill").alias("want"))
    counts = wanted.groupBy(F.col("id").alias("item_id")).agg(F.count_distinct("place").alias("n_windows"))
    candidates = materialize(_candidates(found, own, counts, coverage), "candidates")
    met = candidates.join(own, "item_id").join(found, ["doc_id", "hash", "size"]).withColumn("pairs", F.expr("transform(filter(arrays_zip(want, fill), p -> p.want <> 0), p -> named_struct('want', p.want, 'fill', if(p.fill = 0, p.want, p.fill) & -4L))"))
    lined = met.groupBy("doc_id", "item_id", (F.col("place") - F.col("spot")).alias("shift")).agg(F.collect_set("spot").alias("spots"), F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    bound, names = "filter(pairs, p -> p.want & 3L >= 2L)", "filter(pairs, p -> p.want & 3L = 3L)"
    consistent = F.expr(f"size({bound}) = size(array_distinct({bound}.want)) and size({names}) = size(array_distinct({names}.fill))")
    sound = lined.where(consistent).groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("spots")))).alias("matched"),
        F.max_by(F.expr("size(filter(pairs, p -> p.want & -4L <> p.fill))"), F.struct(F.size("spots"), -F.abs("shift"))).alias("changed"),
    )
    return sound.join(counts, "item_id").where(F.col("matched") >= coverage * F.col("n_windows")).select("doc_id", "item_id", "n_windows", "matched", "changed")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows without doc_id stay."""
    leaked = materialize(contaminated(docs, benchmark, coverage).select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(*docs.columns)
