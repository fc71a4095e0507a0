import math
import random
import zlib

import pytest

from corvane.llm.langid import Model, grams, identify, tokens

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = identify(docs).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) >= 0.97 * len(test)


def test_rare_language_is_learned(spark):
    """One document in a thousand: a quota for each language finds it, a share of all documents would not."""
    rows = [(i, f"the and of common word{i % 50}", "en") for i in range(4000)] + [(5000 + i, f"quibble zorg flim flam{i}", "xx") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify(docs, fit_docs=20).collect()}
    assert all(got[i] == lang for i, _, lang in rows)


def test_backing_off():
    counts = [("a", 0, "the", 9), ("b", 0, "les", 9), ("a", 2, "^t", 9), ("a", 2, "th", 9), ("b", 2, "^l", 9), ("b", 2, "le", 9), ("b", 2, "es", 9), ("b", 2, "s$", 9), ("b", 1, "é", 3)]
    model = Model(["a", "b"], counts, {("a", 0): 9, ("b", 0): 9, ("a", 2): 18, ("b", 2): 36, ("b", 1): 3})
    assert model.predict("THE the")[0] == "a" and model.predict("les")[0] == "b"
    assert model.predict("lees")[0] == "b", "an unseen word by its pairs of letters"
    assert model.predict("éé")[0] == "b", "and by its letters"
    assert model.predict("12 !") == ("und", 0.0) and model.predict(None) == ("und", 0.0)
    assert model.predict("qqq")[1] == 0.5


def test_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, "the of and", "en", 1), (-1, None, "en", 1), (-2, "", None, 1), (-3, "123 $$", "de", 1), (-4, "the and that with " * 50_000, None, 1), (-5, "zz", None, 1)], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in identify(docs.select("doc_id", "text", "lang", docs.n_chars.cast("int").alias("score")).union(odd)).collect()}
    assert [got[i].lang_pred for i in (-1, -2, -3, -4)] == ["und", "und", "und", "en"] and got[None].lang_pred == "en"
    assert identify(odd.limit(0)).collect() == []
    assert {r.lang_pred for r in identify(odd.where("lang is null")).collect()} == {"und"}


def test_words_are_letters_and_their_marks():
    assert tokens("½ ² Ⅷ ① 12_3") == [] and tokens("हिन्दी भाषा, É1è") == ["हिन्दी", "भाषा", "é", "è"]
    for c in map(chr, range(256)):
        assert bool(tokens(c)) == bool(tokens(f"{c} 一")[:-1])


def test_against_a_plain_reading_of_the_rule():
    """Word first, then shorter and shorter n-grams, entry by entry."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choices("abé", k=rnd.randrange(1, 7)))
    counts, totals = {}, {}
    for lang in "xyz":
        for _ in range(60):
            w = word()
            for size, parts in [(0, [w]), *[(n, grams(w, n)) for n in range(1, 5)]]:
                for p in parts:
                    counts[lang, size, p] = counts.get((lang, size, p), 0) + 1
                    totals[lang, size] = totals.get((lang, size), 0) + 1
    kept = {k: n for k, n in counts.items() if n > 1}
    entries = {(size, p) for _, size, p in kept}

    def log(lang, size, p):
        return math.log((kept.get((lang, size, p), 0) + 0.5) / (totals[lang, size] + 1))

    def plain(lang, w):
        if (0, w) in entries:
            return log(lang, 0, w)
        for size in range(4, 0, -1):
            parts = grams(w, size)
            if 2 * sum((size, p) in entries for p in parts) > len(parts):
                return sum(log(lang, size, p) if (size, p) in entries else math.log(0.5 / (totals[lang, size] + 1)) for p in parts) / len(parts) + (5 - size) * math.log(0.4)
        return math.log(0.5 / (totals[lang, 0] + 1))

    model = Model(list("xyz"), [(*k, n) for k, n in kept.items()], totals)
    for _ in range(300):
        text = " ".join(word() for _ in range(rnd.randrange(1, 6)))
        sums = {lang: sum(plain(lang, w) for w in text.split()) for lang in "xyz"}
        best = max(sums.values())
        lang, score = model.predict(text)
        assert sums[lang] == pytest.approx(best) and score == pytest.approx(1 / sum(math.exp(s - best) for s in sums.values()))


def test_ties_go_to_the_first_language():
    model = Model(["a", "b"], [("a", 0, "w", 3), ("b", 0, "w", 3)], {("a", 0): 3, ("b", 0): 3})
    assert model.predict("w w") == ("a", 0.5)
