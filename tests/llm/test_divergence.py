import random
import re
from collections import Counter, defaultdict

import pytest

import corvane.llm.divergence as divergence
from corvane.llm.divergence import source_divergence

CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs, least, shown):
    """Terms, shares and ranks as told, in Python's integers."""
    occurs, docs_with, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in docs:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(CAPITALS))
        occurs[lang or "", source or ""].update(terms)
        docs_with[lang or ""].update(set(terms))
        groups[lang or ""].add(source or "")
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs_with[lang].items() if n >= least]
        of = {s: {t: occurs[lang, s][t] for t in kept} for s in sources}
        whole = {t: sum(of[s][t] for s in sources) for t in kept}

        def shares(count):
            return {t: 1 + 1_000_000_000 * (n + 5) // (sum(count.values()) + 5 * len(kept)) for t, n in count.items()}

        p, q = {s: shares(of[s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if of[s][t] and p[s][t] > q[t])
            out += [(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)]
            out += [(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(terms[:shown], 1)]
    return sorted(out)


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["a", "The", "eightlet", "ninelette", "sixteenletterwor", "seventeenletterwo", "x" * 33, "x" * 34, "x" * 500, "ÄÖ", "日本語", "日本語日本語", "ab", "abc", "abcdefgh", "abcdefghi", "Abcdefghijklmnop", "abcdefghijklmnopq"]
    docs = []
    for i in range(n):
        text = "".join(draw.choice(words[: 6 + i % 13]) + draw.choice([" ", "1", "_", "\n", "@", "\x00"]) for _ in range(draw.randint(0, 40)))
        docs.append((draw.choice([text] * 9 + [None]), draw.choice(["en", "de", None, ""]), draw.choice(["s0"] * 4 + ["s1", "s2", "ß", None])))
    return docs + [(None, "fr", "empty"), ("..", "fr", "also"), ("rare words", "fr", "s0"), ("the " * 100_000 + "y" * 300_000, "en", "s1"), (docs[0][0], docs[0][1], docs[0][2])]


@pytest.mark.parametrize("sizes", [(4096, 256, 1 << 23), (3, 1, 200)])
def test_against_the_rule(spark, monkeypatch, sizes):
    """The second sizes cut terms and sources into several blocks and texts into many slices."""
    docs = corpus(1, 400)
    shipped = dict(zip(("BLOCK_TERMS", "TILE_SOURCES", "SLICE_BYTES"), sizes, strict=True))
    for name, value in shipped.items():
        monkeypatch.setattr(divergence, name, value)
    df = spark.createDataFrame([(*d, 0, "z") for d in docs], "text string, lang string, source string, value int, term string").repartition(4)
    got = sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in source_divergence(df, least_documents=12, shown=4).collect())
    assert got == by_hand(docs, 12, 4)


def test_runs_of_terms_are_whole(spark):
    import pyarrow as pa

    from corvane.llm.textkit import slices

    docs = [d[0] or "" for d in corpus(2, 200)]
    import numpy as np

    code = np.arange(len(docs)) % 3
    found = Counter()
    rows = Counter()
    for s in slices(pa.array(docs)):
        for group, terms, n, r in divergence.term_runs(s, code[s.first : s.first + s.rows]):
            assert len(set(zip(group.tolist(), terms, strict=True))) == len(terms)
            for g, t, a, b in zip(group.tolist(), terms, n.tolist(), r.tolist(), strict=True):
                found[g, t.decode()] += a
                rows[g, t.decode()] += b
    want, want_rows = Counter(), Counter()
    for g, d in zip(code.tolist(), docs, strict=True):
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", d.translate(CAPITALS))
        want.update((g, t) for t in terms)
        want_rows.update((g, t) for t in set(terms))
    assert found == want and rows == want_rows


def test_empty_table_and_lone_source(spark):
    kind = "text string, lang string, source string"
    assert source_divergence(spark.createDataFrame([], kind)).collect() == []
    assert source_divergence(spark.createDataFrame([("a b", "en", "s")], kind)).collect() == []
    same = source_divergence(spark.createDataFrame([("a b", "en", "s"), ("c", "en", "t")], kind)).collect()
    assert sorted((r.source, r.item, r.value, r["rank"]) for r in same) == [("s", "t", 0, 1), ("t", "s", 0, 1)]


def test_shares_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(10**13, 10**14, 10**6)], "n long, total long, kept long")
    assert df.select(divergence._share(F.col("n"), F.col("total"), F.col("kept"))).first()[0] == 1 + 10**9 * (10**13 + 5) // (10**14 + 5 * 10**6)
