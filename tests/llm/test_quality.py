import math
import zlib

import numpy as np
import pyarrow as pa

from corvane.llm import quality
from corvane.llm import textkit as tk
from corvane.llm.quality import FEATURES, features, fit, keep_good, quality_scores

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    rows = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    assert len(rows) == docs.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    test = [(rows[x.doc_id].predicted, x.quality) for x in labels.collect() if rows[x.doc_id].held_out]
    assert sum(a == b for a, b in test) >= 0.97 * len(test)


def test_features_by_hand():
    texts = ["", "One two two 3!\nfour|", None, "é " * 7]
    x = np.concatenate([features(s) for s in tk.slices(pa.array(texts))])
    at = FEATURES.index
    assert (x[0] == 0).all() and (x[2] == 0).all()
    assert math.isclose(x[1, at("log_words")], math.log1p(5)) and math.isclose(x[1, at("repeated_neighbours")], 1 / 5)
    assert math.isclose(x[1, at("distinct_words")], 4 / 5) and math.isclose(x[1, at("bars")], 1 / 5) and math.isclose(x[1, at("exclamations")], 1 / 5)
    assert math.isclose(x[1, at("capitals")], 1 / 13) and math.isclose(x[1, at("words_per_line")], math.log1p(5 / 2))
    assert math.isclose(x[3, at("distinct_words")], 1 / 7) and math.isclose(x[3, at("repeated_passages")], 1 - 1 / 3)


def test_pairs_learn_interactions():
    rnd = np.random.default_rng(0)
    x = rnd.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((fit(x, y).score(x) >= 0.5) == y).mean() > 0.95


def test_edges(spark):
    docs, labels = tables(spark)
    odd = spark.createDataFrame([(None, "a b", 1), (7, None, 1), (8, "", 1), (9, "x" * 400_000, 1), (9, "w " * 90_000, 1)], "doc_id long, text string, x int")
    got = quality_scores(odd, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality_scores(odd.limit(0), labels.limit(0)).collect() == []
    one = labels.where("quality = 1")
    assert all(r.predicted == 1 for r in quality_scores(docs.limit(50), one).collect())
    unknown = labels.selectExpr("doc_id", "cast(null as int) quality")
    assert {r.score for r in quality_scores(docs.limit(20), unknown).collect()} == {0.5}


def test_filter_keeps_columns_and_good_rows(spark):
    docs, labels = tables(spark)
    kept = keep_good(docs, labels)
    assert kept.schema == docs.schema
    good = {r.doc_id for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == good


def plain_fit(x, y, rounds, pairs, bins, coarse):
    """The same boosting over rows one by one: sums are made anew for every cut."""
    rows = range(len(y))
    smooth, rate = quality.SMOOTH, quality.RATE

    def places(n):
        cuts = [sorted({float(v) for v in np.quantile(x[:, f], np.linspace(0, 1, n + 1)[1:-1])}) for f in range(x.shape[1])]
        return cuts, [[sum(v >= c for c in cuts[f]) for v in x[:, f]] for f in range(x.shape[1])]

    (fine, at), (wide, cell) = places(bins), places(coarse)
    p = (sum(y) + 0.5) / (len(y) + 1)
    total = [math.log(p / (1 - p))] * len(y)

    def slopes():
        ps = [1 / (1 + math.exp(-t)) for t in total]
        return [y[i] - ps[i] for i in rows], [ps[i] * (1 - ps[i]) for i in rows]

    def part(g, h, some):
        return sum(g[i] for i in some), sum(h[i] for i in some)

    def worth(g, h, some):
        a, b = part(g, h, some)
        return a * a / (b + smooth)

    def cut_of(g, h, some, key, lo, hi):
        """Gain and first place of the best cut of bins lo:hi."""
        best = (0.0, lo)
        for c in range(lo + 1, hi):
            gain = worth(g, h, [i for i in some if key[i] < c]) + worth(g, h, [i for i in some if key[i] >= c]) - worth(g, h, some)
            if c == lo + 1 or gain > best[0] + 1e-12:
                best = (gain, c)
        return best

    def leaf(g, h, some):
        a, b = part(g, h, some)
        return rate * a / (b + smooth)

    def line(f, g, h):
        n, key = len(fine[f]) + 1, at[f]
        mid = cut_of(g, h, list(rows), key, 0, n)[1]
        step = [0.0] * n
        for lo, hi in ((0, mid), (mid, n)):
            some = [i for i in rows if lo <= key[i] < hi]
            gain, c = cut_of(g, h, some, key, lo, hi)
            for a, b in ((lo, c), (c, hi)) if gain > 1e-9 else ((lo, hi),):
                for k in range(a, b):
                    step[k] = leaf(g, h, [i for i in some if a <= key[i] < b])
        return step

    def grid(a, b, g, h):
        na, nb = len(wide[a]) + 1, len(wide[b]) + 1
        best, out = 0.0, {}
        for c in range(1, na):
            gain, table = 0.0, {}
            for lo, hi in ((0, c), (c, na)):
                some = [i for i in rows if lo <= cell[a][i] < hi]
                more, d = cut_of(g, h, some, cell[b], 0, nb)
                gain += more + worth(g, h, some)
                for left, right in ((0, d), (d, nb)):
                    value = leaf(g, h, [i for i in some if left <= cell[b][i] < right])
                    table |= {(r, k): value for r in range(lo, hi) for k in range(left, right)}
            if gain > best + 1e-12:
                best, out = gain, table
        return best, out

    for _ in range(rounds):
        for f in range(x.shape[1]):
            step = line(f, *slopes())
            total[:] = [total[i] + step[at[f][i]] for i in rows]
    g, h = slopes()
    names = [(a, b) for a in range(x.shape[1]) for b in range(a + 1, x.shape[1])]
    chosen = sorted(names, key=lambda p: -grid(*p, g, h)[0])[:pairs]
    for _ in range(rounds // 4):
        for a, b in chosen:
            step = grid(a, b, *slopes())[1]
            total[:] = [total[i] + step.get((cell[a][i], cell[b][i]), 0.0) for i in rows]
    return [1 / (1 + math.exp(-t)) for t in total]


def test_boosting_against_a_plain_one(monkeypatch):
    monkeypatch.setattr(quality, "ROUNDS", 8)
    monkeypatch.setattr(quality, "PAIRS", 2)
    monkeypatch.setattr(quality, "BINS", 6)
    monkeypatch.setattr(quality, "COARSE", 4)
    draw = np.random.default_rng(4)
    x = draw.random((70, 3))
    y = ((x[:, 0] > 0.4) ^ (x[:, 1] > 0.6) | (x[:, 2] > 0.9)).astype(float)
    model = fit(x, y)
    assert np.allclose(model.score(x), plain_fit(x, y, 8, 2, 6, 4))
