import random
import re

import pytest

from corvane.llm import minhash
from corvane.llm.minhash import near_duplicates, without_near_duplicates

SF = "/root/testdata/sf0.001"


def brute(rows, percent=85):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    ids, comp = sorted(sets), {i: i for i in sets}

    def find(a):
        while comp[a] != a:
            a = comp[a]
        return a

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                comp[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def answer(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}


def test_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert answer(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_edited_copies(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(4000)}" for _ in range(300)]
    rows = []
    for i in range(700):
        w = list(base)
        for _ in range(rnd.randrange(0, 8)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = answer(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert got == brute(rows)


@pytest.mark.parametrize("block", [3, 40])
def test_chain_of_growing_texts(spark, monkeypatch, block):
    """One candidate group over many sizes, in many blocks: links between neighbouring sizes must not be lost."""
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(4000)}" for _ in range(900)]
    rows = [(i, " ".join(base[: rnd.choice((60, 104, 116, 204, 225, 240, 480, 564, 640, 900)) + rnd.randrange(3)])) for i in range(150)]
    assert answer(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


@pytest.mark.parametrize("text", [None, "", " \n\t"])
def test_edges(spark, text):
    rows = [(3, text, "a"), (1, text, "a"), (5, "One two", "b"), (4, "one TWO", "b"), (9, "x" * 300_000, None), (8, "x" * 300_000, None), (None, "one two", "c")]
    got = answer(spark.createDataFrame(rows, "doc_id long, text string, n_shingles string"))
    assert got == {3: (0, 3, True), 1: (0, 1, True), 5: (1, 4, False), 4: (1, 4, True), 9: (1, 8, False), 8: (1, 8, True), None: (1, None, True)}


def test_empty_table(spark):
    assert answer(spark.createDataFrame([], "doc_id long, text string")) == {}


def test_texts_of_one_id(spark):
    """Different texts of one doc_id are linked on their own, and only the text that is a copy goes."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (9, b + " more"), (2, c), (7, c), (2, a), (7, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, gone_id int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == sorted([(1, 56, 1, True), (2, 56, 1, False), (2, 56, 2, True), (9, 57, 2, False), (2, 56, 2, True), (7, 56, 2, False), (2, 56, 1, False), (7, 0, 7, True)])
    left = without_near_duplicates(df)
    assert left.columns == df.columns and sorted((r.doc_id, r.text or "") for r in left.collect()) == sorted([(1, a), (2, b), (2, c), (7, "")])
