import hashlib
import random
import re

import pytest

from corvane.llm.substring import substring_dedup, without_repeats

SF = "/root/testdata/sf0.001"


def brute(rows, k=50):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for j in range(len(w) - k + 1):
                x = tuple(w[j : j + k])
                first[x] = min(i, first.get(x, i))
    out = []
    for i, w in words:
        gone = set()
        for j in range(len(w) - k + 1):
            if i is not None and first[tuple(w[j : j + k])] < i:
                gone.update(range(j, j + k))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def answer(df):
    return sorted((tuple(r) for r in substring_dedup(df).collect()), key=str)


def test_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert answer(df) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_planted_passages(spark):
    rnd = random.Random(3)
    word = lambda: "w" + str(rnd.randrange(500))
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 60, 130)]
    rows = []
    for i in range(120):
        w = []
        for _ in range(rnd.randrange(1, 4)):
            w += [word() for _ in range(rnd.randrange(0, 60))] + rnd.choice(shared)
        rows.append((i, " ".join(w)))
    rows += [(200, " ".join(["same"] * 300)), (201, " ".join(["same"] * 120 + ["end"])), (202, "\n".join(["same"] * 300))]
    rnd.shuffle(rows)
    assert answer(spark.createDataFrame(rows, "doc_id long, text string").repartition(9)) == brute(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(5, None), (4, ""), (3, " \t\r\n"), (7, long), (6, "a " + long), (None, long), (9, long), (9, long), (2, "y" * 200_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key1 int")
    assert answer(df) == brute(rows)
    assert answer(df.limit(0)) == []


def test_texts(spark):
    a = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"{a}\nend", "s"), (2, f"begin {a}  tail", "t"), (3, "short\ntext", None)]
    got = {r.doc_id: (r.text, r.n_chars, r.source) for r in without_repeats(spark.createDataFrame([(i, t, s, len(t)) for i, t, s in rows], "doc_id long, text string, source string, n_chars long")).collect()}
    assert got == {1: (f"{a}\nend", len(a) + 4, "s"), 2: ("begin tail", 10, "t"), 3: ("short\ntext", 10, None)}


@pytest.mark.parametrize("parts", [1, 5])
def test_partitioning_does_not_matter(spark, parts):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(80)
    assert answer(df.repartition(parts)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_texts_of_one_id(spark):
    """Rows are told apart by id and text: each loses its own repeats."""
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (2, f"{a} tail"), (2, f"other {b}"), (2, "plain text"), (3, f"{b} end"), (2, f"{a} tail")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    left = without_repeats(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == sorted([(1, a), (2, "tail"), (2, f"other {b}"), (2, "plain text"), (3, "end"), (2, "tail")])


@pytest.mark.parametrize("limit", [0, 2000, 1_000_000])
def test_large_groups_are_split_by_longer_prefixes(spark, monkeypatch, limit):
    """Trees in memory, nodes of whole windows, and both give the same."""
    from corvane.llm import substring

    monkeypatch.setattr(substring, "GROUP_WORDS", limit)
    monkeypatch.setattr(substring, "BATCH_BYTES", 20_000)
    rnd = random.Random(9)
    word = lambda: "w" + str(rnd.randrange(300))
    shared = [[word() for _ in range(n)] for n in (50, 55, 90, 200)] + [["again"] * 70, ["x", "y"] * 40]
    rows = []
    for i in range(150):
        w = []
        for _ in range(rnd.randrange(1, 4)):
            p = rnd.choice(shared)
            cut = rnd.randrange(0, max(1, len(p) - 45))
            w += [word() for _ in range(rnd.randrange(0, 40))] + p[cut:]
        rows.append((i, " ".join(w)))
    assert answer(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_a_tree_against_brute_force():
    import numpy as np
    import pyarrow as pa

    from corvane.llm.substring import _nodes, _tree

    rnd = random.Random(1)
    rows = [[rnd.randrange(1, 3) for _ in range(8)] for _ in range(200)]
    group = np.array([rnd.randrange(3) for _ in rows])
    tree = _tree(group, np.array(rows))
    for depth in range(9):
        node = _nodes(tree, depth)
        for i in range(0, 200, 7):
            for j in range(200):
                assert (node[i] == node[j]) == (group[i] == group[j] and rows[i][:depth] == rows[j][:depth])


def test_lines_that_a_document_repeats_are_one_path(spark, monkeypatch):
    import corvane.llm.substring as module

    line, tables = " ".join(f"l{i}" for i in range(9)), {}
    keep = module.materialize
    monkeypatch.setattr(module, "materialize", lambda df, name: tables.setdefault(name, keep(df, name)))
    rows = [(i, " ".join([f"a{i}", *[line] * (300 + i), f"b{i}", *[line] * 300, *(f"c{i}-{j}" for j in range(60))])) for i in range(12)]
    assert answer(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)
    alive = tables["traced"]
    assert alive.count() == alive.select("doc_id", "path1", "path2").distinct().count() < 400
