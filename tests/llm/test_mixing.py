import re

import pytest

from corvane.llm.mixing import mix_sources, source_targets

SF = "/root/testdata/sf0.001"


def fill(sizes, weights, cap=3):
    """The rule as told: cap, reshare by weight, until none is above."""
    total, target, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(cap * sizes[i] for i in range(len(sizes)) if i not in free)
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > cap * sizes[i]}
        for i in free:
            target[i] = share[i]
        for i in over:
            target[i] = cap * sizes[i]
        if not over:
            break
        free -= over
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 2, 3], [5, 0, 7, 100, 3, 2, 900], [0, 0], [42]])
def test_targets(spark, sizes):
    names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes, strict=True)), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = fill(sizes, [1 + i % 3 for i in range(len(sizes))])
    for name, t in zip(names, want, strict=True):
        assert got[name] == pytest.approx(t)


def check(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size and r.taken >= r.epochs * r.size
    for own in by.values():
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.5 + 1e-6
        assert sum(r.size * r.epochs < r.taken < r.size * (r.epochs + 1) for r in own) <= 1
    assert sum({s: own[0].target for s, own in by.items()}.values()) == pytest.approx(sum(r.size for r in rows))


def test_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix_sources(df).collect()
    check(rows)
    sizes = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in df.collect()}
    assert {r.doc_id: r.size for r in rows} == sizes
    again = mix_sources(df.repartition(13)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_edges(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", "a"), (3, "one two", "a"), (None, "x y z", None), (5, "w " * 50_000, "b"), (6, "  v", "c"), (7, "u", "c")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, size int")
    got = mix_sources(df, carry=True).collect()
    check(got)
    assert len(got) == len(rows) and {r.row["size"] for r in got} == {9}
    assert mix_sources(df.limit(0)).collect() == []
    blank = mix_sources(df.limit(2)).collect()
    assert [(r.size, r.target, r.taken) for r in blank] == [(0, 0.0, 0)] * 2
