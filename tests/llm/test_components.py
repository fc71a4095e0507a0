import random

import pytest

from corvane.llm import skew
from corvane.llm.components import connected_components


def brute(edges):
    first = {x: x for e in edges for x in e}
    for _ in range(len(first)):
        for u, v in edges:
            first[u] = first[v] = min(first[u], first[v])
    return first


@pytest.mark.parametrize("hub", [1000, 3])
def test_against_brute_force(spark, monkeypatch, hub):
    monkeypatch.setattr(skew, "HOT", hub)
    rnd = random.Random(hub)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(160)] + [(1000, 1001 + i) for i in range(60)] + [(2000 + i, 2001 + i) for i in range(40)] + [(5, 5)]
    want = brute([e for e in edges if e[0] != e[1]])
    got = {r.id: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 4)], "u long, v long").repartition(5)).collect()}
    assert got == want


def test_unfinished_is_an_error(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(50)], "u long, v long")
    with pytest.raises(RuntimeError):
        connected_components(path, rounds=1)
    assert connected_components(path.limit(0)).collect() == []
