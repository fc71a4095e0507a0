"""No bound on tokens, on combinations or on rules decides which rules are found."""

from corvane.llm.urls import matched, mine_rules
from pyspark.sql import functions as F


def test_rules_of_many_tokens(spark):
    """Forty more telling tokens that always come together leave the two weak ones that tell the verdict only together."""
    together = [f"path:t{n:02}" for n in range(40)]
    rows = []
    for i in range(400):
        pair = [t for t, k in (("path:a", 2), ("path:b", 3)) if i < 200 and i % k == 0]
        block = len(pair) == 2 or (i >= 200 and i % 10 < 7)
        rows.append(([*pair, *(together if len(pair) == 2 or i >= 200 else []), "host:x"], "block" if block else "allow"))
    miner = mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), support=0.02, least=5)
    a, b = miner.codes["path:a"], miner.codes["path:b"]
    assert min(a, b) >= 40
    assert (frozenset({a, b}), "block") in {r[:2] for r in miner.rules}
    assert {miner.same[miner.codes[t]] for t in together} == {miner.codes["path:t00"]}
    judged = spark.createDataFrame([(["path:a", "path:b"],), (["path:a", "path:t39"],), (["path:q"],)], "tokens array<string>").select(matched(miner)(F.col("tokens")).alias("n")).collect()
    assert [None if r.n is None else miner.rules[r.n][1] for r in judged] == ["block", "block", None]


def test_more_rules_and_tokens_than_ten_thousand(spark):
    """Each of 10,500 tokens has a rule of its own."""
    rows = [([f"path:{i}"], "block" if i % 2 else "allow") for i in range(10_500)]
    miner = mine_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), support=0.0, least=1)
    assert len(miner.rules) == len(rows) == len(miner.codes)
