from itertools import combinations

import pytest

from corvane.llm.urls import judge_urls, mine_rules, tokens_of
from pyspark.sql import functions as F

LISTED = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def test_hosts_paths_and_listed_rules(spark):
    urls = [
        "https://A.Example.ORG/es/1?x=/de/", "http://example.org/en/12", "http://example.org", "ftp://xorg/es/", "http://badexample.org/es/9", "http://a.b.com/fr/", "http://com/de/x#y",
        "http://com?/de/", "mailto:a@b.org", "", None, "a://b://org/", "http://example.org/en/2", "http://ÄÖ.org/Ä", "http://org:80/",
    ]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, LISTED).collect()}
    want = [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"), ("example.org", "", None, "allow"), ("xorg", "/es/", None, "allow"), ("badexample.org", "/es/9", "org/", "allow"),
        ("a.b.com", "/fr/", "com/fr/", "allow"), ("com", "/de/x", "com/de/", "block"), ("com", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b:", "//org/", None, "allow"),
        ("example.org", "/en/2", "org/", "allow"), ("ÄÖ.org", "/Ä", "org/", "allow"), ("org:80", "/", None, "allow"),
    ]
    assert [got[i] for i in range(len(urls))] == want


def mined_by_hand(rows, support, confidence, least, combined):
    """All combinations, counted one after another."""
    n = len(rows)
    blocked = sum(v == "block" for _, v in rows)
    tokens = {t for ts, _ in rows for t in ts}
    seen = {t: [v for ts, v in rows if t in ts] for t in tokens}
    floor = max(support * n, least)
    order = sorted((t for t in tokens if len(seen[t]) >= floor), key=lambda t: (-abs(seen[t].count("block") - len(seen[t]) * blocked / n), t))
    code = {t: i for i, t in enumerate(order)}
    sets = [(frozenset(sorted(code[t] for t in ts if t in code)[:combined]), v) for ts, v in rows]
    rules = {}
    for size in range(1, combined + 1):
        for c in {c for s, _ in sets for c in combinations(sorted(s), size)}:
            have = [v for s, v in sets if s >= set(c)]
            for verdict in ("allow", "block"):
                if have.count(verdict) >= floor and have.count(verdict) / len(have) >= confidence:
                    rules[c, verdict] = have.count(verdict) / len(have)
    return code, {(frozenset(c), v) for (c, v), sure in rules.items() if not any(rules.get((tuple(x for x in c if x != out), v), 0) >= sure for out in c)}


@pytest.mark.parametrize("combined", [3, 10])
def test_mined_rules_against_all_combinations(spark, combined):
    rows = []
    for i in range(400):
        host, lang, query = ["shop", "blog", "news"][i % 3], ["en", "de", "fr", "es"][i * 7 % 4], ["ref", "page"][i // 5 % 2]
        tokens = [f"host:{host}", f"path:{lang}", f"query:{query}", "host:com", *(["path:x"] if i % 11 == 0 else [])]
        rows.append((tokens, "block" if (host == "shop" and lang == "de") or (lang == "es" and query == "ref" and i % 9) else "allow"))
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    miner = mine_rules(df, support=0.02, confidence=0.8, least=5, combined=combined)
    code, want = mined_by_hand([(set(t), v) for t, v in rows], 0.02, 0.8, 5, combined)
    assert miner.codes == code
    assert {(r[0], r[1]) for r in miner.rules} == want and want
    assert [r[2:] for r in miner.rules] == sorted((r[2:] for r in miner.rules), key=lambda r: (-r[0], -r[1]))


def test_mined_verdicts_reach_pages_without_a_listed_rule(spark):
    urls = [f"https://h{i % 7}.example.{tld}/{lang}/{i}" for i, (tld, lang) in enumerate([("org", "es"), ("org", "fr"), ("com", "fr"), ("net", "es"), ("net", "fr"), ("net", "zz")] * 30)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in judge_urls(df, LISTED).collect():
        lang = r.path.split("/")[1]
        assert (r.rule is None) == r.host.endswith("net")
        assert r.verdict == ("block" if lang == "es" else "allow")
        assert r.rule or lang == "zz" or f"path:{lang}" in r.mined


def test_odd_addresses(spark):
    odd = [(1, "http://" + "a." * 200_000 + "org/" + "es/1-" * 100_000), (2, "http://x/?" + "q=1&" * 50_000), (3, None), (3, None), (None, "://")]
    got = judge_urls(spark.createDataFrame(odd, "page_id long, url string"), LISTED).collect()
    assert sorted(((r.page_id or 0), r.verdict, r.rule) for r in got if r.page_id != 1) == [(0, "allow", None), (2, "allow", None), (3, "allow", None), (3, "allow", None)]
    assert [(len(r.host), len(r.path), r.rule) for r in got if r.page_id == 1] == [(400_003, 500_001, "org/")]
    empty = judge_urls(spark.createDataFrame([], "page_id long, url string"), LISTED)
    assert empty.columns == ["page_id", "host", "path", "rule", "verdict", "mined"] and not empty.collect()
    told = spark.createDataFrame([("http://a.b.a/X-12/7?q=1&r&q=2#z",)], "u string").select(tokens_of(F.col("u"))).first()[0]
    assert told == ["host:a", "host:b", "path:x", "path:#", "query:q", "query:r"]
