"""Verdicts on addresses: a list of rules first, rules mined by FP-growth for the rest."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.store import discard, materialize

#: Of the labelled addresses, the share, and the number, that a combination of tokens has to be seen in, and of those the share that has to have its verdict.
SUPPORT, LEAST, CONFIDENCE = 0.002, 10, 0.8
ALLOW, BLOCK = "allow", "block"
_VERDICT = {-1: ALLOW, -2: BLOCK}
_ALL = 2**31 - 1
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """From the first "://" up to "/", "?", "#" or the end, capitals small; empty without one."""
    return F.translate(F.regexp_extract(_after(F.coalesce(url, F.lit(""))), "^[^/?#]*", 0), _CAPITALS, _SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(F.coalesce(url, F.lit(""))), "^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens of an address: labels of its host, words of its path (runs of digits alike), names of its query."""
    rest = _after(F.coalesce(url, F.lit("")))
    labels = F.transform(F.filter(F.split(host_of(url), r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x))
    words = F.regexp_extract_all(F.translate(path_of(url), _CAPITALS, _SMALL), F.lit(_WORD), F.lit(0))
    words = F.transform(words, lambda x: F.concat(F.lit("path:"), F.when(F.regexp_like(x, F.lit("^[0-9]+$")), "#").otherwise(x)))
    names = F.transform(F.split(F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: F.regexp_extract(x, "^[^=]*", 0))
    names = F.transform(F.filter(names, lambda x: x != ""), lambda x: F.concat(F.lit("query:"), x))
    return F.array_distinct(F.concat(labels, words, names))


def listed_rule(host: Column, path: Column, listed: Sequence[tuple[str, str]]) -> Column:
    """The longest of the listed rules (verdict, "host/path") that fits, as a struct of ``rule`` and ``verdict``; else null.

    A rule fits its host and all subdomains where the path starts with the rule's. The list is part of the plan: thousands of rules, not millions.
    """
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in listed:
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name, []).append((slash + rest, rule, verdict))
    nothing = "struct<length:int,rule:string,verdict:string>"
    if not by_host:
        return F.lit(None).cast(nothing)
    found = []
    for depth in range(1, 1 + max(1 + name.count(".") for name in by_host)):
        own = F.substring_index(host, ".", -depth)
        case = F.lit(None).cast(f"array<{nothing}>")
        for name, rules in by_host.items():
            if 1 + name.count(".") == depth:
                hits = [F.when(F.startswith(path, F.lit(p)), F.struct(F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))) for p, rule, verdict in rules]
                case = F.when(own == name, F.array(*hits)).otherwise(case)
        found.append(F.coalesce(case, F.array().cast(f"array<{nothing}>")))
    return F.array_max(F.concat(*found))


@dataclass
class Miner:
    """Mined rules, best first: the codes of their tokens, verdict, confidence and support. ``codes``: token -> code, the most telling first.

    ``same``: code -> code of the first of the tokens that come in just the same addresses; rules name that one and hold for each of them.
    """

    codes: dict[str, int]
    rules: list[tuple[frozenset[int], str, float, float]]
    same: dict[int, int] = field(default_factory=dict)

    def told(self, number: int) -> str:
        tokens = sorted(t for t, c in self.codes.items() if c in self.rules[number][0])
        return f"{' & '.join(tokens)} -> {self.rules[number][1]}"


def _coder(codes: dict[str, int]):
    @F.pandas_udf("array<int>")
    def coded(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda ts: sorted(codes[t] for t in ts if t in codes))

    return coded


def _combining(same: dict[int, int], alone: dict[int, tuple[int, int]]):
    @F.pandas_udf("array<int>")
    def combining(codes: pd.Series) -> pd.Series:
        return codes.map(lambda cs: sorted({same[c] for c in cs} - alone.keys()))

    return combining


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST, tokens: int | None = None, combined: int | None = None, rules: int | None = None) -> Miner:
    """Association rules from sets of URL tokens to verdicts, out of ``labelled(tokens, verdict)``, all rows of it.

    Known are all tokens that reach the support, at most an address's mean number of tokens / ``support``; all of an address's combine. A token's weight is how many more
    (or fewer) of its addresses are blocked than of all. A rule goes where one with a token less has at least its confidence. So three sorts of tokens need not
    combine, and nothing is lost: tokens of one verdict only (their own rule is sure), tokens of every address (they tell nothing beside others), and of tokens that come in just the same addresses all
    but the first, which stands for them; n such tokens would have 2^n combinations. Bounds are for callers that want them: the ``tokens`` most telling, the ``combined`` most telling of an address,
    the ``rules`` best. Without labelled rows, or with none frequent enough, there are no rules.
    """
    kept = materialize(labelled.select("tokens", (F.col("verdict") == BLOCK).cast("int").alias("blocked")), "labelled")
    n, blocked = kept.agg(F.count("*"), F.coalesce(F.sum("blocked"), F.lit(0))).first()
    support = min(1.0, max(support, least / n)) if n else 1.0
    seen = kept.select(F.explode("tokens").alias("token"), "blocked").groupBy("token").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked"))
    telling = F.abs(F.col("blocked") - F.col("n") * (blocked / n if n else 0.0))
    known = [r["token"] for r in seen.where(F.col("n") >= max(support * n, least)).orderBy(telling.desc(), "token").limit(tokens or _ALL).collect()]
    codes = {token: i for i, token in enumerate(known)}
    if not codes:
        discard(kept)
        return Miner({}, [])
    own = _coder(codes)("tokens")
    baskets = materialize(kept.select((F.slice(own, 1, combined) if combined else own).alias("codes"), "blocked"), "baskets")
    # Tokens of the same addresses are told by sums of two hashes of them, as addresses of equal tokens have each other's tokens.
    marks = [F.sum(F.xxhash64(F.lit(k), "codes").cast("decimal(38,0)")).alias(f"mark_{k}") for k in (1, 2)]
    each = baskets.select(F.explode("codes").alias("code"), "codes", "blocked").groupBy("code").agg(F.count("*").alias("n"), F.sum("blocked").alias("blocked"), *marks).orderBy("code").collect()
    first: dict[tuple, int] = {}
    same = {r["code"]: first.setdefault((r["n"], r["blocked"], r["mark_1"], r["mark_2"]), r["code"]) for r in each}
    alone = {r["code"]: (r["n"], r["blocked"]) for r in each if same[r["code"]] == r["code"] and (r["blocked"] in (0, r["n"]) or r["n"] == n)}
    single = [([c], v, have / seen_in, have / n) for c, (seen_in, bad) in alone.items() for v, have in ((-2, bad), (-1, seen_in - bad)) if have >= math.ceil(support * n) and have / seen_in >= confidence]
    items = F.concat(_combining(same, alone)("codes"), F.array(F.when(F.col("blocked") == 1, -2).otherwise(-1)))
    mined = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets.select(items.alias("items"))).associationRules
    mined = mined.where(F.element_at("consequent", 1) < 0).where(F.forall("antecedent", lambda x: x >= 0))
    mined = mined.select(F.sort_array("antecedent").alias("tokens"), F.element_at("consequent", 1).alias("verdict"), "confidence", "support")
    mined = materialize(mined.union(kept.sparkSession.createDataFrame(single, "tokens array<int>, verdict int, confidence double, support double")), "mined")
    less = mined.where(F.size("tokens") > 1).select("tokens", "verdict", "confidence", F.explode("tokens").alias("_x"))
    less = less.select("tokens", "verdict", "confidence", F.array_remove("tokens", F.col("_x")).alias("fewer"))
    fewer = mined.select(F.col("tokens").alias("fewer"), "verdict", F.col("confidence").alias("as_sure"))
    idle = less.join(fewer, ["fewer", "verdict"]).where("as_sure >= confidence").select("tokens", "verdict").distinct()
    best = mined.join(idle, ["tokens", "verdict"], "left_anti").orderBy(F.col("confidence").desc(), F.col("support").desc(), F.size("tokens"), "tokens", "verdict").limit(rules or _ALL)
    found = [(frozenset(r["tokens"]), _VERDICT[r["verdict"]], r["confidence"], r["support"]) for r in best.collect()]
    discard(kept, baskets, mined)
    return Miner(codes, found, same)


def matched(miner: Miner):
    """A function of a column of token lists: the number of the best mined rule whose tokens are all there, else null.

    Inverted index: a rule is listed under the last, that is the least telling, of its tokens, so a rule is tried once, and only where that token occurs.
    """
    codes, same, index = miner.codes, miner.same, {}
    for number, (wanted, *_) in enumerate(miner.rules):
        index.setdefault(max(wanted), []).append((number, wanted))

    @F.pandas_udf("int")
    def first_rule(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tokens in batches:
            out = []
            for ts in tokens:
                own = {same.get(codes[t], codes[t]) for t in ts if t in codes}
                hits = (next((n for n, wanted in index.get(c, ()) if wanted <= own), None) for c in own)
                out.append(min((h for h in hits if h is not None), default=None))
            yield pd.Series(out, dtype="object")

    return first_rule


def judge_urls(pages: DataFrame, listed: Sequence[tuple[str, str]], support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST) -> DataFrame:
    """A verdict for each row of ``pages(page_id, url, ...)``: ``page_id, host, path, rule, verdict, mined``.

    ``listed``: rules as (verdict, "host/path"); the longest that fits decides and is told in ``rule``. Addresses that a listed rule decides are the labels that
    FP-growth learns from; the others get the verdict of the best mined rule that fits (told in ``mined``), and are allowed without one.

    Null addresses and those without "://" have an empty host and path, no tokens, and are allowed; repeated rows stay; equal rules
    rank by confidence, support, fewer tokens, then the tokens; an empty table gives an empty one; other columns (pages' html) are not read.
    """
    url = F.col("url").cast("string")
    told = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    told = materialize(told.withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed)), "addresses")
    miner = mine_rules(told.where("listed is not null").select("tokens", F.col("listed.verdict").alias("verdict")), support, confidence, least)
    number = F.when(F.col("listed").isNull(), matched(miner)("tokens"))
    numbered = told.withColumn("number", number)
    names = told.sparkSession.createDataFrame([(i, miner.rules[i][1], miner.told(i)) for i in range(len(miner.rules))], "number int, found string, mined string")
    verdict = F.coalesce(F.col("listed.verdict"), F.col("found"), F.lit(ALLOW))
    return numbered.join(names, "number", "left").select("page_id", "host", "path", F.col("listed.rule").alias("rule"), verdict.alias("verdict"), "mined")
