"""Versions matched with catalog and active rows: as one by one, and in groups of many rows."""

import random
from collections import Counter

from corvane.operators import joins
from pyspark.sql import functions as F

SIDE = "company_code string, source_product_id string, name string, sale_start string, target string"


def drawn(seed, n):
    rnd = random.Random(seed)
    pick = lambda *xs: rnd.choice(xs)
    return [(pick("A", " a", "B", None), pick("1", "2", "", None), pick("x", "y", "", None), pick("d1", "d2", "", None), pick("t1", "t2", "", None)) for _ in range(n)]


def same(a, b):
    (_, ia, na, sa, ta), (_, ib, nb, sb, tb) = (tuple(x or None for x in row) for row in (a, b))
    if ia and ib:
        return ia == ib and sa == sb
    return na is not None and na == nb and (sa == sb if sa and sb else ta is not None and ta == tb)


def test_counts_are_those_of_the_pairs(spark):
    ours, theirs = drawn(1, 120), drawn(2, 150)
    company = lambda row: (row[0] or "").strip().upper()
    want = Counter(company(a) for a in ours for b in theirs if company(a) and company(a) == company(b) and same(a, b))
    a, b = spark.createDataFrame(ours, SIDE), spark.createDataFrame(theirs, SIDE)
    assert {r.company_code: r.matches for r in joins.match_counts(a, b).collect()} == want
    pairs = joins.match_versions(a, b).groupBy(F.upper(F.trim("v.company_code")).alias("c")).count().collect()
    assert {r.c: r["count"] for r in pairs} == want


def test_many_copies_of_a_name_are_counted_without_pairs(spark):
    n = 200_000
    row = lambda i: spark.range(n).select(F.lit("A").alias("company_code"), i.alias("source_product_id"), F.lit("x").alias("name"), F.lit("d").alias("sale_start"), F.lit("t").alias("target"))
    got = joins.match_counts(row(F.lit(None).cast("string")), row(F.col("id").cast("string"))).collect()
    assert [(r.company_code, r.matches) for r in got] == [("A", n * n)]


def test_active_rows_by_days(spark):
    rows, active = [r[:4] for r in drawn(3, 150)], [r[:4] for r in drawn(4, 12)]

    def meets(a, b):
        (ca, ia, na, sa), (cb, ib, nb, sb) = (tuple(x or None for x in row) for row in (a, b))
        if ca is None or ca != cb or (sa and sb and sa != sb):
            return False
        return ia == ib if ia and ib else na is not None and na == nb

    want = Counter({a for a in rows if any(meets(a, b) for b in active)})
    kind = SIDE.rpartition(",")[0]
    got = joins.matches_active(spark.createDataFrame(rows, kind), spark.createDataFrame(active, kind))
    assert Counter(tuple(r) for r in got.collect()) == want


def test_active_rows_of_one_name_are_met_as_one(spark):
    of_name = lambda n, day: spark.range(n).select(F.lit("A").alias("company_code"), F.lit(None).cast("string").alias("source_product_id"), F.lit("x").alias("name"), day.alias("sale_start"), F.col("id").alias("other"))
    rows, active = of_name(60_000, F.lit("never")), of_name(60_000, F.concat(F.lit("d"), (F.col("id") % 50).cast("string")))
    assert joins.matches_active(rows, active.drop("other")).count() == 0
    offered = [line for line in joins.matches_active(rows, active)._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftSemi" in line]
    assert not offered
