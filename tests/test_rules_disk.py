"""Versions are made from their payload where it lies: no shuffle and no stored table but for sites whose rows may be the same."""

import glob
import json

from corvane.rules.job import site_versions
from corvane.sources.scratch import fresh_path
from tests.test_rules import ENDED, KIND, ON, a, table, td, under


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def test_nothing_is_shuffled_or_stored(spark, tmp_path):
    spans = [td("퍼", " rowspan=2"), td("2026.01.01 ~"), td(), td(a("p.pdf")), td()], [td("2025.01.01 ~ 2025.12.31"), td(), td(a("/q.pdf")), td()]
    rows = [(1, "LINA_NON_LIFE", {"tab": ON, "category": "여행"}, table(*spans, head=("상품명", "기간", "a", "b", "c"))), (2, "DB", {}, under("result", [{"PDC_NM": "가", "SQNO": 1, "INPL_FINM": "x.pdf"}]))]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/in")
    shared = fresh_path(spark, "x").rsplit("/", 2)[0]
    before = _files(shared)
    df = site_versions(spark.read.parquet(f"{tmp_path}/in").where("company in ('LINA_NON_LIFE', 'DB')"))
    assert _shuffles(df) <= 1  # that of sites with an identity
    got = sorted((r.ingest_seq, r.row_no, r.product_name_raw, [d.document_url for d in r.documents]) for r in df.collect())
    at = "https://ec.aceinsurance.co.kr"
    assert got == [(1, 1, "퍼", [f"{at}/p.pdf"]), (1, 2, "퍼", [f"{at}/q.pdf"]), (2, 1, "가", ["https://www.idbins.com/cYakgwanDown.do?FilePath=InsProduct/x.pdf"])]
    assert _files(shared) == before


def test_companies_that_cannot_occur_are_left_out(spark):
    from pyspark.sql import functions as F

    company = F.when(F.col("id") % 2 == 0, "DB").otherwise("AIG")
    df = spark.range(4).select(F.col("id").alias("ingest_seq"), company.alias("company"), F.lit(None).cast("map<string,string>").alias("context"), F.lit('{"result":[{"PDC_NM":"x"}],"list":[{"pdnm":"y"}]}').alias("body"))
    versions = site_versions(df)
    assert _shuffles(versions) == 0
    assert sorted(r.product_name_raw for r in versions.collect()) == ["x", "x", "y", "y"]


def test_same_rows_of_two_payloads_still_count_once(spark):
    body = lambda *names: json.dumps({"listDisclosure": [{"insNm": n, "inscd": n[0]} for n in names]})
    df = spark.createDataFrame([(2, "LINA_LIFE", {"tab": ENDED}, body("a late", "b")), (1, "LINA_LIFE", {"tab": ON}, body("a", "c", "a again"))], KIND)
    assert sorted((r.ingest_seq, r.row_no, r.product_name_raw) for r in site_versions(df).collect()) == [(1, 1, "a"), (1, 2, "c"), (2, 2, "b")]


def test_the_query_shuffles_its_lines_only(spark):
    from corvane.plans.sites import site_versions as query

    assert _shuffles(query(spark, "/root/testdata/sf0.001")) == 1
