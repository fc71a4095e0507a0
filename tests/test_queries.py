"""Every registered query against its SQL equivalent, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from corvane.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(df: pd.DataFrame) -> list[str]:
    def one(v):
        if v is None or (not isinstance(v, (list, dict)) and pd.isna(v)):
            return "null"
        if isinstance(v, (bool, str)):
            return str(v)
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        return f"{float(v):.9g}"

    df = df[sorted(df.columns)]
    return sorted("|".join(map(one, row)) for row in df.astype(object).itertuples(index=False))


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, SF).toPandas()
    assert len(got.columns) == len(set(got.columns))
    if name in ORACLES:
        want = sql.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)


def test_entry_works_without_the_subpackage(tmp_path):
    """The entry module imports, and lists the other queries, where the subpackage and the pipeline are gone."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "spark-warehouse"))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and not [q for q in e.queries() if q.startswith('op') and q[2].isdigit()]; print(len(e.oracle_sql()))"
    others = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.realpath(p) != root]
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env={**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path / "r"), *others])}, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr


def test_decoded_payloads_are_whole_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["decoded_payloads"](spark, SF).collect()
    assert len(got) == len(pages) and {r.charset for r in got} == {"utf-8", "euc-kr"}
    for r in got:
        page = f"<!-- 상품 약관 -->{pages[r.page_id]}"
        assert not r.replaced and r.charset == ("euc-kr" if r.page_id % 2 else "utf-8")
        assert r.text == (page.encode("euc_kr", "xmlcharrefreplace").decode("euc_kr") if r.page_id % 2 else page)
