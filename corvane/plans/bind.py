"""How the given tables stand in for companies, product versions, documents, plans, events and pages.

``SQL`` holds the same views for a SQL engine, as common table expressions by name.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources.payloads import _few

#: Labels that documents get in turn, raw states of return flags, and states of orders.
LABELS = ("보험약관", "상품요약서", "사업방법서", "보험료 예시", "기타첨부자료", "상품설명서", "특별 약관", "요약서(약관 포함)")
RAW_STATES = {"A": "판매중", "R": "판매 중지", "N": "확인중"}
PLAN_STATES = {"F": "SUCCESS", "O": "DOWNLOAD_FAILED", "P": "DUPLICATE_SKIPPED"}
EVENT_STATES = {"view": "SUCCESS", "click": "DUPLICATE_SKIPPED", "purchase": "DOWNLOAD_FAILED", "signup": "DRY_RUN", "error": "INVALID_FILE"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(column, values: dict[str, str]):
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for k, v in values.items():
        out = out.when(column == k, v)
    return out


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rest = F.col("n_nationkey") % 10
    status = F.when(rest == 0, "DISABLED").when(rest == 7, "ACCESS_RESTRICTED").otherwise("ACTIVE")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(F.upper("n_name").alias("code"), F.col("n_nationkey").alias("nation"), F.col("r_name").alias("region"), status.alias("collection_status"))


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as product versions: the supplier's nation is the company, the part is the product."""
    li, s, n, p = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation", "part"))
    day = F.to_date("l_shipdate")
    n_ = F.col("l_linenumber")
    start = F.when(n_ != 7, day)
    seq = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus")
    joined = li.join(s, li.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).join(p, li.l_partkey == p.p_partkey)
    revision, disclosure = F.when(n_ % 3 == 0, F.date_add(day, 10)), F.when(n_ % 4 == 1, F.date_sub(day, 3))
    return joined.select(
        seq.alias("ingest_seq"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.upper("n_name").alias("company_code"),
        F.col("l_partkey").cast("string").alias("source_product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        mapped(F.col("l_returnflag"), RAW_STATES).alias("raw_status"),
        start.alias("sale_start_date"),
        F.when(F.col("l_linestatus") != "O", F.date_add(day, (F.col("l_quantity") * 30).cast("int"))).alias("sale_end_date"),
        revision.alias("revision_date"),
        disclosure.alias("disclosure_date"),
        F.coalesce(revision, start, disclosure).alias("target_date"),
    )


def documents_of(v: DataFrame) -> DataFrame:
    """Up to four documents of each version, one row each, and one with nulls for a version without any."""
    count = F.col("l_linenumber") % 5
    told = v.withColumn("i", F.explode(F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array(F.lit(None).cast("int")))))
    label = F.when(F.col("i").isNotNull(), F.element_at(F.array(*map(F.lit, LABELS)), ((F.col("l_partkey") + F.coalesce("i", F.lit(0)) * 3) % len(LABELS) + 1).cast("int")))
    url = F.when((F.col("l_orderkey") + F.col("i")) % 7 != 0, F.concat(F.lit("https://docs.example/"), F.col("source_product_id"), F.lit("/"), F.col("i").cast("string"), F.lit(".pdf"))).otherwise(F.when(F.col("i").isNotNull(), ""))
    return told.withColumn("label", label).withColumn("url", url)


def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as plan items, with the state of an earlier run."""
    o = table(spark, sf_dir, "orders")
    key = F.sha2(F.col("o_orderkey").cast("string"), 256)
    return o.select(
        F.col("o_orderkey").alias("ingest_seq"), key.alias("plan_key"), F.col("o_custkey").cast("string").alias("dedupe_key"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
        mapped(F.col("o_orderstatus"), PLAN_STATES).alias("download_status"), F.concat(F.lit("files/"), F.col("o_custkey").cast("string")).alias("saved_relative_path"), F.col("o_orderdate").alias("updated_at"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a document (the user): three clocks, some of them late by the event's value."""
    e = table(spark, sf_dir, "events")
    late = lambda share: (F.col("ts").cast("timestamp") - F.make_dt_interval(mins=(F.col("value") * share).cast("int")))
    return e.select(
        (F.col("event_id") + 1).alias("seq"), F.col("event_id"), F.concat(F.lit("DOC_"), F.lpad(F.col("user_id").cast("string"), 10, "0")).alias("document_key"),
        F.when(F.col("event_id") % 3 == 0, "upsert_seen").otherwise("upsert_result").alias("operation"), "event_type", "value", "ts",
        late(20).alias("seen_at"), late(35).alias("attempt_at"), F.when(F.col("event_id") % 5 != 0, late(50)).alias("checked_at"), mapped(F.col("event_type"), EVENT_STATES).alias("attempt_status"),
    )


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source as the pages of one document, in order of doc_id."""
    from corvane.operators.pages import numbered_pages

    return numbered_pages(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "source", "doc_id")


def cell_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as tables: turns are rows, words are cells."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.split(F.regexp_replace("text", r"\s+", " "), " ").alias("cells"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("turn", "cells"))), lambda x: x["cells"])
    return c.groupBy("conv_id").agg(rows.alias("rows"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as error pages and documents as files, with status codes, types and extensions in turn."""
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("response_id"), F.when(F.col("page_id") % 9 == 0, 403).when(F.col("page_id") % 11 == 0, 500).otherwise(200).alias("status_code"), F.lit("text/html").alias("content_type"), F.lit(".pdf").alias("extension"), F.col("html").cast("binary").alias("body"))
    kinds = F.element_at(F.array(*map(F.lit, (".pdf", ".zip", ".txt", ".hwp", ""))), (F.col("doc_id") % 5 + 1).cast("int"))
    body = F.when(F.col("doc_id") % 7 == 0, "").when(F.col("doc_id") % 2 == 0, F.concat(F.lit("%PDF-1.4 "), "text")).otherwise(F.concat(F.lit("DATA "), "text"))
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("response_id"), F.lit(200).alias("status_code"), F.when(F.col("doc_id") % 3 == 0, "application/pdf; x").otherwise("text/plain").alias("content_type"), kinds.alias("extension"), body.cast("binary").alias("body"))
    return p.union(d)


_V = f"""v AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag, l_linestatus, upper(n_name) AS company_code,
    l_partkey::VARCHAR AS source_product_id, p_name AS product_name, p_type AS product_category, {_case("l_returnflag", RAW_STATES)} AS raw_status,
    CASE WHEN l_linenumber <> 7 THEN l_shipdate::DATE END AS sale_start_date,
    CASE WHEN l_linestatus <> 'O' THEN l_shipdate::DATE + (l_quantity * 30)::INTEGER END AS sale_end_date,
    CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate::DATE + 10 END AS revision_date,
    CASE WHEN l_linenumber % 4 = 1 THEN l_shipdate::DATE - 3 END AS disclosure_date,
    coalesce(CASE WHEN l_linenumber % 3 = 0 THEN l_shipdate::DATE + 10 END, CASE WHEN l_linenumber <> 7 THEN l_shipdate::DATE END, CASE WHEN l_linenumber % 4 = 1 THEN l_shipdate::DATE - 3 END) AS target_date
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
)"""
_SEQ = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag, l_linestatus"
_BARE = "lower(regexp_replace(label, '\\s+', '', 'g'))"
_KIND = f"""CASE WHEN {_BARE} LIKE '%상품요약서%' THEN 'SUMMARY' WHEN {_BARE} LIKE '%사업방법서%' THEN 'METHOD' WHEN regexp_matches({_BARE}, '보통약관|특별약관|보험약관|상품약관') THEN 'POLICY'
    WHEN {_BARE} LIKE '%상품요약%' THEN 'SUMMARY' WHEN {_BARE} LIKE '%사업방법%' THEN 'METHOD' WHEN {_BARE} LIKE '%요약서%' THEN 'SUMMARY' WHEN {_BARE} LIKE '%약관%' THEN 'POLICY'
    WHEN {_BARE} LIKE '%요약%' THEN 'SUMMARY' ELSE 'UNKNOWN_DOCUMENT_TYPE' END"""
_D = f"""d0 AS (SELECT *, unnest(CASE WHEN l_linenumber % 5 > 0 THEN range(0, l_linenumber % 5) ELSE [NULL::BIGINT] END) AS i FROM v),
d1 AS (
  SELECT *, ['{"', '".join(LABELS)}'][((l_partkey + i * 3) % {len(LABELS)} + 1)::INTEGER] AS label,
    CASE WHEN (l_orderkey + i) % 7 <> 0 THEN 'https://docs.example/' || source_product_id || '/' || i || '.pdf' WHEN i IS NOT NULL THEN '' END AS url
  FROM d0
),
d AS (
  SELECT *, CASE WHEN label IS NULL THEN NULL WHEN regexp_matches({_BARE}, '보험료예시|가입설계서|핵심설명서|비교안내서|확인서|안내장|브로슈어|상품설명서|청약서') THEN NULL ELSE {_KIND} END AS document_type,
    coalesce(url, '') <> '' AS linked
  FROM d1
)"""
_E = f"""e AS (
  SELECT event_id + 1 AS seq, event_id, 'DOC_' || lpad(user_id::VARCHAR, 10, '0') AS document_key, CASE WHEN event_id % 3 = 0 THEN 'upsert_seen' ELSE 'upsert_result' END AS operation, event_type, value, ts,
    ts - to_minutes(trunc(value * 20)::BIGINT) AS seen_at, ts - to_minutes(trunc(value * 35)::BIGINT) AS attempt_at, CASE WHEN event_id % 5 <> 0 THEN ts - to_minutes(trunc(value * 50)::BIGINT) END AS checked_at,
    {_case("event_type", EVENT_STATES)} AS attempt_status
  FROM events
)"""
_P = f"""p AS (
  SELECT o_orderkey AS ingest_seq, sha256(o_orderkey::VARCHAR) AS plan_key, o_custkey::VARCHAR AS dedupe_key, strftime(o_orderdate, '%Y-%m') AS month, {_case("o_orderstatus", PLAN_STATES)} AS download_status,
    'files/' || o_custkey AS saved_relative_path, o_orderdate AS updated_at
  FROM orders
)"""
_C = "c AS (SELECT upper(n_name) AS code, n_nationkey AS nation, r_name AS region, CASE n_nationkey % 10 WHEN 0 THEN 'DISABLED' WHEN 7 THEN 'ACCESS_RESTRICTED' ELSE 'ACTIVE' END AS collection_status FROM nation JOIN region ON n_regionkey = r_regionkey)"
_CELLS = "w AS (SELECT conv_id, turn, string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS cells FROM conversations)"
SQL = {"v": _V, "d": _D, "e": _E, "p": _P, "c": _C, "cells": _CELLS, "seq": _SEQ}


def encoded_pages(spark, sf):
    """Every page below a Korean heading as bytes: UTF-8, or for odd pages EUC-KR, whose missing characters become references; some with their header."""

    def run(batches):
        for batch in _few(batches):
            told = zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            bodies = [None if h.as_py() is None else f"<!-- 상품 약관 -->{h.as_py()}".encode(*(("euc_kr", "xmlcharrefreplace") if (i or 0) % 2 else ("utf-8",))) for i, h in told]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.binary())], names=["page_id", "body"])

    p = table(spark, sf, "pages").select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return p.mapInArrow(run, "page_id long, body binary").withColumn("content_type", F.when(F.col("page_id") % 3 == 0, "text/html; charset=euc-kr"))
