"""Orders written as list payloads of three sites, one JSON, one HTML and one XML, and read back by the one job for all sites."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.plans.feeds import _orders, _written
from corvane.rules import job


def _day(x, form, plus=0):
    return F.date_format(F.date_add(x["l_shipdate"].cast("date"), plus), form)


def _text(x, name):
    return x[name].cast("string")


def _payloads(spark, sf):
    """A third of the orders as payloads of each site; the lines of an order are its rows."""
    order = _orders(spark, sf)
    on = lambda x: x["l_linestatus"] == "O"
    much = lambda x: x["l_quantity"] > 25
    objects = F.transform("lines", lambda x: F.struct(
        F.concat(F.lit(" P"), _text(x, "l_partkey")).alias("prdName"), x["l_returnflag"].alias("prdGun"), x["l_linestatus"].alias("prdGb"), x["l_partkey"].alias("prdCode"), F.when(x["l_linenumber"] % 2 == 0, _text(x, "l_suppkey")).otherwise("").alias("jongGb"),
        F.when(x["l_returnflag"] == "A", 1).when(x["l_returnflag"] == "R", 2).otherwise(0).alias("displayGb"), _day(x, "yyyyMMdd").alias("saleStDt"), F.when(on(x), "99991231").otherwise(_day(x, "yyyyMMdd", 9)).alias("saleEnDt"),
        F.concat(F.lit("/docs/"), _text(x, "l_partkey"), F.lit(".pdf")).alias("prdfilename1"), F.when(much(x), F.concat(F.lit("https://f.example/"), _text(x, "l_suppkey"), F.lit(".pdf"))).alias("prdfilename2"), F.lit("/other.pdf").alias("prdfilename4"),
    ))
    listed = F.to_json(F.struct(F.struct(F.struct(F.struct(objects.alias("list")).alias("data")).alias("body")).alias("responseMessage")))

    def cell(content):
        return F.concat(F.lit("<td>"), content, F.lit("</td>"))

    def link(path, x, name):
        return F.concat(F.lit(f"<a href='/{path}/"), _text(x, name), F.lit(".pdf'>PDF</a>"))

    rows = F.transform("lines", lambda x, i: F.concat(
        F.lit("<tr>"), F.when(i == 0, F.concat(F.lit("<td rowspan='"), F.size("lines").cast("string"), F.lit("'>P"), _text(x, "l_partkey"), F.lit("</td>"))).otherwise(""), cell(F.concat(_day(x, "yyyy.MM.dd"), F.lit(" ~ "), F.when(on(x), "현재").otherwise(_day(x, "yyyy.MM.dd", 9)))),
        cell(link("m", x, "l_partkey")), cell(F.when(much(x), link("t", x, "l_suppkey")).otherwise("-")), F.lit("<td></td></tr>"),
    ))
    page = F.concat(F.lit("<table><tr><th>상품명</th><th>판매기간</th><th>사업방법서</th><th>상품약관</th><th>상품요약서</th></tr>"), _written(rows), F.lit("</table>"))

    def element(tag, content):
        return F.concat(F.lit(f"<{tag}>"), content, F.lit(f"</{tag}>"))

    columns = F.concat(F.lit("<r>"), _written(F.transform("lines", lambda x: F.concat(
        element("pdtSelStDt", _day(x, "yyyyMMdd")), element("pdtSelEdDt", F.when(on(x), "").otherwise(_day(x, "yyyyMMdd", 9))), element("fileId", F.concat(F.lit("f"), _text(x, "l_suppkey"))), element("plcndAfileNm", F.when(much(x), "a.pdf").otherwise("")), element("plcndAfileSeqn", _text(x, "l_linenumber")),
    ))), _written(F.transform(F.slice("lines", 1, F.size("lines") - 1), lambda x: element("pdtNm", F.concat(F.lit("P&amp;"), _text(x, "l_partkey"))))), F.lit("</r>"))
    place = F.col("l_orderkey") % 3
    key = F.col("l_orderkey").cast("string")
    context = F.create_map(*[x for pair in ((F.lit("tab"), F.lit("판매중")), (F.lit("category"), F.lit("C")), (F.lit("group"), F.concat(F.lit("G"), (F.col("l_orderkey") % 10).cast("string"))), (F.lit("kind"), F.lit("K")), (F.lit("code"), key), (F.lit("product_name"), F.concat(F.lit("L"), key))) for x in pair])
    company = F.when(place == 0, "SAMSUNG").when(place == 1, "LINA_NON_LIFE").otherwise("NH_FIRE")
    return order.select(F.col("l_orderkey").alias("ingest_seq"), company.alias("company"), context.alias("context"), F.when(place == 0, listed).when(place == 1, page).otherwise(columns).alias("body"))


def site_versions(spark, sf):
    """Versions of all three sites."""
    told = job.site_versions(_payloads(spark, sf))
    days = [F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("sale_start_date", "sale_end_date")]
    return told.select("ingest_seq", "row_no", "company", "product_name_raw", "product_category", "source_product_id", "sale_status", *days, "version_key", F.size("documents").alias("documents"))


def site_documents(spark, sf):
    """Their documents."""
    told = job.site_versions(_payloads(spark, sf)).select("ingest_seq", "row_no", F.posexplode("documents").alias("place", "d"))
    return told.select("ingest_seq", "row_no", "place", "d.*")


QUERIES = {f.__name__: f for f in (site_versions, site_documents)}

_LINES = """l AS (
  SELECT l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_quantity AS q, l_shipdate::DATE AS d, l_returnflag AS f, l_linestatus AS st,
    row_number() OVER w AS r, first_value(l_partkey) OVER w AS head, count(*) OVER (PARTITION BY l_orderkey) AS c
  FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate, l_returnflag, l_linestatus)
)"""

ORACLES = {
    "site_versions": f"""WITH {_LINES}
SELECT o AS ingest_seq, r AS row_no, ['SAMSUNG', 'LINA_NON_LIFE', 'NH_FIRE'][o % 3 + 1] AS company,
  CASE o % 3 WHEN 0 THEN 'P' || p WHEN 1 THEN 'P' || head ELSE CASE WHEN r < c THEN 'P&' || p ELSE 'L' || o END END AS product_name_raw,
  CASE o % 3 WHEN 0 THEN f || ' / ' || st WHEN 1 THEN 'C' ELSE 'G' || (o % 10) || ' / K' END AS product_category,
  CASE o % 3 WHEN 0 THEN p || CASE WHEN n % 2 = 0 THEN '_' || s ELSE '' END WHEN 1 THEN '' ELSE o::VARCHAR END AS source_product_id,
  CASE WHEN CASE WHEN o % 3 = 0 AND f = 'A' THEN true WHEN o % 3 = 0 AND f = 'R' THEN false ELSE st = 'O' END THEN '판매중' ELSE '판매중지' END AS sale_status,
  strftime(d, '%Y-%m-%d') AS sale_start_date, CASE WHEN st <> 'O' THEN strftime(d + 9, '%Y-%m-%d') END AS sale_end_date, strftime(d, '%Y%m%d') || '_판매개시' AS version_key,
  CASE o % 3 WHEN 2 THEN 0 ELSE 1 END + CASE WHEN q > 25 THEN 1 ELSE 0 END AS documents
FROM l""",
    "site_documents": f"""WITH {_LINES}
SELECT o AS ingest_seq, r AS row_no, 0 AS place, CASE o % 3 WHEN 0 THEN 'POLICY' ELSE 'METHOD' END AS document_type, CASE o % 3 WHEN 0 THEN '보험약관' ELSE '사업방법서' END AS document_label,
  CASE o % 3 WHEN 0 THEN 'https://www.samsungfire.com/docs/' ELSE 'https://ec.aceinsurance.co.kr/m/' END || p || '.pdf' AS document_url, CASE o % 3 WHEN 0 THEN p || '.pdf' ELSE '' END AS original_filename, '' AS source_locator
FROM l WHERE o % 3 < 2
UNION ALL
SELECT o, r, CASE o % 3 WHEN 2 THEN 0 ELSE 1 END, CASE o % 3 WHEN 0 THEN 'METHOD' ELSE 'POLICY' END, ['사업방법서', '상품약관', '약관'][o % 3 + 1],
  CASE o % 3 WHEN 0 THEN 'https://f.example/' || s || '.pdf' WHEN 1 THEN 'https://ec.aceinsurance.co.kr/t/' || s || '.pdf' ELSE 'https://www.nhfire.co.kr/imageView/downloadFile.ajax?fileId=f' || s || '&afileSeqn=' || n END,
  CASE o % 3 WHEN 0 THEN s || '.pdf' WHEN 1 THEN '' ELSE 'a.pdf' END, ''
FROM l WHERE q > 25""",
}
