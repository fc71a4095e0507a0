"""Questions about texts, addresses, words, lines, pages and tables of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.functions import cells, dates, text
from corvane.operators import pages, rebuilt, reports, tables
from corvane.plans import bind
from corvane.plans.bind import SQL, table

_V = SQL["v"]


# Dates and texts.


def month_bounds(spark, sf):
    """First and last day of each month of orders."""
    told = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month")).withColumn("b", dates.month_bounds(F.col("month")))
    return told.groupBy("month").agg(F.date_format(F.max("b.first"), "yyyy-MM-dd").alias("first"), F.date_format(F.min("b.last"), "yyyy-MM-dd").alias("last"))


def period_scopes(spark, sf):
    """Names of sale periods."""
    v = bind.versions(spark, sf)
    return v.groupBy(dates.period_scope(F.trunc("sale_start_date", "month"), F.col("sale_end_date")).alias("scope")).agg(F.count("*").alias("versions"))


def month_arguments(spark, sf):
    """Versions of a month that comes as a job's argument, and of a range of two months."""
    v = bind.versions(spark, sf)
    (a, b), (c, d) = dates.month_range("1998-02"), dates.date_range("1998-02-01", "1998-03-31")
    return v.agg(F.count_if(dates.in_period(F.col("sale_start_date"), F.lit(a), F.lit(b))).alias("in_month"), F.count_if(dates.overlaps(F.col("sale_start_date"), F.col("sale_end_date"), F.lit(c), F.lit(d))).alias("in_range"))


def target_dates(spark, sf):
    """The date that a version counts under."""
    v = bind.versions(spark, sf).withColumn("day", dates.target_date(F.col("revision_date"), F.col("sale_start_date"), F.col("disclosure_date")))
    return v.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.count("*").alias("versions"), F.count_if(F.col("day") == F.col("revision_date")).alias("revised"))


def composed_names(spark, sf):
    """Names whose letters come apart, composed; and in compatibility form with folded case."""
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("\u110b\u1163\u11a8\u1100\u116a\u11ab E\u0301 "), F.col("p_name")).alias("name"), F.upper(F.concat(F.lit("４５㎏ "), F.col("p_name"))).alias("wide"))
    return p.select("p_partkey", text.nfc(F.col("name")).alias("name"), text.folded(F.col("wide")).alias("wide"))


def clean_texts(spark, sf):
    """Texts with single blanks, and how many characters they have without any."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit(" \t"), F.replace("text", F.lit(" "), F.lit(" \n ")), F.lit("\r\n")).alias("text"))
    return c.select("conv_id", "turn", F.sha2(text.clean(F.col("text")), 256).alias("digest"), text.effective_length(F.col("text")).alias("characters"))


def guessed_extensions(spark, sf):
    """File types by header, address and content type."""
    d, key = table(spark, sf, "orders").select("o_orderkey"), F.col("o_orderkey")
    way = key % 5
    url = F.when(way == 0, F.concat(F.lit("https://x.kr/a/"), key.cast("string"), F.lit(".HWP?v=1"))).when(way == 1, F.concat(F.lit("https://x.kr/get?fileNm=a_"), key.cast("string"), F.lit(".pdf"))).otherwise("https://x.kr/get")
    header = F.when(way == 2, F.concat(F.lit('attachment; filename="doc'), key.cast("string"), F.lit('.zip"')))
    told = d.withColumn("extension", text.guess_extension(url, header, F.when(way == 3, "application/pdf; charset=x").otherwise("text/plain")))
    return told.groupBy("extension").agg(F.count("*").alias("files"))


def call_arguments(spark, sf):
    """Arguments of script calls in links."""
    li = table(spark, sf, "lineitem")
    call = F.concat(F.lit("javascript:fnDown('"), F.col("l_returnflag"), F.lit(", x', "), F.col("l_partkey").cast("string"), F.lit(',"'), F.col("l_linestatus"), F.lit('",\'\'); return false'))
    told = li.withColumn("a", text.call_arguments(call, "fnDown")).withColumn("none", text.call_arguments(call, "fnOpen"))
    return told.groupBy(F.array_join("a", "|").alias("arguments"), F.size("none").alias("others")).agg(F.count("*").alias("links"))


def attachments(spark, sf):
    """Attachments of cells, one a line, with the parts of each."""
    o = table(spark, sf, "orders")
    cell = F.concat(F.lit("/files/a^10^20^"), F.col("o_orderkey").cast("string"), F.lit("\r\n \r\n/files/b^30^"), F.col("o_orderstatus"), F.lit("\r/files/c"))
    told = o.select("o_orderkey", F.posexplode(text.cell_lines(cell)).alias("pos", "entry"))
    return told.select("o_orderkey", "pos", text.marker_field(F.col("entry"), 1).alias("path"), text.marker_field(F.col("entry"), 3).alias("third"), text.joined([F.col("entry"), F.lit(None)]).alias("identity"), text.joined_filled([text.marker_field(F.col("entry"), 2), F.lit(" "), F.lit("z")]).alias("label"))


def scrubbed_addresses(spark, sf):
    """Addresses and form fields without secrets, and what documents are told apart by."""
    o, key = table(spark, sf, "orders"), F.col("o_orderkey").cast("string")
    url = F.concat(F.lit("https://x.kr/a?id="), key, F.lit("&authToken=s"), key, F.lit("&no=1#top"))
    hint = F.concat(F.lit('{"b":{"sessionId":"s","no":'), key, F.lit('},"a":[{"apiKey":1,"u":"https://x.kr/?sig=2&k=3"}],"c":null}'))
    way = F.col("o_orderkey") % 4
    locator = text.source_locator(F.when(way == 0, F.concat(F.lit("loc  "), key)), F.when(way == 1, url), F.when(way == 2, hint), F.concat(F.lit(" f "), key))
    return o.select("o_orderkey", text.scrub_url(url).alias("url"), text.scrub_json(hint).alias("hint"), locator.alias("locator"))


def line_keys(spark, sf):
    """What lines with page numbers have in common."""
    o, key = table(spark, sf, "orders"), F.col("o_orderkey").cast("string")
    way = F.col("o_orderkey") % 5
    line = F.when(way == 0, F.concat(F.lit("상품  약관 "), key, F.lit(" / 99999"))).when(way == 1, F.concat(F.lit("- "), key, F.lit(" -"))).when(way == 2, F.concat(F.lit("Page "), key)).when(way == 3, F.concat(F.lit("see p. "), key, F.lit(" of 9 now"))).otherwise(F.concat(key, F.lit("원")))
    return o.groupBy(F.when(way == 4, F.regexp_replace(pages.line_key(line), r"^\d+", "N")).otherwise(pages.line_key(line)).alias("key")).agg(F.count("*").alias("lines"))


# Words, lines, pages.


def _words(spark, sf):
    """Line items as words: an order is a page, the line number its row, the part its column."""
    li = table(spark, sf, "lineitem")
    top = (F.col("l_linenumber") * 20).cast("double")
    x = (F.col("l_partkey") % 500).cast("double") + F.col("l_quantity") / 100 + F.col("l_suppkey") / 1_000_000 + F.col("l_extendedprice") / 1e9
    return li.select(F.col("l_returnflag").alias("doc_id"), F.col("l_orderkey").cast("int").alias("page_no"), F.col("l_partkey").cast("string").alias("text"), x.alias("x0"), (top + F.col("l_partkey") % 3).alias("top"), (x + 5).alias("x1"), (top + 10).alias("bottom"))


def page_lines(spark, sf):
    """Words of pages as lines."""
    lines = pages.words_to_lines(_words(spark, sf))
    return lines.select("doc_id", "page_no", "line_no", "text")


def words_outside(spark, sf):
    """Words whose middle lies in no table of their page."""
    boxes = table(spark, sf, "orders").select("o_orderkey", F.explode(F.array(*map(F.lit, "ARN"))).alias("doc_id"))
    t = boxes.select("doc_id", F.col("o_orderkey").cast("int").alias("page_no"), F.array(F.lit(0.0), F.lit(30.0), F.when(F.col("o_orderkey") % 2 == 0, 250.0).otherwise(100.0), F.lit(70.0)).alias("bbox"))
    return pages.outside_tables(_words(spark, sf), t).groupBy("doc_id").agg(F.count("*").alias("words"), F.sum(F.col("text").cast("long")).alias("parts"))


def page_bodies(spark, sf):
    """Pages without the lines that most of them share."""
    t = bind.text_pages(spark, sf).select(F.col("source").alias("doc_id"), F.col("page_no").cast("int").alias("page_no"), F.posexplode(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")).alias("i", "line"))
    top = (F.col("i") * 20).cast("double")
    lines = t.select("doc_id", "page_no", (F.col("i") + 1).alias("line_no"), F.col("line").alias("text"), F.lit(0.0).alias("x0"), top.alias("top"), F.lit(9.0).alias("x1"), (top + 10).alias("bottom"))
    removed = lines.where("line_no % 3 = 0").select("doc_id", "page_no", (F.col("top") + 2).alias("top"), (F.col("bottom") - 3).alias("bottom"))
    bodies = pages.body_text(pages.without_lines(lines, removed))
    return bodies.groupBy("doc_id").agg(F.count("*").alias("pages"), F.sum(F.length("body")).alias("characters"), F.max(F.sha2("body", 256)).alias("digest"))


def _quality(spark, sf):
    t = bind.text_pages(spark, sf).select(F.col("source").alias("doc_id"), F.col("page_no").cast("int").alias("page_no"), "text", F.col("doc_id").alias("n"))
    p = t.select("doc_id", "page_no", F.lit(100.0).alias("width"), F.lit(200.0).alias("height"), F.col("text").alias("text_raw"), (F.col("n") % 40 == 7).alias("extraction_failed"))
    bodies = t.select("doc_id", "page_no", F.when(F.col("n") % 6 == 0, "").otherwise(F.col("text")).alias("body"))
    images = t.where("n % 3 = 0").select("doc_id", "page_no", F.explode(F.array(F.lit(40.0), F.lit(90.0))).alias("x1"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("top"), F.when(F.col("n") % 2 == 0, 200.0).otherwise(60.0).alias("bottom"), F.sha2("text", 256).alias("sha256"))
    has = t.where("n % 5 = 0").select("doc_id", "page_no")
    return pages.page_quality(p, bodies, images, has), images, t


def page_qualities(spark, sf):
    """Characters, words, images and status of pages."""
    q = _quality(spark, sf)[0]
    return q.groupBy("doc_id", "page_status").agg(F.count("*").alias("pages"), F.sum("characters").alias("characters"), F.sum("words").alias("words"), F.sum("images").alias("images"), F.sum(F.round(F.col("largest_ratio") * 100).cast("long")).alias("ratio"))


def load_manifests(spark, sf):
    """Counters of loaded documents, and the state of the load."""
    q, images, t = _quality(spark, sf)
    kind = F.element_at(F.array(*map(F.lit, ("MEANINGFUL", "FRAGMENT", "REJECTED"))), (F.col("n") % 3 + 1).cast("int"))
    m = reports.load_manifest(q, t.where("n % 4 <> 0").select("doc_id", kind.alias("status")), images, t.where("n % 9 = 0").select("doc_id"))
    return m.drop("empty_pages", "ocr_required_pages", "text_pages", "characters")


def load_states(spark, sf):
    """The state of loads, one for each source's language, from those of their documents."""
    d = table(spark, sf, "documents").select(F.element_at(F.array(*map(F.lit, ("SUCCEEDED", "PARTIAL", "OCR_REQUIRED", "FAILED"))), (F.col("doc_id") % 4 + 1).cast("int")).alias("status"))
    all_failed = reports.load_status(d.where("status = 'FAILED'")).withColumn("load", F.lit("failed"))
    return reports.load_status(d).withColumn("load", F.lit("mixed")).unionByName(all_failed)


def page_texts(spark, sf):
    """Parts of pages in reading order: tables stand between blank lines."""
    li = table(spark, sf, "lineitem")
    part = F.struct(F.col("l_linenumber").cast("double").alias("y"), F.col("l_extendedprice").alias("x"), F.when(F.col("l_returnflag") == "R", "TABLE").otherwise("TEXT").alias("kind"), F.when(F.col("l_quantity") > 2, F.concat(F.col("l_linestatus"), F.col("l_partkey").cast("string"))).alias("content"))
    p = li.groupBy("l_orderkey").agg(F.collect_list(part).alias("parts"))
    return p.select("l_orderkey", F.sha2(cells.page_markdown(F.col("parts")), 256).alias("digest"))


# Tables.


def _candidates(spark, sf):
    """Parts as table candidates: copies of some lie on them, one-column fragments and single cells in others."""
    p = table(spark, sf, "part")
    page = {"doc_id": F.col("p_brand"), "page_no": F.col("p_partkey").cast("int")}
    grid = F.array(F.array(F.lit("항목"), F.lit("값")), F.array(F.col("p_name"), F.col("p_size").cast("string")))
    one = p.select(*[c.alias(n) for n, c in page.items()], F.lit(0).alias("candidate_index"), F.array(*[F.lit(x) for x in (0.0, 0.0, 100.0, 100.0)]).alias("bbox"), grid.alias("rows"))
    copy = one.withColumn("candidate_index", F.lit(1)).withColumn("bbox", F.when(F.col("page_no") % 2 == 0, F.array(*[F.lit(x) for x in (0.0, 0.0, 100.0, 99.0)])).otherwise(F.array(*[F.lit(x) for x in (0.0, 200.0, 100.0, 300.0)])))
    nested = one.withColumn("candidate_index", F.lit(2)).withColumn("bbox", F.array(*[F.lit(x) for x in (10.0, 10.0, 50.0, 50.0)])).withColumn("rows", F.when(F.col("page_no") % 3 == 0, F.array(F.array(F.lit("값")), F.array(F.col("rows")[1][0]))).otherwise(F.array(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("z"), F.lit("1")))))
    blank = one.withColumn("candidate_index", F.lit(3)).withColumn("rows", F.array(F.array(F.lit(" "))))
    heights = p.select(*[c.alias(n) for n, c in page.items()], F.lit(842.0).alias("height"))
    return tables.without_nested_texts(tables.without_duplicates(tables.assessed(one.union(copy).union(nested).union(blank), heights)))


def table_verdicts(spark, sf):
    """Table candidates with copies and nested fragments judged."""
    return _candidates(spark, sf).select("page_no", "candidate_index", "status", "reason")


def kept_tables(spark, sf):
    """Tables that stand, named, with the table around each."""
    return tables.saved_tables(_candidates(spark, sf)).select("page_no", "candidate_index", "table_id", "contained_by", "nested")


def table_warnings(spark, sf):
    """Warnings about rejected tables."""
    return tables.rejection_warnings(_candidates(spark, sf)).groupBy("code", "message").agg(F.count("*").alias("warnings"))


def control_reports(spark, sf):
    """Control characters in cells: what is left, and where how many were."""
    p = table(spark, sf, "part").select("p_partkey", F.array(F.array(F.col("p_name"), F.lit("a\tb")), F.array(F.concat(F.lit("\x01"), F.col("p_name"), F.lit("\x02\x03")), F.concat(F.col("p_brand"), F.repeat(F.lit("\x1f"), F.col("p_size"))))).alias("rows"))
    told = p.select("p_partkey", F.explode(cells.control_report(F.col("rows"))).alias("r"), cells.without_controls(F.col("rows"))[1].alias("clean"))
    return told.select("p_partkey", "r.row", "r.column", "r.removed_count", F.array_join("clean", "|").alias("clean"))


def table_shapes(spark, sf):
    """Fingerprints with and without a table's shape: the same cells in one row or in one column."""
    p = table(spark, sf, "part")
    wide, tall = F.array(F.array(F.col("p_name"), F.col("p_brand"))), F.array(F.array(F.col("p_name")), F.array(F.col("p_brand")))
    return p.select("p_partkey", cells.shape_fingerprint(wide).alias("wide"), cells.shape_fingerprint(tall).alias("tall"), (cells.text_fingerprint(wide) == cells.text_fingerprint(tall)).alias("same_text"))


def _attempts(spark, sf):
    """Parts as tables that a model rebuilt well or badly, in eight ways."""
    # A part is a short row and a long check, so parts are dealt to the session's number of tasks, not to the file's splits.
    p = table(spark, sf, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey").withColumn("way", F.col("p_partkey") % 8)
    price, size = F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.col("p_size").cast("string")
    row = lambda a, b: F.concat(F.lit("| "), a, F.lit(" | "), b, F.lit(" |"))
    head = F.lit("| 항목 | 값 |\n| --- | --- |\n")
    grid = lambda a, b, c, d: F.concat(head, row(a, b), F.lit("\n"), row(c, d))
    name, brand = F.concat(F.lit("이름 "), F.col("p_name")), F.concat(F.lit("상표 "), F.regexp_replace("p_brand", r"#\d+", ""))
    source = grid(name, F.concat(price, F.lit("원")), brand, F.concat(size, F.lit("개월")))
    told = (
        F.when(F.col("way") == 1, F.replace(source, price, F.concat(F.lit("7"), price)))
        .when(F.col("way") == 2, F.replace(source, F.lit("개월"), F.lit("년")))
        .when(F.col("way") == 3, grid(name, F.concat(size, F.lit("개월")), brand, F.concat(price, F.lit("원"))))
        .when(F.col("way") == 4, F.substring_index(source, "\n", 2))
        .when(F.col("way") == 5, F.concat(F.lit("```\n"), source, F.lit("\n```")))
        .when(F.col("way") == 6, " \n")
        .when(F.col("way") == 7, F.concat(F.lit("# 항목 값\n- "), name, F.lit(": "), price, F.lit("원\n- "), brand, F.lit(": "), size, F.lit("개월")))
        .otherwise(source)
    )
    mode = F.when(F.col("way") == 7, "STRUCTURED_MARKDOWN").otherwise("MARKDOWN_TABLE")
    return p.select(F.col("p_partkey").cast("string").alias("table_id"), F.lit(1).alias("attempt_no"), mode.alias("mode"), source.alias("source_markdown"), told.alias("response_markdown"))


def response_codes(spark, sf):
    """The first rule that each rebuilt table breaks."""
    return rebuilt.check_attempts(_attempts(spark, sf)).select("table_id", "code")


def response_violations(spark, sf):
    """Rebuilt tables by mode and broken rule."""
    return rebuilt.violation_counts(rebuilt.check_attempts(_attempts(spark, sf)))


def rebuilt_tables(spark, sf):
    """How the reconstruction of tables ended: those that were asked for succeeded or fell back to their source."""
    a = _attempts(spark, sf)
    again = a.withColumn("attempt_no", F.lit(2)).withColumn("response_markdown", F.when(F.col("table_id").cast("long") % 16 < 8, F.col("source_markdown")).otherwise(""))
    done = rebuilt.selected_attempts(rebuilt.check_attempts(a.union(again)))
    all_tables = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("table_id")).join(done, "table_id", "left")
    asked = all_tables.withColumn("requested", F.col("table_id").cast("long") % 10 != 0)
    return reports.reconstruction_counts(asked.withColumn("final_status", F.when(F.col("requested"), F.col("final_status"))))


def character_differences(spark, sf):
    """How characters of two texts differ as multisets."""
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.col("p_name"), F.lit("원원%")).alias("l"), F.concat(F.lower("p_type"), F.lit("원")).alias("r"))
    d = rebuilt.character_difference(p, "p_partkey", "l", "r")
    return d.groupBy("token").agg(F.sum("missing").alias("missing"), F.sum("added").alias("added"))


def number_differences(spark, sf):
    """How numbers of two texts differ as multisets."""
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("1,234.5% 7"), F.lit("원 "), F.col("p_size").cast("string")).alias("l"), F.concat(F.lit("1,234.5% -7 x"), F.col("p_size").cast("string")).alias("r"))
    d = rebuilt.number_difference(p, "p_partkey", "l", "r")
    return d.groupBy("token").agg(F.sum("missing").alias("missing"), F.sum("added").alias("added"))


_LAYOUT = (
    month_bounds, period_scopes, month_arguments, target_dates, composed_names, clean_texts, guessed_extensions, call_arguments, attachments, scrubbed_addresses, line_keys, page_lines, words_outside, page_bodies, page_qualities, load_manifests, load_states, page_texts,
    table_verdicts, kept_tables, table_warnings, control_reports, table_shapes, response_codes, response_violations, rebuilt_tables, character_differences, number_differences,
)
QUERIES = {f.__name__: f for f in _LAYOUT}

_TP = "t AS (SELECT source AS doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS page_no, text, doc_id AS n FROM documents)"
_W = """w AS (SELECT l_returnflag AS doc_id, l_orderkey AS page_no, l_partkey AS part, (l_partkey % 500)::DOUBLE + l_quantity / 100 + l_suppkey / 1000000 + l_extendedprice / 1e9 AS x0, l_linenumber * 20 + l_partkey % 3 AS top, l_linenumber * 20 + 10 AS bottom, l_linenumber FROM lineitem)"""
_CH = "len(regexp_extract_all(CASE WHEN n % 6 = 0 THEN '' ELSE text END, '[가-힣A-Za-z0-9]'))"
_Q = f"""{_TP}, q AS (SELECT *, {_CH} AS characters, len(regexp_extract_all(text, '\\S+')) AS words, CASE WHEN n % 3 = 0 THEN 2 ELSE 0 END AS images, CASE WHEN n % 3 <> 0 THEN 0 WHEN n % 2 = 0 THEN 90 ELSE 27 END AS ratio FROM t),
s AS (SELECT *, CASE WHEN n % 40 = 7 THEN 'OCR_REQUIRED' WHEN n % 5 <> 0 AND characters <= 10 AND ratio >= 50 THEN 'OCR_REQUIRED' WHEN n % 5 <> 0 AND characters = 0 THEN 'EMPTY' ELSE 'TEXT' END AS page_status FROM q)"""
_CODE = "CASE p_partkey % 8 WHEN 1 THEN 'NUMERIC_TOKEN_MISMATCH' WHEN 2 THEN 'CONTENT_CHARACTER_MISMATCH' WHEN 3 THEN 'ROW_RELATION_MISMATCH' WHEN 4 THEN 'INVALID_MARKDOWN' WHEN 5 THEN 'CODE_FENCE' WHEN 6 THEN 'EMPTY_RESPONSE' END"
_CAND = """c AS (
  SELECT p_partkey AS page_no, unnest([0, 1, 2, 3]) AS i FROM part
), k AS (SELECT *, CASE WHEN i = 0 THEN 'MEANINGFUL VALUE_TABLE' WHEN i = 1 AND page_no % 2 = 0 THEN 'REJECTED DUPLICATE_TABLE' WHEN i = 1 THEN 'MEANINGFUL VALUE_TABLE'
  WHEN i = 2 AND page_no % 3 = 0 THEN 'REJECTED NESTED_TEXT_DUPLICATE' WHEN i = 2 THEN 'MEANINGFUL VALUE_TABLE' ELSE 'REJECTED EMPTY_TABLE' END AS s FROM c)"""

ORACLES = {
    "month_bounds": "SELECT strftime(o_orderdate, '%Y-%m') AS month, strftime(date_trunc('month', max(o_orderdate)), '%Y-%m-%d') AS first, strftime(last_day(max(o_orderdate)::DATE), '%Y-%m-%d') AS last FROM orders GROUP BY 1",
    "period_scopes": f"WITH {_V} SELECT concat_ws('_', strftime(date_trunc('month', sale_start_date), '%Y%m%d'), strftime(sale_end_date, '%Y%m%d')) AS scope, count(*) AS versions FROM v GROUP BY 1",
    "month_arguments": f"WITH {_V} SELECT count(*) FILTER (sale_start_date BETWEEN DATE '1998-02-01' AND DATE '1998-02-28') AS in_month, count(*) FILTER (coalesce(sale_start_date <= DATE '1998-03-31', true) AND coalesce(sale_end_date >= DATE '1998-02-01', true)) AS in_range FROM v",
    "target_dates": f"WITH {_V} SELECT strftime(target_date, '%Y-%m') AS month, count(*) AS versions, count(*) FILTER (target_date = revision_date) AS revised FROM v GROUP BY 1",
    "composed_names": "SELECT p_partkey, '약관 É ' || p_name AS name, '45kg ' || p_name AS wide FROM part",
    "clean_texts": "SELECT conv_id, turn, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS digest, length(regexp_replace(text, '\\s', '', 'g')) AS characters FROM conversations",
    "guessed_extensions": "SELECT CASE o_orderkey % 5 WHEN 0 THEN '.hwp' WHEN 1 THEN '.pdf' WHEN 2 THEN '.zip' WHEN 3 THEN '.pdf' ELSE '' END AS extension, count(*) AS files FROM orders GROUP BY 1",
    "call_arguments": "SELECT l_returnflag || ', x|' || l_partkey || '|' || l_linestatus || '|' AS arguments, 0 AS others, count(*) AS links FROM lineitem GROUP BY 1",
    "attachments": """SELECT o_orderkey, 0 AS pos, '/files/a' AS path, '20' AS third, '/files/a^10^20^' || o_orderkey || '|' AS identity, '10 / z' AS label FROM orders UNION ALL SELECT o_orderkey, 1, '/files/b', o_orderstatus, '/files/b^30^' || o_orderstatus || '|', '30 / z' FROM orders
UNION ALL SELECT o_orderkey, 2, '/files/c', '', '/files/c|', 'z' FROM orders""",
    "scrubbed_addresses": """WITH o AS (SELECT o_orderkey, 'https://x.kr/a?id=' || o_orderkey || '&no=1' AS url, '{"a":[{"u":"https://x.kr/?k=3"}],"b":{"no":' || o_orderkey || '}}' AS hint FROM orders)
SELECT o_orderkey, url, hint, CASE o_orderkey % 4 WHEN 0 THEN 'loc ' || o_orderkey WHEN 1 THEN url WHEN 2 THEN 'POST|' || hint ELSE 'f ' || o_orderkey END AS locator FROM o""",
    "line_keys": "SELECT ['상품 약관 <page>', '<page>', '<page>', 'see <page> now', 'N원'][o_orderkey % 5 + 1] AS key, count(*) AS lines FROM orders GROUP BY 1",
    "page_lines": f"WITH {_W}, n AS (SELECT doc_id, page_no, l_linenumber, dense_rank() OVER (PARTITION BY doc_id, page_no ORDER BY l_linenumber) - 1 AS line_no, part, x0 FROM w) SELECT doc_id, page_no, line_no, string_agg(part::VARCHAR, ' ' ORDER BY x0, part) AS text FROM n GROUP BY 1, 2, 3",
    "words_outside": f"WITH {_W} SELECT doc_id, count(*) AS words, sum(part)::BIGINT AS parts FROM w WHERE NOT (page_no IN (SELECT o_orderkey FROM orders) AND x0 + 2.5 <= CASE WHEN page_no % 2 = 0 THEN 250 ELSE 100 END AND (top + bottom) / 2 BETWEEN 30 AND 70) GROUP BY 1",
    "page_bodies": f"WITH {_TP}, l AS (SELECT doc_id, page_no, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM t), b AS (SELECT doc_id, array_to_string(list_filter(l, lambda x, i: i % 3 <> 0), chr(10)) AS body FROM l WHERE len(l) > 0) SELECT doc_id, count(*) AS pages, sum(length(body))::BIGINT AS characters, max(sha256(body)) AS digest FROM b GROUP BY 1",
    "page_qualities": f"WITH {_Q} SELECT doc_id, page_status, count(*) AS pages, sum(characters)::BIGINT AS characters, sum(words)::BIGINT AS words, sum(images)::BIGINT AS images, sum(ratio)::BIGINT AS ratio FROM s GROUP BY 1, 2",
    "load_manifests": f"""WITH {_Q} SELECT doc_id, count(*) AS pages, sum(words)::BIGINT AS words, count(*) FILTER (n % 4 <> 0) AS tables, count(*) FILTER (n % 4 <> 0 AND n % 3 = 0) AS meaningful_tables, count(*) FILTER (n % 4 <> 0 AND n % 3 = 1) AS fragment_tables, count(*) FILTER (n % 4 <> 0 AND n % 3 = 2) AS rejected_tables,
  count(*) FILTER (n % 3 = 0) * 2 AS images, count(DISTINCT CASE WHEN n % 3 = 0 THEN text END) AS distinct_images, count(*) FILTER (n % 9 = 0) AS warnings FROM s GROUP BY 1""",
    "load_states": """SELECT 'mixed' AS load, count(*) AS documents, count(*) FILTER (doc_id % 4 = 0) AS succeeded, count(*) FILTER (doc_id % 4 = 1) AS partial, count(*) FILTER (doc_id % 4 = 2) AS ocr_required, count(*) FILTER (doc_id % 4 = 3) AS failed, 'PARTIAL' AS run_status FROM documents
UNION ALL SELECT 'failed', count(*), 0, 0, 0, count(*), 'FAILED' FROM documents WHERE doc_id % 4 = 3""",
    "page_texts": """WITH p AS (SELECT l_orderkey, l_linestatus || l_partkey AS content, l_returnflag = 'R' AS block, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 'TABLE' ELSE 'TEXT' END, l_linestatus || l_partkey) AS i FROM lineitem WHERE l_quantity > 2),
q AS (SELECT *, lag(block) OVER (PARTITION BY l_orderkey ORDER BY i) AS above FROM p), r AS (SELECT l_orderkey, sha256(string_agg(CASE WHEN i = 1 THEN '' WHEN block OR above THEN chr(10) || chr(10) ELSE chr(10) END || content, '' ORDER BY i)) AS digest FROM q GROUP BY 1)
SELECT l_orderkey, coalesce(digest, sha256('')) AS digest FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN r USING (l_orderkey)""",
    "table_verdicts": f"WITH {_CAND} SELECT page_no, i AS candidate_index, split_part(s, ' ', 1) AS status, split_part(s, ' ', 2) AS reason FROM k",
    "kept_tables": f"""WITH {_CAND}, m AS (SELECT *, row_number() OVER (PARTITION BY page_no ORDER BY i) AS n FROM k WHERE s NOT LIKE 'REJECTED%')
SELECT page_no, i AS candidate_index, format('page_{{:04d}}_table_{{:03d}}', page_no, n) AS table_id, CASE WHEN i = 2 THEN format('page_{{:04d}}_table_001', page_no) END AS contained_by, i = 2 OR (i = 0 AND page_no % 3 <> 0) AS nested FROM m""",
    "table_warnings": f"WITH {_CAND} SELECT 'TABLE_REJECTED' AS code, 'table candidate ' || i || ' rejected: ' || split_part(s, ' ', 2) AS message, count(*) AS warnings FROM k WHERE s LIKE 'REJECTED%' GROUP BY 2",
    "control_reports": "SELECT p_partkey, 2 AS row, 1 AS column, 3 AS removed_count, p_name || '|' || p_brand AS clean FROM part UNION ALL SELECT p_partkey, 2, 2, p_size, p_name || '|' || p_brand FROM part WHERE p_size > 0",
    "table_shapes": "WITH p AS (SELECT p_partkey, lower(regexp_replace(p_name, '[^가-힣A-Za-z0-9%]+', '', 'g')) AS a, lower(regexp_replace(p_brand, '[^가-힣A-Za-z0-9%]+', '', 'g')) AS b FROM part) SELECT p_partkey, '1x2:' || a || chr(31) || b AS wide, '2x1:' || a || chr(30) || b AS tall, true AS same_text FROM p",
    "response_codes": f"SELECT p_partkey::VARCHAR AS table_id, {_CODE} AS code FROM part",
    "response_violations": f"SELECT CASE WHEN p_partkey % 8 = 7 THEN 'STRUCTURED_MARKDOWN' ELSE 'MARKDOWN_TABLE' END AS mode, coalesce({_CODE}, 'OK') AS code, count(*) AS attempts FROM part GROUP BY 1, 2",
    "rebuilt_tables": """WITH p AS (SELECT p_partkey % 10 <> 0 AS requested, p_partkey % 8 IN (0, 7) OR (p_partkey % 16 < 8) AS good FROM part)
SELECT count(*) AS tables, count(*) FILTER (requested) AS requested, count(*) FILTER (requested AND good) AS succeeded, count(*) FILTER (requested AND NOT good) AS fallback, count(*) FILTER (NOT requested) AS skipped FROM p""",
    "character_differences": """WITH t AS (SELECT p_partkey, unnest(string_split(regexp_replace(lower(p_name) || '원원%', '[^가-힣a-z0-9%]', '', 'g'), '')) AS token, 1 AS l, 0 AS r FROM part UNION ALL SELECT p_partkey, unnest(string_split(regexp_replace(lower(p_type) || '원', '[^가-힣a-z0-9%]', '', 'g'), '')), 0, 1 FROM part),
n AS (SELECT p_partkey, token, sum(l) - sum(r) AS d FROM t WHERE token <> '' GROUP BY 1, 2 HAVING sum(l) <> sum(r)) SELECT token, sum(greatest(d, 0))::BIGINT AS missing, sum(greatest(-d, 0))::BIGINT AS added FROM n GROUP BY 1""",
    "number_differences": "SELECT '7' AS token, count(*) AS missing, 0 AS added FROM part UNION ALL SELECT '-7', 0, count(*) FROM part",
}
