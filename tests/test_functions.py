"""Rule tables: inputs and what is expected of them."""

import json
import datetime as dt

import pytest
from pyspark.sql import functions as F

from corvane.functions import cells, dates, documents, keys, paths, responses, status, text

D = dt.date


def run(spark, rows, schema, *columns):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [tuple(r)[0] if len(columns) == 1 else tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def test_dates(spark):
    good = ["20260701", "2026.07.01", "2026-07-01", " 2026/07/01\t"]
    bad = ["99991231", "현재", "-", "", None, "20261301", "2026071", "99990101"]
    assert run(spark, [(x,) for x in good + bad], "v string", dates.parse_date(F.col("v"))) == [D(2026, 7, 1)] * 4 + [None] * 8
    assert run(spark, [("-",), (None,), ("현재",), ("2026",)], "v string", dates.is_open_ended(F.col("v"))) == [True, True, True, False]
    period = run(spark, [("2026.04.01 ~ 2026.06.30",), ("2026-01-01 ~ 현재",), ("2026.04.01 -",), ("판매기간",), ("20260701 ~ 99991231",), (None,)], "v string", dates.parse_period(F.col("v")))
    assert [tuple(p) for p in period] == [(D(2026, 4, 1), D(2026, 6, 30)), (D(2026, 1, 1), None), (D(2026, 4, 1), None), (None, None), (D(2026, 7, 1), None), (None, None)]


def test_periods(spark):
    rows = [("2026-07-15", None), ("2026-01-01", None), ("2026-01-01", "2026-07-01"), ("2026-07-31", "2026-12-31"), ("2026-01-01", "2026-06-30"), ("2026-08-01", None), (None, "2026-07-10"), (None, "2026-06-01")]
    got = run(spark, rows, "s string, e string", dates.overlaps(F.to_date("s"), F.to_date("e"), F.lit("2026-07-01").cast("date"), F.lit("2026-07-31").cast("date")))
    assert got == [True] * 4 + [False, False, True, False]
    assert dates.month_range("2024-02") == (D(2024, 2, 1), D(2024, 2, 29)) and dates.month_range("2026-12")[1] == D(2026, 12, 31)
    for wrong in ("2026-7", "", "2026-13", None):
        with pytest.raises(ValueError):
            dates.month_range(wrong)
    with pytest.raises(ValueError):
        dates.date_range("2026-02-01", "2026-01-01")
    assert [tuple(b) for b in run(spark, [("2026-02",)], "m string", dates.month_bounds(F.col("m")))] == [(D(2026, 2, 1), D(2026, 2, 28))]
    assert run(spark, [("2026-07-01", "2026-07-31")], "s string, e string", dates.period_scope(F.to_date("s"), F.to_date("e"))) == ["20260701_20260731"]


def test_clocks(spark):
    got = run(spark, [("2026-07-01T09:00:00",), ("2026-07-01T09:00:00+09:00",), ("2026-07-01T09:00:00Z",), ("soon",), (None,)], "v string", dates.parse_timestamp(F.col("v")).cast("string"))
    assert got == ["2026-07-01 00:00:00", "2026-07-01 00:00:00", "2026-07-01 09:00:00", None, None]
    assert run(spark, [("2026-07-01 20:00:00",)], "v string", dates.previous_day(F.to_timestamp("v"))) == [D(2026, 7, 1)]


def test_states(spark):
    got = run(spark, [("판매중",), ("판매 중지",), (" ACTIVE​",), ("x",), (None,)], "v string", status.sale_state(F.col("v")))
    assert got == ["ACTIVE", "ENDED", "ACTIVE", "UNKNOWN", "UNKNOWN"]
    rows = [("x", "active", None), ("판매중", "판매종료", None), ("x", None, "2026-08-01"), ("x", None, "2026-07-01")]
    assert run(spark, rows, "r string, x string, e string", status.sale_state(F.col("r"), F.col("x"), F.to_date("e"), F.lit("2026-07-01").cast("date"))) == ["ACTIVE", "ENDED", "ACTIVE", "UNKNOWN"]
    rows = [("AVAILABLE", "DRY_RUN"), ("", "SUCCESS"), (None, "INVALID_FILE"), (None, "DRY_RUN"), (None, None), ("odd", "ACCESS_DENIED"), (None, "MANUAL_REVIEW_REQUIRED")]
    assert run(spark, rows, "v string, a string", status.file_state(F.col("v"), F.col("a"))) == ["AVAILABLE", "AVAILABLE", "INVALID", "PENDING", "PENDING", "UNAVAILABLE", "MANUAL_REVIEW"]
    rows = [("DUPLICATE_SKIPPED", None, ""), ("SUCCESS", None, None), ("SUCCESS", "p", None)]
    assert run(spark, rows, "a string, p string, s string", status.proven_file_state(F.col("a"), F.col("p"), F.col("s"))) == ["PENDING", "UNAVAILABLE", "AVAILABLE"]
    rows = [("AVAILABLE", "DRY_RUN"), ("available", "DUPLICATE_SKIPPED"), ("INVALID", "x"), ("PENDING", None), ("PENDING", "SUCCESS"), ("UNAVAILABLE", "ACCESS_DENIED")]
    assert run(spark, rows, "f string, a string", status.checkpoint_state(F.col("f"), F.col("a"))) == ["SUCCESS", "DUPLICATE_SKIPPED", "INVALID_FILE", "DOWNLOAD_FAILED", "DOWNLOAD_FAILED", "ACCESS_DENIED"]


def test_document_kinds(spark):
    rows = [("보통약관", ""), ("상품요약서(약관 포함)", ""), ("사업 방법서", ""), ("", "x_약관.pdf"), ("기타첨부자료", ""), (None, None)]
    assert run(spark, rows, "l string, f string", documents.classify(F.col("l"), F.col("f"))) == ["POLICY", "SUMMARY", "METHOD", "POLICY", "UNKNOWN_DOCUMENT_TYPE", "UNKNOWN_DOCUMENT_TYPE"]
    assert run(spark, [(x,) for x in documents.EXCLUDED] + [("약관",)], "l string", documents.is_excluded(F.col("l"))) == [True] * 10 + [False]
    assert run(spark, [("u", None), ("", "{}"), (None, '{"a":1}')], "u string, h string", documents.has_link(F.col("u"), F.col("h"))) == [True, False, True]


def test_storage_names(spark):
    rows = [("A _123123.pdf", "A_123123.pdf"), ("A B.pdf", "A_B.pdf"), ("A__B.pdf", "A__B.pdf"), ('say "hi"', "say__hi_"), ("CON", "CON_"), ("", "_"), (None, "_"), ("///", "___"), ("a\t\nb", "a_b"), ("a　b c​d", "a_b_c_d"), (" x. ", "x"), ("nul.txt", "nul.txt_"), ("x" * 130, None)]
    got = run(spark, [(a,) for a, _ in rows], "v string", text.storage_name(F.col("v")))
    assert got[:-1] == [b for _, b in rows[:-1]] and len(got[-1]) == 120 and got[-1][111] == "~"


def test_file_names(spark):
    rows = [("FILE.PDF",), ("noext",), ("archive.tar.gz",), (".pdf",), ("a.b c",)]
    assert [tuple(x) for x in run(spark, rows, "v string", text.split_extension(F.col("v")))] == [("FILE", ".pdf"), ("noext", ""), ("archive.tar", ".gz"), (".pdf", ""), ("a.b c", "")]
    assert run(spark, [(" PDF ",), ("../pdf",), (None,)], "v string", text.normalize_extension(F.col("v"))) == [".pdf", "", ""]
    rows = [("attachment; filename*=UTF-8''%EC%95%BD%EA%B4%80.pdf",), ('attachment; filename="a+b.pdf"',), ("attachment; filename=c.hwp;",), (None,)]
    assert run(spark, rows, "v string", text.filename_from_disposition(F.col("v"))) == ["약관.pdf", "a+b.pdf", "c.hwp", ""]
    rows = [("http://x/CG80.ec?fileNm=20260101_10101_1.pdf",), ("/a/b%20c.pdf?x=1",), ("/d.do?FilePath=In/약관.pdf",), ("",)]
    assert run(spark, rows, "v string", text.filename_from_url(F.col("v"))) == ["20260101_10101_1.pdf", "b c.pdf", "약관.pdf", ""]
    rows = [("/d.do?FilePath=In/a.pdf", None, None), ("/x.do", 'filename="z.HWP"', None), ("", None, "application/zip; x")]
    assert run(spark, rows, "u string, d string, c string", text.guess_extension(F.col("u"), F.col("d"), F.col("c"))) == [".pdf", ".hwp", ".zip"]


def test_links(spark):
    rows = [("http://h/a/list/", "file/3239/1", "http://h/a/list/file/3239/1"), ("http://h/a/b", "/c", "http://h/c"), ("x", "https://q/z", "https://q/z"), ("x", "javascript:f()", ""), ("x", "#", ""), ("x", None, ""), ("x", " MAILTO:a", "")]
    assert run(spark, [r[:2] for r in rows], "b string, h string", text.absolute_url(F.col("b"), F.col("h"))) == [r[2] for r in rows]
    rows = [("fn('/a,b/','c.pdf', 3)", ["/a,b/", "c.pdf", "3"]), ('x; fn(\'a\',"b(1)")', ["a", "b(1)"]), ("other(1)", []), (None, []), ("fn()", [])]
    assert run(spark, [r[:1] for r in rows], "s string", text.call_arguments(F.col("s"), "fn")) == [r[1] for r in rows]
    rows = [("http://h/p?a=1&token=2&b=#f", "http://h/p?a=1&b="), ("/p?a=1#f", "/p?a=1#f"), ("/p?sig=9", "/p"), ("POST|{?token=1}", "POST|{?token=1}"), (None, "")]
    assert run(spark, [r[:1] for r in rows], "u string", text.scrub_url(F.col("u"))) == [r[1] for r in rows]
    assert run(spark, [('{"b":{"Token":1,"u":"http://h/?auth=1&k=2"},"a":[1]}',), ("no",)], "j string", text.scrub_json(F.col("j"))) == ['{"a":[1],"b":{"u":"http://h/?k=2"}}', None]
    rows = [("L", "u", None, "f"), ("", "/p?token=1", None, ""), (None, None, '{"id":7,"session":"x"}', "f"), (None, "", None, " f  g ")]
    assert run(spark, rows, "x string, u string, h string, f string", text.source_locator(*map(F.col, "xuhf"))) == ["L", "/p", 'POST|{"id":7}', "f g"]
    assert run(spark, [("?token=1", None)], "u string, h string", text.source_locator(F.lit(None), F.col("u"), F.col("h"), F.lit(""))) == ["REDACTED_QUERY_LOCATOR"]
    assert run(spark, [("a\r\nb\n\n c",)], "v string", text.cell_lines(F.col("v"))) == [["a", "b", "c"]]
    assert run(spark, [("ⅣＡ　b",), ("ASCII",)], "v string", text.folded(F.col("v"))) == ["iva b", "ascii"]


def test_scrubbed_columns_and_json_agree(spark):
    rows = ["http://h/p?a=1&token=2&b=#f", "HTTP://H/p", "http://h/p?", "http://h/?q=%20a+b&%ED%95%9C=한", "//h/p?a=1", "//h/p?sig=1&a", "a b\t c?x=1#y", "http://h?access-key=1", "mailto:x?auth=1&b=2*~", "x://h/?&&a&=1", "?", "#f", "http://h/%zz?a=%zz", "post|x?token=1", "POST|x?token=1#z"]
    one = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, u string").select("i", text.scrub_url(F.col("u")).alias("a"), text.scrub_json(F.to_json(F.struct(F.array("u").alias("v")))).alias("b")).orderBy("i").collect()
    assert [r.a for r in one] == [json.loads(r.b)["v"][0] for r in one]
    assert [r.a for r in one][:7] == ["http://h/p?a=1&b=", "http://H/p", "http://h/p", "http://h/?q=+a+b&%ED%95%9C=%ED%95%9C", "//h/p?a=1", "//h/p?a=", "a b c?x=1#y"]


def test_keys(spark):
    version = keys.product_version_key(*map(F.col, "cpnstu"))
    rows = [("A", "1", " n  m ", "2026-01-01", "2026-01-01", "u"), ("A", "1", "n m", "2026-01-01", "2026-01-01", "u"), ("B", None, "", None, None, None)]
    a, b, c = run(spark, rows, "c string, p string, n string, s string, t string, u string", version)
    assert a == b != c and all(x.startswith("PROD_VER_") and len(x) == 19 for x in (a, c))
    assert keys.short_key("k", {"b": 1, "a": "é"}) == keys.short_key("k", {"a": "é", "b": 1})
    x, y = run(spark, [(a, "i"), (a, "j")], "v string, d string", keys.document_key(F.col("v"), F.col("d")))
    assert x != y and x.startswith("DOC_") and len(x) == 14
    with pytest.raises(Exception, match="not a version key"):
        run(spark, [("x", "i")], "v string, d string", keys.document_key(F.col("v"), F.col("d")))


def test_paths(spark):
    folder = paths.version_dir(F.lit("/r"), F.lit("Co A"), F.col("s"), F.to_date("t"), F.col("p"))
    got = run(spark, [("ACTIVE", "2026-07-01", "P x"), ("odd", None, ""), ("ENDED", "2026-07-01", "y" * 400)], "s string, t string, p string", folder)
    assert got[:2] == ["/r/Co_A/2026/07/판매중__20260701_P_x", "/r/Co_A/날짜미상/상태미상__날짜미상_상품"] and len(got[2]) <= 240
    assert run(spark, [("d", "POLICY", "PDF", ""), ("d", "?", "", "a.hwp")], "d string, k string, e string, o string", paths.target_path(*map(F.col, "dkeo"))) == ["d/약관.pdf", "d/미분류.hwp"]
    assert run(spark, [("a/판매중__x", "ENDED"), ("a/x", "ACTIVE"), ("", "ACTIVE")], "p string, s string", paths.with_state_prefix(F.col("p"), F.col("s"))) == ["a/판매완료__x", "a/판매중__x", ""]
    rows = [("a/판매중__x/f.pdf", "a/판매중__x", "a/판매완료__x"), ("q", "q", "z")]
    assert run(spark, rows, "p string, o string, n string", paths.moved_path(*map(F.col, "pon"))) == ["a/판매완료__x/f.pdf", "z"]


def test_responses(spark):
    rows = [
        (200, "application/pdf", ".pdf", b"%PDF-1.4", "", ""), (403, "", ".pdf", b"x", "ACCESS_DENIED", "HTTP 403"), (500, "", ".pdf", b"x", "INVALID_RESPONSE", "HTTP status"),
        (200, "", ".pdf", b"", "INVALID_FILE", "empty body"), (200, "", ".pdf", None, "INVALID_FILE", "empty body"), (200, "text/html", ".pdf", b"  <!DOCTYPE html><p>error", "INVALID_RESPONSE", "HTML page"),
        (200, "text/html", ".pdf", b"<html>Web Firewall", "ACCESS_DENIED", "firewall page"), (200, "text/html", ".pdf", "<html>접속 차단".encode() + "가".encode() * 100, "ACCESS_DENIED", "firewall page"), (200, "", ".pdf", b"%PDF-" + b"\xea\xb0" * 200, "", ""), (200, "", ".exe", b"MZ", "INVALID_FILE", "extension"), (200, "", ".pdf", b"NOTPDF", "INVALID_FILE", "signature"),
        (200, "text/x", "", b"data", "INVALID_RESPONSE", "content type"), (200, "application/zip; q", ".docx", b"PK\x03\x04", "", ""),
    ]
    got = run(spark, [r[:4] for r in rows], "c int, t string, e string, b binary", responses.check_response(F.col("c"), F.col("t"), F.col("e"), F.col("b")))
    assert [(g.status, g.reason) for g in got] == [r[4:] for r in rows] and [g.ok for g in got] == [r[4] == "" for r in rows]
    rows = [(b"%PDF-", 5, ".PDF"), (b"%PDF-", 6, ".pdf"), (b"", 0, ".pdf"), (None, 0, ".pdf"), (b"PK", 0, ".zip"), (b"zz", 0, ".txt")]
    assert [g.reason for g in run(spark, rows, "b binary, n long, e string", responses.check_stored(F.col("b"), F.col("n"), F.col("e")))] == ["", "size", "empty", "missing", "signature", ""]


def test_tables(spark):
    rows = [
        ([], "REJECTED", "EMPTY_TABLE"), ([["상 품 요 약 서"]], "REJECTED", "SINGLE_CELL_LAYOUT"), ([["구분", "가입조건", "비고"]], "REJECTED", "HEADER_ONLY"),
        ([["20년", "50,000,000", "100.0%"]], "FRAGMENT", "SINGLE_ROW_DATA_FRAGMENT"), ([["보험기간", "종신"]], "FRAGMENT", "SINGLE_ROW_DATA_FRAGMENT"), ([["종"], ["신"], ["연"], ["금"]], "FRAGMENT", "SPLIT_TEXT_FRAGMENT"),
        ([["기준나이"], ["45세 가입"]], "FRAGMENT", "ONE_COLUMN_FRAGMENT"), ([["항목", "값"], ["기본", "적용"]], "MEANINGFUL", "STRUCTURED_TEXT_TABLE"), ([["항목", "값"], ["1", "적용"]], "MEANINGFUL", "VALUE_TABLE"),
    ]
    got = run(spark, [(r[0],) for r in rows], "t array<array<string>>", cells.assess(F.col("t"), cells.metrics(F.col("t"))))
    assert [tuple(g) for g in got] == [r[1:] for r in rows]
    low = [[["구분", "항목", "비고"], ["가", "나", "다"]]]
    assert [tuple(g) for g in run(spark, [tuple(low)], "t array<array<string>>", cells.assess(F.col("t"), cells.metrics(F.col("t")), F.lit(820.0), F.lit(842.0)))] == [("FRAGMENT", "HEADER_FRAGMENT_NEAR_PAGE_END")]
    dirty = [["a ", None, ""], ["", "", ""], ["​b"], ["c\x01|\n", "", "d"]]
    assert run(spark, [(dirty,)], "t array<array<string>>", cells.clean_rows(F.col("t"))) == [[["a", ""], ["b", ""], ["c\x01|\n", "d"]]]
    assert run(spark, [([],)], "t array<array<string>>", cells.clean_rows(F.col("t"))) == [[]]
    assert [tuple(x) for x in run(spark, [(dirty,)], "t array<array<string>>", cells.control_report(cells.clean_rows(F.col("t"))))[0]] == [(3, 1, 1)]
    assert run(spark, [([["h", "i"], ["a|b", "c\nd"]],)], "t array<array<string>>", cells.markdown(F.col("t"))) == ["| h | i |\n| --- | --- |\n| a\\|b | c d |"]
    a, b = run(spark, [([["x", "Y 1"]],), ([["x"], ["y1"]],)], "t array<array<string>>", cells.shape_fingerprint(F.col("t")), cells.text_fingerprint(F.col("t")))
    assert a[0] != b[0] and a[1] == b[1] == "xy1"
    parts = [(2.0, 0.0, "TEXT", "b"), (1.0, 0.0, "TEXT", "a"), (3.0, 0.0, "TABLE", "t"), (4.0, 0.0, "TEXT", " "), (5.0, 0.0, "TEXT", "c")]
    assert run(spark, [(parts,)], "p array<struct<y:double,x:double,kind:string,content:string>>", cells.page_markdown(F.col("p"))) == ["a\nb\n\nt\n\nc"]
