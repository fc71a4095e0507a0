"""Lines, repeated lines, page quality, tables, rebuilt tables."""

import random

from pyspark.sql import functions as F

from corvane.operators import pages as p
from corvane.operators import tables as t


def test_line_keys(spark):
    rows = ["상품 약관 1 / 10", "상품   약관 2/10", "Page 3", "- 12 -", "2026년 1월", "2026년 2월", None, "ＡＢ p. 4 of 9"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string").orderBy("i").select(p.line_key(F.col("x"))).collect()]
    assert got[0] == got[1] == "상품 약관 <page>" and got[2:4] == ["<page>"] * 2 and got[4] != got[5] and got[6] == "" and got[7] == "ab <page>"


def test_lines_against_the_rule(spark):
    rnd = random.Random(1)
    words = [("d", pg, f"w{i}", rnd.random() * 100, rnd.choice([10, 12, 14, 15.5, 30, 33]), 0.0, 0.0) for pg in (1, 2) for i in range(25)]
    words = [(d, pg, w, x, float(y), x + 5, y + 8.0) for d, pg, w, x, y, _, _ in words]
    want = {}
    for pg in (1, 2):
        lines = []
        for w in sorted((w for w in words if w[1] == pg), key=lambda w: (w[4], w[3])):
            if lines and abs(w[4] - lines[-1][0][4]) <= 3:
                lines[-1].append(w)
            else:
                lines.append([w])
        want[pg] = [" ".join(x[2] for x in sorted(line, key=lambda w: w[3])) for line in lines]
    df = spark.createDataFrame(words, "doc_id string, page_no int, text string, x0 double, top double, x1 double, bottom double")
    for parts in (1, 7):
        got = {}
        for r in p.words_to_lines(df.repartition(parts)).orderBy("page_no", "line_no").collect():
            got.setdefault(r.page_no, []).append(r.text)
        assert got == want


def test_repeated_headers(spark):
    lines = [("d", n, 1, f"상품 약관 {n} / 5", 0.0, 10.0, 9.0, 20.0) for n in (1, 2, 3, 4)] + [("d", n, 2, f"body {n}", 0.0, 400.0, 9.0, 410.0) for n in range(1, 6)] + [("s", n, 1, "same", 0.0, 5.0, 1.0, 9.0) for n in (1, 2)]
    df = spark.createDataFrame(lines, "doc_id string, page_no int, line_no int, text string, x0 double, top double, x1 double, bottom double")
    pages = spark.createDataFrame([("d", n, 600.0, 800.0) for n in range(1, 6)] + [("s", n, 600.0, 800.0) for n in (1, 2)], "doc_id string, page_no int, width double, height double")
    zoned = p.zoned(df, pages).withColumn("key", p.line_key(F.col("text")))
    counts = pages.groupBy("doc_id").agg(F.count("*").alias("pages"))
    rep = p.repeated_lines(zoned, counts)
    assert [tuple(r) for r in rep.collect()] == [("d", "HEADER", "상품 약관 <page>", 4, 4)]
    removed = p.removed_lines(zoned, rep)
    assert {r.doc_id: (r.crop_header, r.crop_footer) for r in p.crop_fractions(pages, removed).collect()} == {"d": (20.0 / 800, 1.0), "s": (0.0, 1.0)}
    bodies = {(r.doc_id, r.page_no): r.body for r in p.body_text(p.without_lines(df, removed)).collect()}
    assert bodies["d", 1] == "body 1" and bodies["s", 1] == "same" and len(bodies) == 7


def test_page_quality(spark):
    rows = [(10, 1.0, False, False, "OCR_REQUIRED"), (11, 1.0, False, False, "TEXT"), (0, 0.49, False, False, "EMPTY"), (0, None, True, False, "TEXT"), (500, 0.0, True, True, "OCR_REQUIRED"), (0, 0.9, True, False, "TEXT")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, c int, r double, t boolean, f boolean, want string")
    assert all(r.got == r.want for r in df.select("want", p.page_status(*map(F.col, "crtf")).alias("got")).collect())


TABLES = "doc_id string, page_no int, candidate_index int, bbox array<double>, rows array<array<string>>"


def test_table_verdicts(spark):
    big = [["항목", "값"], ["보험료", "10,000"], ["기간", "종신"]]
    rows = [
        ("d", 1, 0, [0.0, 0.0, 100.0, 100.0], big), ("d", 1, 1, [0.0, 0.0, 100.0, 99.0], big), ("d", 1, 2, [0.0, 200.0, 100.0, 300.0], big), ("d", 1, 3, [10.0, 10.0, 50.0, 50.0], [["보험료"], ["10,000"]]),
        ("d", 1, 4, [10.0, 10.0, 60.0, 60.0], [["보험료", "납입"], ["11,000", "월"]]), ("d", 1, 5, [20.0, 20.0, 30.0, 30.0], [["납입", "월"], ["가", "1"]]), ("d", 2, 0, [0.0, 0.0, 9.0, 9.0], [["x"]]),
    ]
    pages = spark.createDataFrame([("d", 1, 842.0), ("d", 2, 842.0)], "doc_id string, page_no int, height double")
    told = t.without_nested_texts(t.without_duplicates(t.assessed(spark.createDataFrame(rows, TABLES), pages)))
    got = {(r.page_no, r.candidate_index): (r.status, r.reason) for r in told.collect()}
    assert got == {
        (1, 0): ("MEANINGFUL", "VALUE_TABLE"), (1, 1): ("REJECTED", "DUPLICATE_TABLE"), (1, 2): ("MEANINGFUL", "VALUE_TABLE"), (1, 3): ("REJECTED", "NESTED_TEXT_DUPLICATE"),
        (1, 4): ("MEANINGFUL", "VALUE_TABLE"), (1, 5): ("MEANINGFUL", "VALUE_TABLE"), (2, 0): ("REJECTED", "SINGLE_CELL_LAYOUT"),
    }
    saved = {r.candidate_index: (r.table_id, r.contained_by, r.nested) for r in t.saved_tables(told).collect()}
    assert saved == {0: ("page_0001_table_001", None, True), 2: ("page_0001_table_002", None, False), 4: ("page_0001_table_003", "page_0001_table_001", True), 5: ("page_0001_table_004", "page_0001_table_003", True)}
    assert t.rejection_warnings(told).count() == 3


def test_a_rejected_table_rejects_none(spark):
    rows = [("d", 1, i, [0.0, 0.0, 100.0, h], [["a", "b"], ["c", "1"]]) for i, h in enumerate((100.0, 100.0, 100.0))] + [("d", 1, 3, [0.0, 500.0, 100.0, 600.0], [["a", "b"], ["c", "1"]])]
    pages = spark.createDataFrame([("d", 1, 842.0)], "doc_id string, page_no int, height double")
    got = {r.candidate_index: r.status for r in t.without_duplicates(t.assessed(spark.createDataFrame(rows, TABLES), pages)).collect()}
    assert got == {0: "MEANINGFUL", 1: "REJECTED", 2: "REJECTED", 3: "MEANINGFUL"}


SOURCE = "| 항목 | 값 |\n| --- | --- |\n| 보험료 | 10,000원 |\n| 보험 기간 | 10개월 |"


def test_rebuilt_tables(spark):
    table, prose = "MARKDOWN_TABLE", "STRUCTURED_MARKDOWN"
    rows = [
        (table, SOURCE, None), (table, SOURCE.replace("10,000원", "20,000원"), "NUMERIC_TOKEN_MISMATCH"), (table, SOURCE.replace("보험료", ""), "CONTENT_CHARACTER_MISMATCH"), (table, SOURCE.replace("10개월", "10년"), "CONTENT_CHARACTER_MISMATCH"),
        (table, SOURCE.replace("보험 기간", "기간 보험"), "CELL_CONTENT_MISMATCH"), (table, SOURCE.replace("10,000원", "X").replace("10개월", "10,000원").replace("X", "10개월"), "ROW_RELATION_MISMATCH"),
        (table, "| 항목 | 값 |\n| --- | --- |", "INVALID_MARKDOWN"), (table, "", "EMPTY_RESPONSE"), (table, f"```\n{SOURCE}\n```", "CODE_FENCE"), (table, f"text\n{SOURCE}", "INVALID_MARKDOWN"),
        (prose, "# 항목 값\n- 보험료: 10,000원\n- 보험 기간: 10개월", None), (prose, SOURCE, "INVALID_MARKDOWN"), (prose, "# 항목 값\n- 보험료\n- 10,000원\n- 보험 기간: 10개월", "ROW_RELATION_MISMATCH"),
    ]
    df = spark.createDataFrame([(f"t{i:02d}", 1, m, SOURCE, text) for i, (m, text, _) in enumerate(rows)], "table_id string, attempt_no int, mode string, source_markdown string, response_markdown string")
    assert [r.code for r in t.check_attempts(df).orderBy("table_id").collect()] == [r[2] for r in rows]
    assert t.row_cells("| a\\|b | c |") == [" a\\|b ", " c "]
    two = spark.createDataFrame([("x", 1, table, SOURCE, ""), ("x", 2, table, SOURCE, SOURCE + "\n"), ("y", 1, table, SOURCE, "no"), ("y", 2, table, SOURCE, ""), ("y", 3, table, SOURCE, SOURCE)], df.schema)
    got = {r.table_id: (r.selected_attempt, r.final_status, r.final_markdown) for r in t.selected_attempts(t.check_attempts(two)).collect()}
    assert got == {"x": (2, "SUCCEEDED", SOURCE + "\n"), "y": (None, "FALLBACK", SOURCE)}
    diff = {r.token: (r.missing, r.added) for r in t.character_difference(spark.createDataFrame([(1, "aab", "abbc")], "k int, l string, r string"), "k", "l", "r").collect()}
    assert diff == {"a": (1, 0), "b": (0, 1), "c": (0, 1)}
