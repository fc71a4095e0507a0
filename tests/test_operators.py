"""Operators on small cases: ordering, joins, selection, reconciliation, reports; results don't depend on partitions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corvane.operators import joins, ordering, pages, reconcile, reports, selection


def df(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_first_last_latest(spark, parts):
    log = df(spark, [(1, "a", "x", 5), (2, "a", "y", 9), (3, "b", "z", None), (4, None, "n", 1), (5, "a", "w", 9), (6, None, "m", 2)], "ingest_seq long, k string, v string, clock int", parts)
    pick = lambda d: {r.k: r.v for r in d.collect()}
    assert pick(ordering.first_wins(log, ["k"])) == {"a": "x", "b": "z", None: "n"}
    assert pick(ordering.last_wins(log, ["k"])) == {"a": "w", "b": "z", None: "m"}
    assert pick(ordering.latest_by_clock(log, ["k"], "clock")) == {"a": "w", "b": "z", None: "m"}
    assert pick(ordering.longest(log.withColumn("v", F.concat("v", F.when(F.col("ingest_seq") == 2, "long").otherwise(""))), ["k"], "v")) == {"a": "ylong", "b": "z", None: "n"}
    down = ordering.carried_down(log.withColumn("g", F.lit(1)), ["g"], "ingest_seq", F.col("v").isin("x", "z"), F.col("v"), "h")
    assert [r.h for r in down.orderBy("ingest_seq").collect()] == ["x", "x", "z", "z", "z", "z"]


def test_collisions_and_numbers(spark):
    files = df(spark, [(1, "p.pdf", "s1"), (2, "p.pdf", "s2"), (3, "p.pdf", "s1"), (4, "q", "s1"), (5, "q", "s3")], "ingest_seq long, path string, sha string")
    got = {r.ingest_seq: (r.stored_path, r.outcome) for r in ordering.collision_names(files, "path", "sha").collect()}
    assert got == {1: ("p.pdf", "SUCCESS"), 2: ("p_2.pdf", "SUCCESS"), 3: ("p.pdf", "DUPLICATE_SKIPPED"), 4: ("q", "SUCCESS"), 5: ("q_2", "SUCCESS")}
    n = ordering.numbered(files, ["path"], [F.col("ingest_seq").desc()])
    assert {r.ingest_seq: r.n for r in n.collect()} == {3: 1, 2: 2, 1: 3, 5: 1, 4: 2}
    kept = ordering.capped(files, ["path"], 2, [F.col("ingest_seq")])
    assert rows(kept.select("ingest_seq", "group_rows", "coverage_capped")) == [(1, 3, True), (2, 3, True), (4, 2, False), (5, 2, False)]


def test_lookups_and_details(spark):
    r = df(spark, [("a",), ("b",), ("z",)], "code string")
    names = df(spark, [(2, "a", "late"), (1, "a", "early"), (3, "b", "B")], "ingest_seq long, code string, name string")
    assert rows(joins.lookup(r, names, "code", "name")) == [("a", "early"), ("b", "B"), ("z", None)]
    lists = df(spark, [(1, ["x", "y"], ["f"]), (2, [], ["g"])], "i int, l array<string>, f array<string>")
    assert rows(joins.zipped(lists, "l", "f").select("i", "pos", "l", "f")) == [(1, 0, "x", "f"), (1, 1, "y", ""), (2, 0, "", "g")]
    d = dt.date
    v = df(spark, [("p", d(2026, 1, 1)), ("q", d(2026, 2, 1)), ("r", None)], "id string, sale_start_date date")
    det = df(spark, [("p", 0, d(2025, 1, 1), "old"), ("p", 1, d(2026, 1, 1), "hit"), ("q", 1, d(2025, 1, 1), "second"), ("q", 0, d(2024, 1, 1), "first")], "id string, pos int, sale_start_date date, doc string")
    assert rows(joins.best_detail(v, det, "id").select("id", "doc")) == [("p", "hit"), ("q", "first"), ("r", None)]
    assert rows(joins.drill_down(v.select("id"), det.select("id", "doc"), ["id"])) == [("p", "hit"), ("p", "old"), ("q", "first"), ("q", "second")]
    done = df(spark, [("p", "completed"), ("q", "failed"), ("r", "completed")], "id string, status string")
    assert rows(joins.unfinished(v, done, df(spark, [("r",)], "id string"), "id").select("id")) == [("q",), ("r",)]


def test_redirects_need_one_match(spark):
    schema = "document_key string, checkpoint_key string, company string, document_url string, document_label string, original_filename string"
    known = df(spark, [("K1", "", "a", "u1", "L", ""), ("K2", "plan", "a", "u2", "L", ""), ("K3", None, "b", "u3", "", ""), ("K4", "", "b", "u4", None, "f"), ("K5", "", "c", "same", "", "")], schema)
    asked = df(spark, [(1, "a", "new", "L", None), (2, "a", "new", "M", None), (3, "b", "new", "", ""), (4, "b", "new", "", "g"), (5, "c", "same", "", "")], "record_id int, company string, document_url string, document_label string, original_filename string")
    assert {r.record_id: r.known_key for r in joins.redirected(asked, known, ["company"]).collect()} == {1: "K1", 4: "K3"}


def test_selection(spark):
    log = df(spark, [("s", 1, "v1"), ("s", 2, "v1"), ("t", 1, "v1"), ("s", 1, "v2")], "scope string, schema_version int, adapter_version string")
    assert selection.in_scope(log, "s", 1, "v1").count() == 1
    images = df(spark, [(64, 64, 0.005), (63, 999, 0.5), (999, 999, 0.004)], "pixel_width int, pixel_height int, area_ratio double")
    assert selection.usable_images(images).count() == 1
    with pytest.raises(ValueError, match="unknown mode"):
        selection.select_versions(log, dt.date(2026, 1, 1), dt.date(2026, 1, 2), "other")
    d = dt.date
    v = df(spark, [(1, None, None, None), (2, None, None, d(2014, 12, 31)), (3, None, None, d(2026, 7, 1)), (4, d(2026, 7, 9), d(2026, 7, 9), None), (5, d(2026, 1, 1), d(2026, 1, 1), None)], "i int, target_date date, sale_start_date date, sale_end_date date")
    pick = lambda mode: [r[0] for r in rows(selection.select_versions(v, d(2026, 7, 1), d(2026, 7, 31), mode).select("i"))]
    assert pick("new_or_revised") == [1, 3, 4] and pick("overlap") == [1, 3, 4, 5]


ROWS = "key string, ingest_seq long, company_code string, state string, status_missing_count int, saved_relative_path string, saved_filename string"


def test_reconciliation(spark):
    base = [
        ("two", 1, "A", "ACTIVE", 0, "r/판매중__two/a.pdf", "a.pdf"), ("two", 2, "A", "ACTIVE", 0, "r/판매중__two/b.pdf", "b.pdf"), ("once", 3, "A", "ACTIVE", 0, "", ""), ("twice", 4, "A", "ACTIVE", 1, "r/판매중__twice/a.pdf", ""),
        ("partial", 5, "B", "ACTIVE", 1, "", ""), ("back", 6, "A", "UNKNOWN", 2, "", ""), ("odd", 7, "A", "ACTIVE", 0, "", ""), ("gone", 8, "A", "ENDED", 0, "", ""),
    ]
    r = df(spark, base, ROWS)
    matches = df(spark, [("two", "ENDED", "판매중지", None, 1), ("two", "ENDED", "판매종료", dt.date(2026, 7, 1), 2), ("back", "ACTIVE", "판매중", None, 3), ("odd", "ACTIVE", "x", None, 4), ("odd", "ENDED", "y", None, 5)], "key string, state string, raw_status string, sale_end_date date, seq long")
    decided = reconcile.decisions(r, reconcile.observations(matches), df(spark, [("A", True), ("B", False)], "company_code string, complete boolean"))
    got = {x.key: (x.new_state, x.missing_count, x.outcome) for x in decided.collect()}
    assert got == {"two": ("ENDED", 0, "decided"), "once": ("ACTIVE", 1, "decided"), "twice": ("UNKNOWN", 2, "decided"), "partial": ("ACTIVE", 1, "unchanged"), "back": ("ACTIVE", 0, "decided"), "odd": ("ACTIVE", 0, "partial_or_failed"), "gone": ("ENDED", 0, "unchanged")}
    assert tuple(reconcile.stats(decided).first()) == (5, 2, 1, 1, 1, 1, 2)
    after = reconcile.updated_rows(r, decided)
    assert {x.ingest_seq: (x.state, x.saved_relative_path) for x in after.where("key in ('two', 'twice')").collect()} == {1: ("ENDED", "r/판매완료__two/a.pdf"), 2: ("ENDED", "r/판매완료__two/b.pdf"), 4: ("UNKNOWN", "r/상태미상__twice/a.pdf")}
    acts = {x.key: x.move_required for x in reconcile.actions(decided).collect()}
    assert acts == {"two": True, "once": False, "twice": True, "back": False}
    outcomes = df(spark, [("two", False, None, None), ("twice", True, "r/상태미상__twice_2", "r/상태미상__twice")], "key string, moved boolean, destination string, proposed string")
    done = {x.ingest_seq: (x.state, x.saved_relative_path) for x in reconcile.committed(r, after, outcomes).collect()}
    assert done[1] == ("ACTIVE", "r/판매중__two/a.pdf") and done[4] == ("UNKNOWN", "r/상태미상__twice_2/a.pdf") and done[3] == ("ACTIVE", "")
    with pytest.raises(ValueError):
        reconcile.decisions(r, reconcile.observations(matches), df(spark, [], "company_code string, complete boolean"), 1)


def test_open_moves(spark):
    j = [(f"m{i}", i, "PLANNED", f"s{i}", f"d{i}", f"k{i}", "ACTIVE", "ENDED") for i in range(5)] + [("m0", 9, "COMMITTED", "s0", "d0", "k0", "ACTIVE", "ENDED"), ("m1", 10, "MOVED", "s1", "d1", "k1", "ACTIVE", "ENDED")]
    journal = df(spark, j, "action_id string, ingest_seq long, phase string, source string, destination string, logical_key string, old_state string, new_state string")
    moves = reconcile.open_moves(journal, df(spark, [("d1",), ("s2",), ("s3",), ("d3",)], "path string"))
    assert {r.action_id: r.decision for r in moves.collect()} == {"m1": "MOVED", "m2": "REDO", "m3": "CONFLICT", "m4": "PENDING"}
    r = df(spark, [("k1", 1, "ACTIVE", "s1/f.pdf"), ("k9", 2, "ACTIVE", "z/f.pdf")], "key string, ingest_seq long, state string, saved_relative_path string")
    out, counts = reconcile.reapply_moves(r, moves)
    assert rows(out) == [("k1", 1, "ENDED", "d1/f.pdf"), ("k9", 2, "ACTIVE", "z/f.pdf")] and tuple(counts.first()) == (1, 1, 1, 1)


def test_reports(spark):
    p = df(spark, [("a", 1, "TEXT", 50, 9), ("a", 2, "OCR_REQUIRED", 0, 0), ("b", 1, "EMPTY", 0, 0), ("c", 1, "TEXT", 5, 1), ("d", 1, "TEXT", 5, 1)], "doc_id string, page_no int, page_status string, characters long, words long")
    counts = reports.page_counts(p)
    warn = df(spark, [("c", "CORE"), ("d", "OTHER")], "doc_id string, code string")
    states = reports.document_states(counts, warn, ("CORE",))
    assert rows(states) == [("a", "PARTIAL"), ("b", "OCR_REQUIRED"), ("c", "PARTIAL"), ("d", "SUCCEEDED")]
    assert reports.load_status(states).first().run_status == "PARTIAL"
    t = df(spark, [("a", "MEANINGFUL"), ("a", "REJECTED")], "doc_id string, status string")
    i = df(spark, [("a", "h"), ("a", "h"), ("b", "g")], "doc_id string, sha256 string")
    m = {r.doc_id: (r.pages, r.tables, r.rejected_tables, r.images, r.distinct_images, r.warnings) for r in reports.load_manifest(p, t, i, warn).collect()}
    assert m == {"a": (2, 2, 1, 2, 1, 0), "b": (1, 0, 0, 1, 1, 0), "c": (1, 0, 0, 0, 0, 1), "d": (1, 0, 0, 0, 0, 1)}
    e = df(spark, [("x", "upsert_seen", ["k" * 20] * 12)], "event_id string, operation string, keys array<string>")
    one = reports.event_previews(e).first()
    assert one.rows == 12 and len(one.first_keys) == 10 and set(one.first_keys) == {"k" * 12}
    f = df(spark, [("transient",), ("transient",)], "failure_kind string")
    assert rows(reports.outbox_summary(e, f)) == [("failure:transient", 2), ("pending", 1)]
    told = df(spark, [(True, "SUCCEEDED"), (True, "FALLBACK"), (False, None)], "requested boolean, final_status string")
    assert tuple(reports.reconstruction_counts(told).first()) == (3, 2, 1, 1, 1)


def test_images_and_words_outside_tables(spark):
    im = df(spark, [("d", "i2", "h", 2, 0.0, 5.0, 1.0, 6.0), ("d", "i1", "h", 1, 0.0, 9.0, 1.0, 10.0), ("d", "i3", "g", 1, 0.0, 0.0, 1.0, 1.0), ("e", "i4", "h", 1, 0.0, 0.0, 1.0, 1.0)], "doc_id string, image_id string, sha256 string, page_no int, x0 double, top double, x1 double, bottom double")
    assert {(r.doc_id, r.sha256): (r.image_id, r.occurrence_count, [o.page_no for o in r.occurrences]) for r in pages.unique_images(im).collect()} == {("d", "h"): ("i1", 2, [1, 2]), ("d", "g"): ("i3", 1, [1]), ("e", "h"): ("i4", 1, [1])}
    words = df(spark, [("d", 1, "in", 10.0, 10.0, 20.0, 20.0), ("d", 1, "out", 90.0, 10.0, 120.0, 20.0), ("d", 2, "other", 10.0, 10.0, 20.0, 20.0)], "doc_id string, page_no int, text string, x0 double, top double, x1 double, bottom double")
    box = df(spark, [("d", 1, [0.0, 0.0, 100.0, 100.0])], "doc_id string, page_no int, bbox array<double>")
    assert [r[0] for r in rows(pages.outside_tables(words, box).select("text"))] == ["other", "out"]
    pg = df(spark, [("d", 1, 100.0, 100.0, "x y", False), ("d", 2, 100.0, 100.0, "", False), ("d", 3, 0.0, 0.0, None, True)], "doc_id string, page_no int, width double, height double, text_raw string, extraction_failed boolean")
    body = df(spark, [("d", 1, "text of the page here")], "doc_id string, page_no int, body string")
    quality = {r.page_no: (r.words, r.images, round(r.largest_ratio, 4), r.page_status) for r in pages.page_quality(pg, body, im.where("doc_id = 'd'"), box.where("false")).collect()}
    assert quality == {1: (2, 2, 0.0001, "TEXT"), 2: (0, 1, 0.0001, "EMPTY"), 3: (0, 0, 0.0, "OCR_REQUIRED")}
