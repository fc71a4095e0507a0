import json

import pytest

from corvane.sources import journals as j
from corvane.sources import payloads as p

SCHEMA = "schema_version int, plan_key string, n int"


def write(path, *parts):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"".join(x if isinstance(x, bytes) else (json.dumps(x) + "\n").encode() for x in parts))


def row(i, version=1):
    return {"schema_version": version, "plan_key": f"k{i}", "n": i}


@pytest.mark.parametrize("block", ["128m", "60b"])
def test_journals(spark, tmp_path, block):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        write(tmp_path / "good.jsonl", *[row(i) for i in range(20)], b'{"schema_version":1,"pl')
        rows, errors = j.read_journal(spark, str(tmp_path / "good.jsonl"), SCHEMA, 1)
        assert [r.n for r in rows.orderBy("ingest_seq").collect()] == list(range(20)) and errors.isEmpty()
        write(tmp_path / "ended.jsonl", row(1), b'{"schema_version":1,"pl\n', b"\n", row(2))
        rows, errors = j.read_journal(spark, str(tmp_path / "ended.jsonl"), SCHEMA, 1)
        assert rows.count() == 2 and errors.count() == 1
        write(tmp_path / "version.jsonl", row(1), row(2, 2), b"[1]\n")
        rows, errors = j.read_journal(spark, str(tmp_path / "version.jsonl"), SCHEMA, 1)
        assert rows.count() == 1 and errors.count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_outbox_and_runs(spark, tmp_path):
    doc, ver = "DOC_0123456789", "PROD_VER_0123456789"
    e = lambda i, op, payload: json.dumps({"event_id": i, "created_at": "2026-07-01T00:00:00Z", "event": {"operation": op, "payload": payload}})
    lines = [e("a", "upsert_seen", {"document_key": doc, "product_version_key": ver}), e("b", "drop", {}), e("c", "upsert_result", {"document_key": "x", "product_version_key": ver}), e("d", "update_status_rows", {"rows": [{"document_key": doc}]}), "{"]
    good, bad = j.parse_events(spark.createDataFrame(list(enumerate(lines)), "ingest_seq long, value string"))
    assert sorted(r.event_id for r in good.collect()) == ["a", "d"] and sorted(r.ingest_seq for r in bad.collect()) == [1, 2, 4]
    base = {"layout_version": 3, "finished_at": "x", "run_status": "SUCCESS", "total_records": 1}
    for day, run, extra in (("2026/07/01", "r1", {}), ("2026/07/02", "r2", {}), ("2026/07/03", "r3", {"finished_at": " "}), ("2026/07/04", "r4", {"layout_version": 2}), ("2026/07/05", "r5", {"run_id": "other"}), ("2026/07/06", "r6", {"run_status": "RUNNING"})):
        write(tmp_path / day / run / "summary.json", json.dumps({"run_id": run, **base, **extra}, indent=1).encode())
    write(tmp_path / "2026/07/07/r7/summary.json", b'{"run_id": "r7"')
    runs = j.completed_runs(spark, str(tmp_path))
    assert sorted((r.run_id, r.run_day) for r in runs.collect()) == [("r1", "2026-07-01"), ("r2", "2026-07-02")]
    assert j.latest_run(runs).first().run_id == "r2"


def test_payloads(spark):
    rows = [("A", "t", 1, '{"result":"S","data":{"list":[{"a":"1","b":"2"},{"a":"3"}]}}'), ("B", "t", 1, '{"result":"S","data":{"list":[]}}'), ("C", "t", 1, '{"result":"F","data":{"list":[]}}'), ("D", "t", 1, '{"result":"S","data":{}}'), ("E", "t", 1, "no")]
    good, bad = p.unwrap(spark.createDataFrame(rows, "company string, tab string, page int, body string"), "a string, b string")
    assert [(r.company, r.pos, r.item.a, r.item.b) for r in good.orderBy("pos").collect()] == [("A", 0, "1", "2"), ("A", 1, "3", None)]
    assert sorted(r.company for r in bad.collect()) == ["C", "D", "E"]
    inner, wrong = p.inner_json(spark.createDataFrame([(1, '{"cell0":"x","cell1":"y"}'), (2, '{"cell0":"x"}'), (3, "z")], "i int, jsonData string"), "jsonData", ["cell0", "cell1"])
    assert [r.cells["cell1"] for r in inner.collect()] == ["y"] and wrong.count() == 2
    xml = '<?xml version="1.0"?><n:r xmlns:n="u"><n:poplist id="7"><n:name>A &amp; B</n:name></n:poplist><poplist id="8"/></n:r>'
    assert [(r.ID, r.NAME) for r in p.xml_rows(spark.createDataFrame([("A", xml)], "company string, body string"), "id string, name string", "poplist").orderBy("pos").collect()] == [("7", "A & B"), ("8", None)]
    zipped = "<r><a>1</a><a>2</a><b>x</b><b/><a>3</a></r>"
    assert [(r.a, r.b) for r in p.xml_columns(spark.createDataFrame([("A", zipped)], "company string, body string"), ["a", "b"]).orderBy("pos").collect()] == [("1", "x"), ("2", ""), ("3", "")]


def test_html(spark):
    page = "<table><tr><th>구분<th>상품<th>일자</tr><tr><td rowspan=2>A</td><td>p1</td><td>1</td></tr><tr><td>p2<td>2</table><p><a href='x?a=1&b=2'>L <b>1</b></a><a href=\"javascript:f()\">q</a>"
    df = spark.createDataFrame([(1, "http://h/d/", page), (2, None, None)], "page_id long, url string, html string")
    assert [r.row for r in p.by_header(p.html_rows(df)).orderBy("row_no").collect()] == [{"구분": "A", "상품": "p1", "일자": "1"}, {"구분": None, "상품": "p2", "일자": "2"}]
    assert [(r.pos, r.url, r.label) for r in p.html_links(df).orderBy("pos").collect()] == [(0, "http://h/d/x?a=1&b=2", "L 1"), (1, "", "q")]
    rows = [("약관".encode("euc-kr"), "text/html; charset=EUC-KR"), ("약관".encode("cp949"), None), ("약관".encode(), "text/html; charset=nope"), (b"\xff\xfe\xff", None), (None, None)]
    got = p.decoded(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, body binary, content_type string")).orderBy("i").collect()
    assert [(r.text, r.charset, r.replaced) for r in got[:3]] == [("약관", "euc-kr", False), ("약관", "euc-kr", False), ("약관", "utf-8", False)] and got[3].replaced and got[4].text == ""


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2026-07", 1), ("b", "2026-08", 2)], "plan_key string, month string, n int")
    log, months, one = (str(tmp_path / x) for x in ("log", "months", "one"))
    j.append_log(rows, log, ["month"])
    j.append_log(rows.limit(1), log, ["month"])
    assert spark.read.json(log).count() == 3
    j.write_by_month(rows, months)
    assert sorted((r.plan_key, r.month) for r in spark.read.json(months).collect()) == [("a", "2026-07"), ("b", "2026-08")]
    j.write_summary(rows.limit(1), one)
    assert len(list((tmp_path / "one").glob("part-*.json"))) == 1
    j.write_records(str(tmp_path / "records"), pages=rows, tables=rows.limit(1))
    assert spark.read.json(str(tmp_path / "records/tables")).count() == 1
