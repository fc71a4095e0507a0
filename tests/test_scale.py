"""Numbers in groups of any size, names beside stored files, counts on the way, published summaries."""

import json
import random

from corvane.operators import ordering, pages, reports
from corvane.operators.numbering import dealt_by_range, numbered_at_scale
from corvane.sources import journals
from pyspark.sql import functions as F


def test_numbers_of_one_group_with_all_rows(spark, request):
    rows = spark.range(20_000).select(F.lit("one").alias("g"), (F.col("id") * 7919 % 20_011).alias("o")).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one task's work
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    assert dealt_by_range(rows, "g", ["o"]).select("_range").distinct().count() > 4
    got = [r.n for r in numbered_at_scale(rows, "g", ["o"]).select("n", "o").collect()]
    assert sorted(got) == list(range(1, 20_001))
    by_order = sorted(numbered_at_scale(rows, "g", ["o"]).select("o", "n").collect())
    assert [r.n for r in by_order] == list(range(1, 20_001))
    largest = max(len(p) for p in numbered_at_scale(rows, "g", ["o"]).select("n").rdd.glom().collect())
    assert largest < 20_000


def test_numbers_of_many_groups(spark):
    rnd = random.Random(2)
    data = [(rnd.choice(["a", "b", None, "c"]), i) for i in range(500)]
    rnd.shuffle(data)
    got = {(r.g, r.o): r.n for r in numbered_at_scale(spark.createDataFrame(data, "g string, o long"), "g", ["o"]).collect()}
    want = {}
    for g in ("a", "b", None, "c"):
        want |= {(g, o): n for n, o in enumerate(sorted(o for h, o in data if h == g), 1)}
    assert got == want
    assert numbered_at_scale(spark.createDataFrame([], "g string, o long"), "g", ["o"]).collect() == []


def test_image_occurrences_and_monthly_keys_are_the_arrays_as_rows(spark):
    rnd = random.Random(3)
    images = spark.createDataFrame([("d", f"i{i}", rnd.choice("hk"), rnd.randrange(4), 0.0, float(i), 1.0, 1.0) for i in range(60)], "doc_id string, image_id string, sha256 string, page_no int, x0 double, top double, x1 double, bottom double")
    rows = sorted((r.sha256, r.occurrence_no, r.occurrence_id, r.image_id) for r in pages.image_occurrences(images).collect())
    assert rows == sorted((r.sha256, n, o.image_id, r.image_id) for r in pages.unique_images(images).collect() for n, o in enumerate(r.occurrences, 1))
    plan = spark.createDataFrame([(f"2026-0{1 + i % 2}", i, f"k{i * 37 % 50}") for i in range(50)], "month string, ingest_seq long, plan_key string")
    rows = sorted((r.month, r.place, r.plan_key) for r in reports.monthly_keys(plan).collect())
    assert rows == sorted((r.month, n, k) for r in reports.monthly_index(plan).collect() for n, k in enumerate(r.plan_keys, 1))


def one_by_one(files, stored):
    """Files placed one after another beside what is there."""
    taken, out = dict(stored), {}
    for seq, path, digest in sorted(files):
        stem, dot, end = path.rpartition(".")
        names = [path] + [f"{stem}_{n}{dot}{end}" for n in range(2, 300)]
        same = [n for n in names if taken.get(n) == digest]
        if same:
            out[seq] = (same[0], "DUPLICATE_SKIPPED")
        else:
            free = next(n for n in names if n not in taken)
            taken[free] = digest
            out[seq] = (free, "SUCCESS")
    return out


def test_names_beside_stored_files(spark):
    rnd = random.Random(7)
    for turn in range(4):
        stored = {f"p/{rnd.choice('ab')}{rnd.choice(['', '_2', '_3', '_5', '_9', '_02'])}.pdf": f"s{rnd.randrange(6)}" for _ in range(turn * 4)}
        files = [(i, f"p/{rnd.choice('abc')}.pdf", f"s{rnd.randrange(12)}") for i in range(60)]
        df = spark.createDataFrame(files, "ingest_seq long, path string, digest string").repartition(3)
        there = spark.createDataFrame(list(stored.items()), "stored_path string, digest string")
        got = {r.ingest_seq: (r.stored_path, r.outcome) for r in ordering.names_beside_stored(df, "path", "digest", there).collect()}
        assert got == one_by_one(files, stored)
        if not stored:
            assert got == {r.ingest_seq: (r.stored_path, r.outcome) for r in ordering.collision_names(df, "path", "digest").collect()}


def test_counts_on_the_way_cost_no_scan(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 7, None if i % 3 else "x") for i in range(70)], "ingest_seq long, k long, d string")
    rows.write.parquet(str(tmp_path / "t"))
    kept, before, after = ordering.first_wins_counted(spark.read.parquet(str(tmp_path / "t")), ["k"], undated="d")
    assert kept.count() == 7
    kept, before, after = ordering.first_wins_counted(spark.read.parquet(str(tmp_path / "t")), ["k"], undated="d")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    got = kept.collect()
    assert (before.get["raw"], after.get["kept"], after.get["undated"]) == (70, 7, sum(r.d is None for r in got))


def test_published_summaries(spark, tmp_path):
    runs = spark.createDataFrame([("2026-07-01", "r 1=x", 3, "t", "SUCCESS", 4), ("2026-07-02", "r2", 3, "t", "FAILED", 0), ("2026-07-02", "r3", 3, None, "SUCCESS", 1)], "run_day string, run_id string, layout_version int, finished_at string, run_status string, total_records long")
    assert journals.publish_summaries(runs, str(tmp_path)) == 3
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith(".")) == ["2026/07/01/r 1=x/summary.json", "2026/07/02/r2/summary.json", "2026/07/02/r3/summary.json"]
    assert json.loads((tmp_path / "2026/07/02/r2/summary.json").read_text())["run_status"] == "FAILED"
    assert sorted((r.run_day, r.run_id) for r in journals.completed_runs(spark, str(tmp_path)).collect()) == [("2026-07-01", "r 1=x"), ("2026-07-02", "r2")]
    journals.publish_summaries(runs.where("run_id = 'r2'").withColumn("total_records", F.lit(9)), str(tmp_path))
    assert journals.completed_runs(spark, str(tmp_path)).where("run_id = 'r2'").first().total_records == 9


def test_first_of_a_key_takes_keys_and_order_along_once(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), (None, 3, "z"), (None, None, "w"), ("b", None, "v")], "k string, ingest_seq long, v string")
    got = {(r.k, r.ingest_seq, r.v) for r in ordering.first_wins(rows, ["k"]).collect()}
    assert got == {("a", 1, "y"), (None, 3, "z"), ("b", None, None)}
    assert {(r.k, r.v) for r in ordering.last_wins(rows, ["k"]).where("ingest_seq is not null").collect()} == {("a", "x"), (None, "z")}
    plan = ordering.first_wins(rows, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" not in plan


def test_collision_names_deal_rows_once(spark):
    rows = spark.createDataFrame([(i, f"p{i % 7}.pdf", f"d{i % 3}") for i in range(60)], "ingest_seq long, path string, digest string").localCheckpoint()
    plan = ordering.collision_names(rows, "path", "digest")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_characters_differ_without_a_join(spark):
    from corvane.operators import rebuilt

    pairs = spark.createDataFrame([(1, "aab한", "abc"), (2, None, "x"), (3, "", None), (4, "same", "emas")], "id long, l string, r string")
    d = rebuilt.character_difference(pairs, "id", "l", "r")
    assert {tuple(r) for r in d.collect()} == {(1, "a", 1, 0), (1, "한", 1, 0), (1, "c", 0, 1), (2, "x", 0, 1)}
    assert "Join" not in d._jdf.queryExecution().optimizedPlan().toString()


def test_pages_are_parsed_once_for_headers_and_rows(spark):
    from corvane.sources import payloads

    page = "<table><tr><th>a</th><th></th></tr><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table><table><tr><td>no head</td></tr></table>"
    told = payloads.by_header(payloads.html_rows(spark.createDataFrame([(1, page), (None, page)], "page_id long, html string")))
    assert sorted((r.page_id, r.row_no, sorted(r.row.items())) for r in told.collect()) == [(1, 1, [("a", "1"), ("column_2", "2")]), (1, 2, [("a", None), ("column_2", "3")])]
    assert told._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_payloads_are_decoded_few_at_a_time(spark):
    import pyarrow as pa
    from corvane.sources import payloads

    batch = pa.RecordBatch.from_pydict({"i": list(range(150))})
    parts = list(payloads._few(iter([batch])))
    assert [p.num_rows for p in parts] == [64, 64, 22] and [i for p in parts for i in p.column(0).to_pylist()] == list(range(150))


def test_each_text_of_a_period_is_parsed_once(spark):
    from corvane.plans.versions import periods_parsed

    plan = periods_parsed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 2


def test_costly_cells_of_sites_are_no_filters(spark):
    from corvane.plans.sites import site_versions

    plan = site_versions(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.splitlines() if " Filter " in line or "Join " in line]
    assert not any("map_contains_key" in line or "forall" in line for line in conditions)
