"""Bucketed tables, the outbox replayed into them, and streaks as state."""

import json
import os
import random

import pytest

from corvane.operators import catalog as c
from corvane.streaming import events, outbox, streaks
from corvane.streaming.store import BucketedTable, Staging, exists
from pyspark.sql import functions as F

from tests.test_catalog import as_dict, event, sequential, table


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("part-*")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path), "k string, v long", "k", buckets=16)
    t.overwrite(spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")))
    before = files(tmp_path)
    one = t.touched(spark.createDataFrame([("k7",)], "k string"))
    assert len(one) == 1 and t.read(one).count() < 60
    t.overwrite(t.read(one).withColumn("v", F.when(F.col("k") == "k7", -1).otherwise(F.col("v"))))
    after = files(tmp_path)
    mine = {f for f in before if f"/bucket={one[0]}/" in f}
    assert {f: m for f, m in before.items() if f not in mine} == {f: m for f, m in after.items() if f"/bucket={one[0]}/" not in f} and not mine & set(after)
    assert t.read().count() == 500 and t.lookup("k7").first().v == -1 and t.lookup("k8").first().v == 8 and not t.lookup("none").count()
    assert BucketedTable(spark, str(tmp_path), "k string, v long", "k", buckets=5).buckets == 16


def metrics(df):
    """Sums of the scans' metrics after the query ran."""
    df.collect()
    plan, out, stack = df._jdf.queryExecution().executedPlan(), {}, []
    stack.append(plan)
    while stack:
        node = stack.pop()
        for name in ("finalPhysicalPlan",):
            if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
                stack.append(getattr(node, name)())
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            for m in ("numFiles", "numOutputRows"):
                out[m] = out.get(m, 0) + node.metrics().apply(m).value()
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return out


def test_a_lookup_reads_one_row_group_of_one_file(spark, tmp_path):
    t = BucketedTable(spark, str(tmp_path), "k string, v string", "k", buckets=4, group_bytes=64 * 1024)
    t.overwrite(spark.range(40_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").cast("string").alias("v")).repartition(3))
    key = spark.range(1).select(F.sha2(F.lit("77"), 256)).first()[0]
    assert t.lookup(key).collect()[0].v == "77"
    whole, one = metrics(t.read()), metrics(t.lookup(key))
    assert whole["numFiles"] == 4 and whole["numOutputRows"] == 40_000
    assert one["numFiles"] == 1 and one["numOutputRows"] < 40_000 / 4 / 3
    import pyarrow.parquet as pq

    held = [pq.ParquetFile(p).metadata for p in tmp_path.rglob("part-*")]
    assert all(m.num_row_groups > 3 for m in held)


def line(e, seq, **more):
    """An event of the catalog's tests as a line of an outbox."""
    e = dict(e) | {"document_url": "u", "original_filename": None, "source_metadata": {}}
    payload = {k: (v if v is None or isinstance(v, (int, str, dict)) else v.isoformat()) for k, v in e.items() if k in c.COLUMNS}
    payload |= {"document_key": f"DOC_{e['document_key']:>010}", "product_version_key": "PROD_VER_0000000000"}
    return json.dumps({"seq": seq, "event_id": f"e{seq}", "created_at": "2026-07-01T00:00:00", "event": {"operation": e["operation"], "payload": json.dumps(payload)}} | more)


def write(path, lines, name):
    """A file that is a second younger than those before it: the stream takes files by age."""
    path.mkdir(exist_ok=True)
    age = len(list(path.iterdir()))
    (path / name).write_text("".join(x + "\n" for x in lines))
    os.utime(path / name, (1_700_000_000 + age, 1_700_000_000 + age))


def drawn(n, keys=12, seed=8):
    rnd = random.Random(seed)
    return [event(rnd, i + 1, f"k{rnd.randrange(keys)}") for i in range(n)]


def wanted(rows):
    full = [r | {"document_url": "u", "original_filename": None, "source_metadata": {}, "document_key": f"DOC_{r['document_key']:>010}", "product_version_key": "PROD_VER_0000000000"} for r in rows]
    return sequential([], full)


def test_replay_stops_at_the_first_bad_event_and_resumes(spark, tmp_path):
    es = drawn(60)
    lines = [line(e, e["seq"]) for e in es]
    lines[29] = json.dumps({"seq": 30, "event_id": "e30", "event": {"operation": "drop_all", "payload": "{}"}})
    write(tmp_path / "in", lines[:40], "a")
    write(tmp_path / "in", lines[40:], "b")
    args = [str(tmp_path / x) for x in ("in", "out", "checkpoint")]
    aside = tmp_path / "aside"
    write(aside, [], "q.json")
    with pytest.raises(Exception, match="event 30 is bad"):
        outbox.replay_outbox(spark, *args, quarantined=str(aside), files=1, buckets=4).awaitTermination()
    known = outbox.id_table(spark, args[1]).read()
    assert sorted(int(r.event_id[1:]) for r in known.collect()) == list(range(1, 30))
    assert as_dict(outbox.catalog_table(spark, args[1]).read()) == wanted(es[:29])
    with pytest.raises(Exception, match="event 30 is bad"):
        outbox.replay_outbox(spark, *args, quarantined=str(aside), files=1).awaitTermination()
    write(aside, ['{"event_id": "e30"}'], "r.json")
    outbox.replay_outbox(spark, *args, quarantined=str(aside), files=1).awaitTermination()
    assert as_dict(outbox.catalog_table(spark, args[1]).read()) == wanted(es[:29] + es[30:])
    assert outbox.id_table(spark, args[1]).read().count() == 59


def test_a_crash_between_writing_and_publishing_is_repeatable(spark, tmp_path, monkeypatch):
    es = drawn(40, seed=3)
    text = lambda rows: spark.createDataFrame([(line(e, e["seq"]),) for e in rows], "value string")
    out = str(tmp_path / "out")
    outbox.apply_outbox(text(es[:20]), out, buckets=4)
    for step in ("overwrite", "append"):
        with monkeypatch.context() as m:
            m.setattr(BucketedTable, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                outbox.apply_outbox(text(es[20:30] if step == "overwrite" else es[30:]), out)
        assert Staging(spark, out).ready()
        outbox.apply_outbox(text(es[20:30] if step == "overwrite" else es[30:]), out)
        assert not exists(spark, f"{out}/staged")
    assert as_dict(outbox.catalog_table(spark, out).read()) == wanted(es)


def test_status_updates_between_upserts(spark, tmp_path):
    one = drawn(1)[0] | {"status_checked_at": None}
    update = {"document_key": f"DOC_{one['document_key']:>010}", "sale_status": "ENDED", "status_checked_at": "2026-09-01T00:00:00", "status_missing_count": 2, "last_status_run_id": "run"}
    unknown = update | {"document_key": "DOC_0000000zzz"}
    lines = [
        json.dumps({"seq": 1, "event_id": "u0", "event": {"operation": "update_status_rows", "payload": json.dumps({"rows": [update]})}}),
        line(one, 2),
        json.dumps({"seq": 3, "event_id": "u1", "event": {"operation": "update_status_rows", "payload": json.dumps({"rows": [update, unknown]})}}),
        line(one | {"seq": 4, "sale_status": "ACTIVE"}, 4),
    ]
    outbox.apply_outbox(spark.createDataFrame([(x,) for x in lines], "value string"), str(tmp_path), buckets=2)
    rows = outbox.catalog_table(spark, str(tmp_path)).read().collect()
    assert len(rows) == 1 and rows[0].sale_status == "ENDED" and rows[0].status_missing_count == 2 and rows[0].last_status_run_id is not None
    assert outbox.id_table(spark, str(tmp_path)).read().count() == 4


def test_ids_of_fifty_batches(spark, tmp_path):
    ids = BucketedTable(spark, str(tmp_path), outbox.IDS, "event_id", buckets=8)
    rnd = random.Random(1)
    seen = set()
    for batch in range(50):
        new = {f"e{rnd.randrange(400)}" for _ in range(6)}
        df = spark.createDataFrame([(i,) for i in sorted(new)], outbox.IDS).coalesce(1)
        assert {r[0] for r in ids.matching(df).collect()} == new & seen
        ids.append(df.join(ids.matching(df), "event_id", "left_anti"))
        seen |= new
    assert {r[0] for r in ids.read().collect()} == seen
    scan = metrics(ids.lookup("e1"))
    assert scan["numFiles"] <= ids.files()[ids.touched(spark.createDataFrame([("e1",)], outbox.IDS))[0]]
    crowded = ids.tidy(10)
    assert crowded and all(n == 1 for b, n in ids.files().items() if b in crowded) and {r[0] for r in ids.read().collect()} == seen


def test_streaks_as_state(spark, tmp_path):
    pytest.importorskip("google.protobuf")
    rnd = random.Random(4)
    schema = "key string, run long, found boolean, complete boolean"
    rows = [(f"k{k}", run, rnd.random() < 0.4, rnd.random() < 0.8) for k in range(8) for run in range(12)]
    df = spark.createDataFrame(rows, schema)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    streaks.use_disk_state(spark)
    try:
        known = spark.createDataFrame([("k0", 1, -1), ("k9", 5, 3)], "key string, missing int, run long")
        for part, (lo, hi) in enumerate(((0, 4), (4, 9), (9, 12))):
            df.where(f"run >= {lo} and run < {hi}").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
            if part == 1:
                df.where("run < 2").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
            q = streaks.streaks(stream, known).writeStream.format("json").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    got = sorted(tuple(r) for r in spark.read.schema(streaks.FIRED).json(str(tmp_path / "out")).collect())
    seeded = df.union(spark.createDataFrame([("k0", -1, False, True)], schema))
    assert got == sorted(tuple(r) for r in events.absences(seeded).collect())


