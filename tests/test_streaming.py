import random

from corvane.operators import catalog as c
from corvane.streaming import events as s

from tests.test_catalog import as_dict, event, sequential, table


def dump(spark, rows, path):
    df = table(spark, [r | {"event_id": r.get("event_id", f"e{r['seq']}")} for r in rows], "seq long, event_id string, operation string, ")
    df.coalesce(1).write.mode("append").json(str(path))


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    rnd = random.Random(8)
    events = [event(rnd, i + 1, f"k{rnd.randrange(12)}") | {"document_url": "u", "original_filename": None, "source_metadata": {}} for i in range(90)]
    want = sequential([], events)
    for part in (events[:30], events[30:60]):
        dump(spark, part, tmp_path / "in")
    paths = [str(tmp_path / x) for x in ("in", "catalog", "checkpoint", "seen")]
    s.replay(spark, *paths, files=1).awaitTermination()
    assert as_dict(s.read_catalog(spark, paths[1])) == sequential([], events[:60])
    dump(spark, events[60:] + [events[5] | {"seq": 999, "sale_status": "again", "event_id": "e6"}], tmp_path / "in")
    s.replay(spark, *paths).awaitTermination()
    assert as_dict(s.read_catalog(spark, paths[1])) == want


def test_a_collision_stops_the_stream(spark, tmp_path):
    rnd = random.Random(9)
    one = event(rnd, 1, "k") | {"document_url": "u", "original_filename": None, "source_metadata": {}}
    dump(spark, [one], tmp_path / "in")
    paths = [str(tmp_path / x) for x in ("in", "catalog", "checkpoint", "seen")]
    s.replay(spark, *paths).awaitTermination()
    dump(spark, [one | {"seq": 2, "source_product_id": "other", "event_id": "x"}], tmp_path / "in")
    query = s.replay(spark, *paths)
    try:
        query.awaitTermination()
        raise AssertionError("it should have stopped")
    except Exception as e:  # noqa: BLE001
        assert "IdentityCollisionError" in str(e)
    assert s.read_catalog(spark, paths[1]).count() == 1


def test_absences(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(f"k{k}", run, rnd.random() < 0.4, rnd.random() < 0.8) for k in range(8) for run in range(12)]
    want = []
    for k in range(8):
        n = 0
        for key, run, found, complete in rows:
            if key == f"k{k}":
                n = 0 if found else n + complete
                if n == 2 and complete and not found:
                    want.append((key, run, 2))
    schema = "key string, run long, found boolean, complete boolean"
    df = spark.createDataFrame(rows, schema)
    assert sorted(tuple(r) for r in s.absences(df).collect()) == sorted(want)
    for lo, hi in ((0, 5), (5, 12)):
        df.where(f"run >= {lo} and run < {hi}").coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = s.absence_streaks(stream).writeStream.format("memory").queryName("absent").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("absent").collect()) == sorted(want)


def test_outbox_jobs(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x] or [], "event_id string")
    kept, counts = s.compact(ids("a", "b", "c"), ids("b", "b"))
    assert sorted(r.event_id for r in kept.collect()) == ["a", "c"] and tuple(counts.first()) == (3, 1, 2)
    asked = spark.createDataFrame([("a", "r"), ("b", "r"), ("z", "r")], "event_id string, reason string")
    assert [r.event_id for r in s.quarantine(asked, ids("a", "b", "c"), ids("b"), ids()).collect()] == ["a"]
    kinds = spark.createDataFrame([("transient",), ("permanent",), (None,), ("transient",)], "failure_kind string")
    assert {r.failure_kind: r.failures for r in s.failures_by_kind(kinds).collect()} == {"transient": 2, "permanent": 1, "unclassified": 1}
    assert c.COLUMNS[0] == "document_key"
