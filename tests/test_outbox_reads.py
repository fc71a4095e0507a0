"""A batch of the outbox is read once, whatever is asked of it."""

import json

from corvane.streaming import outbox


def test_a_batch_is_read_once(spark, tmp_path):
    payload = json.dumps({"document_key": "DOC_0000000001", "product_version_key": "PROD_VER_0000000000"})
    lines = [json.dumps({"seq": n, "event_id": f"e{n}", "event": {"operation": "upsert_seen", "payload": payload}}) for n in range(1, 31)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    source = spark.createDataFrame([(x,) for x in [*lines, *lines[:5]]], "value string").mapInArrow(counted, "value string")
    outbox.apply_outbox(source, str(tmp_path), buckets=2)
    assert read.value == 35
    assert outbox.id_table(spark, str(tmp_path)).read().count() == 30
    assert [r.document_key for r in outbox.catalog_table(spark, str(tmp_path)).read().collect()] == ["DOC_0000000001"]
