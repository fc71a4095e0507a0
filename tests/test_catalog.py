"""The window form against a sequential model of the same rules."""

import datetime as dt
import random

from corvane.operators import catalog as c

T0 = dt.datetime(2026, 7, 1)


def sequential(rows, events):
    """Events one after another, as a keyed store would apply them."""
    state = {r["document_key"]: dict(r) for r in rows}
    for e in events:
        new, key, result = dict(e), e["document_key"], e["operation"] == "upsert_result"
        if not result:
            new["last_attempt_at"] = None
        old = state.get(key)
        if old is None:
            state[key] = {k: v for k, v in new.items() if k not in ("seq", "operation")}
            continue
        newer = lambda k: old[k] is None or (new[k] is not None and new[k] >= old[k])  # noqa: E731, B023
        seen, tried = newer("last_seen_at"), result and newer("last_attempt_at")
        status = seen and newer("status_checked_at")
        out = dict(old)
        if seen:
            out.update({k: new[k] for k in c.SEEN})
            kept = {k: v for k, v in old["source_metadata"].items() if k in c.KEPT_METADATA}
            out["source_metadata"] = old["source_metadata"] | new["source_metadata"] | kept
            out["identity_version"] = new["identity_version"]
        if status:
            out.update({k: new[k] for k in c.STATUS})
            if result and new["last_status_run_id"] is not None:
                out["last_status_run_id"] = new["last_status_run_id"]
        if result and (tried or seen):
            out.update({k: new[k] for k in c.DOCUMENT if new[k] is not None})
            out["identity_version"] = new["identity_version"]
            if new["downloaded_at"] is not None and (old["downloaded_at"] is None or new["downloaded_at"] >= old["downloaded_at"]):
                out["downloaded_at"] = new["downloaded_at"]
        if tried:
            if not (new["last_attempt_status"] == "DRY_RUN" and old["file_status"] == "AVAILABLE"):
                out.update({k: new[k] for k in c.FILE})
            out.update({k: new[k] for k in c.ATTEMPT})
            if new["last_download_run_id"] is not None:
                out["last_download_run_id"] = new["last_download_run_id"]
        state[key] = out
    return state


def event(rnd, seq, key):
    clock = lambda: rnd.choice([None, *[T0 + dt.timedelta(hours=h) for h in range(4)]])
    word = lambda *x: rnd.choice([None, *x])
    e = {name: None for name in c.COLUMNS}
    e |= {"seq": seq, "operation": rnd.choice(["upsert_seen", "upsert_result", "upsert_result"]), "document_key": key, "company_code": "A", "product_version_key": "P", "identity_version": 4}
    e |= {"product_name": word("x", "y", "z"), "last_seen_run_id": f"s{seq}", "last_seen_at": clock(), "sale_status": word("ACTIVE", "ENDED"), "status_checked_at": clock(), "status_missing_count": seq}
    e |= {"document_label": word("l", "m"), "document_url": word("u"), "file_status": rnd.choice(["AVAILABLE", "PENDING", "INVALID"]), "sha256": word("a", "b"), "file_size": seq}
    e |= {"last_attempt_status": word("SUCCESS", "DRY_RUN", "DRY_RUN"), "error_message": word("e"), "last_attempt_at": clock(), "downloaded_at": clock(), "last_download_run_id": word(f"d{seq}"), "last_status_run_id": word(f"t{seq}")}
    if e["last_attempt_status"] == "DRY_RUN":
        e["file_status"] = "PENDING"
    e["source_metadata"] = {k: f"{k}{seq}" for k in ("migration", "final_url", "checkpoint_key", "other") if rnd.random() < 0.4}
    return e


def table(spark, rows, extra=""):
    schema = extra + c.SCHEMA
    names = [p.split()[0] for p in schema.split(", ")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def as_dict(df):
    return {r.document_key: r.asDict(recursive=True) for r in df.collect()}


def test_merge_is_the_sequential_rule_and_splits_do_not_matter(spark):
    rnd = random.Random(4)
    events = [event(rnd, i + 1, f"k{rnd.randrange(60)}") for i in range(700)]
    want = sequential([], events)
    empty = table(spark, [])
    whole = c.merge_events(empty, table(spark, events, "seq long, operation string, ").repartition(7))
    assert as_dict(whole) == want
    half = c.merge_events(empty, table(spark, events[:300], "seq long, operation string, "))
    half = spark.createDataFrame(half.collect(), c.SCHEMA)
    assert as_dict(c.merge_events(half, table(spark, events[300:], "seq long, operation string, "))) == want


def test_collisions(spark):
    rnd = random.Random(1)
    rows = [event(rnd, i, f"k{i % 3}") | {"document_url": "u", "source_metadata": {}} for i in range(1, 8)]
    rows[4]["source_product_id"] = "other"
    rows[5]["document_url"] = "v"
    got = {(r.document_key, r.seq) for r in c.identity_collisions(table(spark, []), table(spark, rows, "seq long, operation string, ")).collect()}
    assert got == {("k2", 5), ("k0", 6)}


def test_status_updates(spark):
    rnd = random.Random(2)
    base = [event(rnd, 0, k) | {"status_checked_at": t, "saved_relative_path": "p"} for k, t in (("a", T0), ("b", None), ("c", T0))]
    h = lambda n: T0 + dt.timedelta(hours=n)
    ups = [("a", h(2), None), ("a", h(1), "late"), ("b", h(0), "q"), ("x", h(1), None), ("a", h(2), "new")]
    ups = [event(rnd, i + 1, k) | {"status_checked_at": t, "saved_relative_path": p, "sale_status_raw": str(i)} for i, (k, t, p) in enumerate(ups)]
    new, outcome = c.apply_status_updates(table(spark, base), table(spark, ups, "seq long, operation string, "))
    got = {r.document_key: (r.sale_status_raw, r.saved_relative_path) for r in new.collect()}
    assert got == {"a": ("4", "new"), "b": ("2", "q"), "c": (None, "p")}
    assert tuple(outcome.first()) == (5, 3, 1, 1)


def test_reports(spark):
    good = event(random.Random(3), 0, "DOC_0123456789") | {"product_version_key": "PROD_VER_0123456789", "sha256": "a" * 64, "file_status": "AVAILABLE", "document_type": "POLICY", "source_metadata": {"source_row": "1"}}
    bad = good | {"document_key": "DOC_x", "sha256": None, "status_missing_count": -1, "identity_version": 3, "document_type": "?"}
    df = table(spark, [good, bad])
    wrong = {r.rule: r.bad_rows for r in c.constraint_report(df).collect() if r.bad_rows}
    assert wrong == {"document_key_format": 1, "identity_version": 1, "missing_count": 1, "document_type": 1, "available_has_sha256": 1}
    assert tuple(c.inspect(df).first())[:6] == (2, 1, 1, 1, 0, 1)
    assert [(r.source_row, r.documents) for r in c.provenance_errors(df).collect()] == [("1", 2)]
