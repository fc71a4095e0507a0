"""Questions about list payloads, journals, the catalog's store and lookups, details, moves: tables are written in the forms of sites and read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvane.functions import keys
from corvane.operators import catalog, joins, ordering, reconcile, reports, selection
from corvane.plans import bind
from corvane.plans.bind import table
from corvane.plans.records import ORACLES as _RECORDS
from corvane.plans.records import _K, _E, _catalog, _catalog_events, catalog_states
from corvane.sources import journals, payloads
from corvane.sources.scratch import fresh_path
from corvane.streaming import events as streams
from corvane.streaming import outbox
from corvane.streaming.store import BucketedTable

_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus")


def _orders(spark, sf):
    """Line items of each order, in order."""
    lines = F.array_sort(F.collect_list(F.struct(*_LINE)))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(lines.alias("lines"))


def _written(parts, mark=""):
    return F.array_join(parts, mark)


# List payloads.


def _envelopes(spark, sf):
    items = F.transform("lines", lambda x: F.struct(x["l_partkey"].alias("part"), x["l_quantity"].alias("qty"), x["l_returnflag"].alias("flag")))
    state = F.when(F.col("l_orderkey") % 50 == 0, "E").otherwise("S")
    body = F.to_json(F.struct(state.alias("result"), F.struct(items.alias("list")).alias("data")))
    body = F.when(F.col("l_orderkey") % 50 == 1, F.lit('{"result":"S","data":{"list":{"part":1}}}')).otherwise(body)
    return _orders(spark, sf).select(F.lit("A").alias("company"), F.lit("on_sale").alias("tab"), F.col("l_orderkey").alias("page"), body.alias("body"))


def list_payloads(spark, sf):
    """Lists in JSON envelopes, read back row by row."""
    rows, _ = payloads.unwrap(_envelopes(spark, sf), "part long, qty double, flag string")
    return rows.select("page", "pos", "item.part", "item.qty", "item.flag")


def bad_payloads(spark, sf):
    """Envelopes that report an error or hold no list."""
    return payloads.unwrap(_envelopes(spark, sf), "part long, qty double, flag string")[1].select("page")


def inner_cells(spark, sf):
    """Cells in JSON texts inside rows; rows that lack a required cell are counted apart."""
    cells = F.to_json(F.struct(F.col("l_partkey").cast("string").alias("cell0"), F.col("l_returnflag").alias("cell1"), F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("int").cast("string")).alias("cell2")))
    rows = table(spark, sf, "lineitem").select(F.col("l_orderkey"), cells.alias("jsonData"))
    good, bad = payloads.inner_json(rows, "jsonData", ["cell0", "cell2"])
    told = good.groupBy("l_orderkey").agg(F.count("*").alias("rows"), F.sum(F.col("cells")["cell0"].cast("long")).alias("parts"), F.sum(F.col("cells")["cell2"].cast("long")).alias("qty"))
    return told.join(bad.groupBy("l_orderkey").agg(F.count("*").alias("lacking")), "l_orderkey", "left").na.fill(0, ["lacking"])


def xml_lists(spark, sf):
    """XML lists with prefixes, attributes, entities and empty elements."""
    item = F.transform("lines", lambda x: F.concat(F.lit('<s:item partno="'), x["l_partkey"].cast("string"), F.lit('"><s:name>A &amp; '), x["l_returnflag"], F.lit("</s:name><s:note/><s:qty>"), x["l_quantity"].cast("int").cast("string"), F.lit("</s:qty></s:item>")))
    body = F.concat(F.lit('<s:list xmlns:s="urn:x">'), _written(item), F.lit("</s:list>"))
    rows = payloads.xml_rows(_orders(spark, sf).select(F.col("l_orderkey").cast("string").alias("company"), body.alias("body")), "partno string, name string, note string, qty string", "item")
    return rows.select("company", "pos", "PARTNO", "NAME", "NOTE", "QTY")


def xml_column_lists(spark, sf):
    """XML with one list for each column; the second is one short."""
    part = _written(F.transform("lines", lambda x: F.concat(F.lit("<part>"), x["l_partkey"].cast("string"), F.lit("</part>"))))
    flag = _written(F.transform(F.slice("lines", 1, F.size("lines") - 1), lambda x: F.concat(F.lit("<flag>"), x["l_returnflag"], F.lit("</flag>"))))
    return payloads.xml_columns(_orders(spark, sf).select(F.col("l_orderkey").cast("string").alias("company"), F.concat(F.lit("<r>"), part, flag, F.lit("</r>")).alias("body")), ["part", "flag"])


def html_lists(spark, sf):
    """Lists in HTML tables, read by their header; the first cell spans all rows."""
    cell = lambda value: F.concat(F.lit("<td>"), value, F.lit("</td>"))
    rows = F.transform("lines", lambda x, i: F.concat(F.lit("<tr>"), F.when(i == 0, F.concat(F.lit("<td rowspan='"), F.size("lines").cast("string"), F.lit("'>order</td>"))).otherwise(""), cell(x["l_partkey"].cast("string")), cell(x["l_returnflag"]), F.lit("</tr>")))
    page = F.concat(F.lit("<table><tr><th>kind</th><th>part</th><th></th></tr>"), _written(rows), F.lit("</table>"))
    told = payloads.by_header(payloads.html_rows(_orders(spark, sf).select(F.col("l_orderkey").alias("page_id"), page.alias("html"))))
    return told.select("page_id", "row_no", F.col("row")["kind"].alias("kind"), F.col("row")["part"].alias("part"), F.col("row")["column_3"].alias("flag"))


def section_links(spark, sf):
    """Links of a page with the section they stand in, carried down from the last section's head."""
    found = payloads.html_links(table(spark, sf, "pages")).withColumn("head", F.col("pos") % 4 == 0)
    down = ordering.carried_down(found, ["page_id"], "pos", F.col("head"), F.col("label"), "section")
    return down.where("not head").select("page_id", "pos", "url", "label", "section")


# Journals, records, files.


def _journal(spark, sf):
    path = fresh_path(spark, "journal")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.when(F.col("o_orderkey") % 41 == 0, 1).otherwise(2).alias("schema_version"))
    journals.append_log(o.where("o_orderstatus <> 'O'"), path)
    journals.append_log(o.where("o_orderstatus = 'O'"), path)
    return journals.read_journal(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string", 2)


def journal_rows(spark, sf):
    """Orders appended to a journal in two runs, read back; each row gets its own place in the order of arrival."""
    rows, _ = _journal(spark, sf)
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.count_distinct("ingest_seq").alias("places"), F.sum("o_custkey").alias("customers"))


def journal_errors(spark, sf):
    """Lines of another version of the journal."""
    errors = _journal(spark, sf)[1]
    return errors.select(F.get_json_object("line", "$.o_orderkey").cast("long").alias("o_orderkey"))


def _outbox(spark, sf):
    e = bind.changes(spark, sf)
    product = F.when(F.col("event_id") % 10 == 3, "PROD_1").otherwise("PROD_VER_0000000000")
    rows = F.when(F.col("event_id") % 20 == 4, F.array(F.struct(F.lit("DOC_1").alias("document_key")))).otherwise(F.array(F.struct("document_key")))
    operation = F.when(F.col("event_id") % 4 == 0, "update_status_rows").when(F.col("event_id") % 15 == 1, "drop_all").otherwise(F.col("operation"))
    payload = F.when(operation == "update_status_rows", F.to_json(F.struct(rows.alias("rows")))).otherwise(F.to_json(F.struct("document_key", product.alias("product_version_key"))))
    value = F.to_json(F.struct(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"), F.struct(operation.alias("operation"), payload.alias("payload")).alias("event")))
    return journals.parse_events(e.select(F.col("seq").alias("ingest_seq"), value.alias("value")))


def outbox_events(spark, sf):
    """Events of an outbox that may be applied."""
    return _outbox(spark, sf)[0].groupBy("operation").agg(F.count("*").alias("events"), F.min("ingest_seq").alias("first_seq"), F.date_format(F.max("created_at"), "yyyy-MM-dd HH:mm:ss").alias("last_at"))


def outbox_errors(spark, sf):
    """Events with unknown operations or misshapen keys."""
    return _outbox(spark, sf)[1].select("ingest_seq")


def latest_runs(spark, sf):
    """The last run, by day and name, of all days' runs."""
    e = bind.changes(spark, sf)
    runs = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_day"), F.concat(F.lit("run_"), F.col("event_type")).alias("run_id")).agg(F.count("*").alias("total_records"))
    return journals.latest_run(runs)


def published_runs(spark, sf):
    """Summaries of runs, one for each day and kind of event, published under their exact names and read back; some aren't finished."""
    e = bind.changes(spark, sf)
    runs = e.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("run_day"), F.concat(F.lit("run_"), F.col("event_type")).alias("run_id")).agg(F.count("*").alias("total_records"))
    path = fresh_path(spark, "runs")
    finished = F.when(F.col("total_records") % 5 != 0, F.col("run_day")).alias("finished_at")
    journals.publish_summaries(runs.select("*", F.lit(3).alias("layout_version"), finished, F.when(F.col("total_records") % 3 == 0, "PARTIAL_SUCCESS").otherwise("SUCCESS").alias("run_status")), path)
    return journals.completed_runs(spark, path).select("run_day", "run_id", "run_status", "total_records")


def filed_by_month(spark, sf):
    """The plan filed under its months, and read back by folder."""
    path = fresh_path(spark, "plan")
    journals.write_by_month(bind.plan(spark, sf).select("month", "plan_key", "ingest_seq"), path)
    return spark.read.schema("plan_key string, ingest_seq long, month string").json(path).groupBy("month").agg(F.count("*").alias("items"), F.sum("ingest_seq").alias("seqs"))


def record_files(spark, sf):
    """Page and image records written as JSON lines and read back by their schema; records without a document are apart."""
    d = table(spark, sf, "documents").select(F.when(F.col("doc_id") % 30 != 0, F.col("source")).alias("doc_id"), F.col("doc_id").cast("int").alias("page_no"), F.lit(600.0).alias("width"), F.lit(800.0).alias("height"), F.col("text").alias("text_raw"), (F.col("doc_id") % 7 == 0).alias("extraction_failed"))
    images = d.select("doc_id", "page_no", *[F.lit(1.0).alias(c) for c in ("x0", "top", "x1", "bottom")], F.lit(64).alias("pixel_width"), F.col("page_no").alias("pixel_height"), F.sha2("text_raw", 256).alias("sha256"))
    path = fresh_path(spark, "records")
    journals.write_records(path, pages=d, images=images)
    told = [journals.read_records(spark, path, kind) for kind in ("pages", "images")]
    counts = [good.groupBy("doc_id").agg(F.count("*").alias("rows"), F.sum(F.col(c).cast("long")).alias("total")).withColumn("kind", F.lit(kind)) for (good, _), kind, c in zip(told, ("pages", "images"), ("extraction_failed", "pixel_height"), strict=True)]
    bad = [b.agg(F.lit(None).cast("string").alias("doc_id"), F.count("*").alias("rows"), F.lit(0).cast("long").alias("total")).withColumn("kind", F.lit(kind)) for (_, b), kind in zip(told, ("bad pages", "bad images"), strict=True)]
    return counts[0].unionByName(counts[1]).unionByName(bad[0]).unionByName(bad[1])


def extracted_records(spark, sf):
    """Lines, tables and warnings of pages written as JSON lines and read back by their schema; every 30th record names no document."""
    d = table(spark, sf, "documents").select(F.when(F.col("doc_id") % 30 != 0, F.col("source")).alias("doc_id"), F.col("doc_id").cast("int").alias("page_no"), "text", "lang")
    box = [F.lit(1.0).alias(c) for c in ("x0", "top", "x1", "bottom")]
    lines = d.select("doc_id", "page_no", F.posexplode(F.split("text", "\n")).alias("line_no", "text"), *box)
    tables = d.select("doc_id", "page_no", (F.col("page_no") % 4).alias("candidate_index"), F.array(*[F.lit(float(i)) for i in range(4)]).alias("bbox"), F.transform(F.split("text", "\n"), lambda x: F.array(x, F.lit("|"))).alias("rows"))
    warnings = d.select("doc_id", "lang", "page_no").select("doc_id", F.upper("lang").alias("code"), "page_no", F.concat(F.lit('a "quoted" \\ '), "lang").alias("message"))
    path = fresh_path(spark, "records")
    journals.write_records(path, lines=lines, tables=tables, warnings=warnings)
    sums = {"lines": F.sum(F.length("text")), "tables": F.sum(F.size("rows") + F.col("candidate_index")), "warnings": F.sum(F.length("message") + F.length("code"))}
    out = None
    for kind, total in sums.items():
        good, bad = journals.read_records(spark, path, kind)
        one = good.groupBy("doc_id").agg(F.count("*").alias("rows"), total.cast("long").alias("total")).withColumn("kind", F.lit(kind))
        one = one.unionByName(bad.agg(F.lit(None).cast("string").alias("doc_id"), F.count("*").alias("rows"), F.lit(0).cast("long").alias("total")).withColumn("kind", F.lit(f"bad {kind}")))
        out = one if out is None else out.unionByName(one)
    return out


def folder_digests(spark, sf):
    """Folders of the same files under other names have equal digests."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey"), (F.col("o_orderkey") % 100).alias("folder"))
    files = o.select(F.concat(F.lit("a/"), F.col("folder").cast("string")).alias("folder"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("name"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"))
    moved = files.select(F.concat(F.lit("b/"), F.substring("folder", 3, 9)).alias("folder"), "name", F.when(F.col("name") == "f7.pdf", F.lit("x")).otherwise(F.col("sha256")).alias("sha256"))
    both = keys.folder_digests(files.union(moved).select("folder", F.concat_ws("/", "folder", "name").alias("path"), "sha256"))
    return both.groupBy(F.substring("folder", 3, 9).alias("folder")).agg(F.max("files").alias("files"), F.count_distinct("digest").alias("contents"))


def stored_folders(spark, sf):
    """Folders of real files: each event kind's events, one file each."""
    path = fresh_path(spark, "files")
    e = table(spark, sf, "events").select("event_type", "event_id")
    e.repartition(1, "event_type").sortWithinPartitions("event_id").write.partitionBy("event_type").json(path)
    files = keys.stored_files(spark, path).where("folder like 'event_type=%'")
    told = keys.folder_digests(files.select("folder", "path", "sha256"))
    return told.select(F.substring_index("folder", "=", -1).alias("event_type"), "files", F.length("digest").alias("digits"))


def content_digests(spark, sf):
    """Digests of contents."""
    return table(spark, sf, "documents").select("doc_id", keys.content_key(F.col("text").cast("binary")).alias("sha256"))


# Catalog store, lookups, projection, replay.


def catalog_lookups(spark, sf):
    """Documents by key, known and unknown ones."""
    wanted = bind.changes(spark, sf).select(F.when(F.col("event_id") % 9 == 1, F.concat(F.lit("DOC_x"), F.col("event_id").cast("string"))).otherwise(F.col("document_key")).alias("document_key"), "event_id")
    told = catalog.bulk_lookup(wanted, _catalog(spark, sf))
    return told.groupBy("found", F.col("row.file_status").alias("file_status")).agg(F.count("*").alias("keys"))


def catalog_row(spark, sf):
    """One document of the catalog, by its key."""
    return catalog.point_lookup(_catalog(spark, sf), "DOC_0000000003").select("document_key", "file_status", "last_attempt_status")


def company_documents(spark, sf):
    """The documents of one company from a stored catalog, whose other folders aren't read."""
    path = fresh_path(spark, "catalog")
    told = _catalog_events(spark, sf).withColumn("company_code", F.concat(F.lit("C"), F.substring("document_key", 14, 1)))
    catalog.store(catalog.merge_events(spark.createDataFrame([], catalog.SCHEMA), told), path)
    return catalog.of_company(spark, path, "C3").groupBy("company_code", "file_status").agg(F.count("*").alias("documents"))


def projected_records(spark, sf):
    """Collected records as catalog events: a record's own values, else its version's."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    even = F.col("o_orderkey") % 2 == 0
    r = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("record_id"), F.when(even, F.col("c_name")).otherwise(" ").alias("product_name_raw"), F.col("c_mktsegment").alias("version_product_name_raw"), F.when(F.col("o_orderkey") % 3 == 0, "판매중").alias("sale_status"), F.lit("판매중지").alias("version_normalized_sale_status"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("version_target_date"), bind.mapped(F.col("o_orderstatus"), {"F": "success", "P": "DUPLICATE_SKIPPED"}).alias("download_status"), F.when(even, F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("sha256"), F.lit("r1").alias("run_id"), (F.col("o_orderkey") % 4).alias("file_size"),
    )
    return catalog.record_payloads(r).select("record_id", "operation", "product_name", "product_name_normalized", "sale_status", "sale_status_raw", F.date_format("document_date", "yyyy-MM-dd").alias("document_date"), "file_status", "last_attempt_status", "last_download_run_id", "file_size", "status_missing_count")


def metadata_entries(spark, sf):
    """Metadata without what the catalog has as columns."""
    told = _catalog_events(spark, sf).withColumn("m", catalog.clean_metadata(F.map_concat("source_metadata", F.create_map(F.lit("document_key"), F.col("document_key"), F.lit("identity_version"), F.lit("4")))))
    return told.select(F.explode("m").alias("name", "value")).groupBy("name").agg(F.count("*").alias("rows"), F.count_distinct("value").alias("values"))


def provenance_errors(spark, sf):
    """Source rows that are no numbers or that several documents claim."""
    row = F.when(F.col("event_id") % 100 == 0, F.lit("07")).when(F.col("event_id") % 10 == 1, F.col("user_id").cast("string")).otherwise((F.col("event_id") + 1_000_000).cast("string"))
    return catalog.provenance_errors(table(spark, sf, "events").select(F.create_map(F.lit("source_row"), row).alias("source_metadata")))


def replayed_catalog(spark, sf):
    """Events replayed as a stream in several batches, with repeated ids, over a catalog of the first half: as if merged at once."""
    e = _catalog_events(spark, sf).withColumn("event_id", F.col("seq").cast("string"))
    half = table(spark, sf, "events").count() // 2
    source, path = fresh_path(spark, "outbox"), fresh_path(spark, "catalog")
    streams.apply_batch(e.where(F.col("seq") <= half), 0, path, f"{path}-seen")
    later = e.where(F.col("seq") > half)
    later.union(later.where("seq % 3 = 0")).repartitionByRange(4, "seq").sortWithinPartitions("seq").write.json(source)
    streams.replay(spark, source, f"{path}-2", f"{path}-log", f"{path}-seen2", files=2).awaitTermination()
    whole = catalog.merge_events(streams.read_catalog(spark, path), later)
    both = whole.select("document_key", "file_status", "last_attempt_status", "product_name").join(streams.read_catalog(spark, f"{path}-2").select("document_key", F.col("file_status").alias("replayed")), "document_key", "left")
    return both.groupBy("file_status", "last_attempt_status").agg(F.count("*").alias("documents"), F.count("replayed").alias("replayed"))


def replayed_states(spark, sf):
    """Events that arrive in an outbox in four parts, some twice, one bad in the middle, replayed into a stored catalog: the stream stops there, the event is set aside, the stream goes on."""
    e = _catalog_events(spark, sf)
    half = table(spark, sf, "events").count() // 2
    payload = F.to_json(F.struct(*catalog.COLUMNS), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    event = F.to_json(F.struct((F.col("seq") * 2).alias("seq"), F.concat(F.lit("e"), F.col("seq").cast("string")).alias("event_id"), F.struct("operation", payload.alias("payload")).alias("event")))
    lines = e.select("seq", event.alias("value"))
    bad = F.to_json(F.struct((F.col("seq") * 2 + 1).alias("seq"), F.lit("bad").alias("event_id"), F.struct(F.lit("drop_all").alias("operation"), F.lit("{}").alias("payload")).alias("event")))
    lines = lines.union(lines.where("seq % 7 = 0")).union(e.where(F.col("seq") == half).select("seq", bad.alias("value")))
    source, path, log, aside = (fresh_path(spark, n) for n in ("outbox", "replayed", "log", "aside"))

    def arrive(i):
        part = lines.where((F.col("seq") > half * i // 2) & ((F.col("seq") <= half * (i + 1) // 2) | F.lit(i == 3)))
        part.select("value").write.mode("append").text(source)

    def replay():
        outbox.replay_outbox(spark, source, path, log, aside, files=100_000, buckets=16).awaitTermination()

    spark.createDataFrame([], outbox.IDS).write.json(aside)
    arrive(0)
    replay()
    arrive(1)
    try:
        replay()
        raise AssertionError("the bad event should have stopped the stream")
    except StreamingQueryException as stopped:
        if "PoisonedEventError" not in str(stopped):
            raise
    arrive(2)
    spark.createDataFrame([("bad",)], outbox.IDS).write.mode("append").json(aside)
    replay()
    arrive(3)
    replay()
    return catalog_states(outbox.catalog_table(spark, path).read())


def stored_rows(spark, sf):
    """A stored catalog in buckets after a second batch that touches some of them, and three of its documents found by key."""
    e = _catalog_events(spark, sf)
    stored = BucketedTable(spark, fresh_path(spark, "stored"), catalog.SCHEMA, "document_key", buckets=64)
    later = F.col("document_key").endswith("3") & (F.col("seq") > 100)
    stored.overwrite(catalog.merge_events(spark.createDataFrame([], catalog.SCHEMA), e.where(~later)))
    rest = e.where(later)
    merged = fresh_path(spark, "merged")
    catalog.merge_events(stored.read(stored.touched(rest)), rest).write.parquet(merged)
    stored.overwrite(spark.read.schema(catalog.SCHEMA).parquet(merged))
    return catalog_states(stored.lookup("DOC_0000000003", "DOC_0000000004", "DOC_0000000013", "DOC_x"))


def quarantined_events(spark, sf):
    """Requests to set events aside: only pending ones can be."""
    e = bind.changes(spark, sf)
    asked = e.where("event_type = 'error'").select("event_id", F.lit("bad").alias("reason"))
    put = streams.quarantine(asked.union(asked), e, e.where("event_id % 3 = 0").select("event_id"), e.where("event_id % 5 = 0").select("event_id"))
    return put.select("event_id", "reason")


def outbox_summary(spark, sf):
    """Pending events and failures by kind."""
    e = bind.changes(spark, sf)
    return reports.outbox_summary(e.where("event_type <> 'view'"), e.select(F.col("event_type").alias("failure_kind")))


def event_previews(spark, sf):
    """Operations with the beginnings of their keys."""
    e = bind.changes(spark, sf).select("event_id", "operation", F.array_repeat("document_key", (F.col("event_id") % 14).cast("int")).alias("keys"))
    return reports.event_previews(e).select("event_id", "operation", "rows", F.array_join("first_keys", ",").alias("first_keys"))


# Details, selection, moves.


def detail_periods(spark, sf):
    """Products with each of their periods, named by their supplier's nation."""
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("part"), "p_name")
    d = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("part"), "l_suppkey", "l_shipdate")
    named = joins.lookup(joins.drill_down(p, d, ["part"]), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("supplier"), F.col("s_acctbal").alias("ingest_seq")), "l_suppkey", "supplier")
    return named.groupBy("part").agg(F.count("*").alias("periods"), F.min("supplier").alias("first_supplier"))


def zipped_lists(spark, sf):
    """Parts and flags of an order side by side, the flags one short."""
    told = _orders(spark, sf).select("l_orderkey", F.transform("lines", lambda x: x["l_partkey"].cast("string")).alias("part"), F.transform(F.slice("lines", 1, F.size("lines") - 1), lambda x: x["l_returnflag"]).alias("flag"))
    return joins.zipped(told, "part", "flag", fill="-")


def best_details(spark, sf):
    """Orders with the line shipped on the day of ordering, else the first."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.to_date("o_orderdate").alias("sale_start_date"))
    li = table(spark, sf, "lineitem")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*_LINE))
    return joins.best_detail(o, li.select(F.col("l_orderkey").alias("key"), F.to_date("l_shipdate").alias("sale_start_date"), pos.alias("pos"), "l_partkey"), "key").select("key", "pos", "l_partkey")


def unfinished_products(spark, sf):
    """Parts to be read again after a stop: without a finished checkpoint of this scope, or on sale."""
    li = table(spark, sf, "lineitem")
    scope = F.when(F.col("l_linenumber") % 2 == 0, "2026-07").otherwise("2026-06")
    log = li.select(F.col("l_partkey").alias("part"), scope.alias("scope"), F.lit(1).alias("schema_version"), F.when(F.col("l_returnflag") == "A", "a1").otherwise("a2").alias("adapter_version"), F.when(F.col("l_linestatus") == "F", "completed").otherwise("failed").alias("status"))
    usable = selection.in_scope(log, "2026-07", 1, "a1")
    left = joins.unfinished(table(spark, sf, "part").select(F.col("p_partkey").alias("part")), usable, li.where("l_linestatus = 'O' and l_quantity > 45").select(F.col("l_partkey").alias("part")), "part")
    return left.select("part")


def redirected_records(spark, sf):
    """Records that one catalog row is the same document as, at another address."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("record_id"), F.col("o_custkey").alias("c"), F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("document_url"), F.col("o_orderpriority").alias("document_label"), F.lit("").alias("original_filename"))
    known = table(spark, sf, "customer").select(F.col("c_custkey").alias("c"), F.lit("").alias("checkpoint_key"), F.concat(F.lit("k"), F.col("c_custkey").cast("string")).alias("document_key"), F.lit("v").alias("document_url"), F.when(F.col("c_custkey") % 2 == 0, "5-LOW").alias("document_label"), F.lit("f").alias("original_filename"))
    twice = known.where("c % 10 = 3").withColumn("document_url", F.lit("w"))
    return joins.redirected(o, known.union(twice), ["c"]).select("record_id", "known_key")


def usable_images(spark, sf):
    """Images that aren't tiny."""
    i = table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 4).alias("pixel_width"), F.lit(300).alias("pixel_height"), (F.col("p_size") / 4000).alias("area_ratio"))
    return selection.usable_images(i).groupBy("pixel_width").agg(F.count("*").alias("images"))


def longest_texts(spark, sf):
    """The longest text of each conversation, the first of equals."""
    c = table(spark, sf, "conversations").withColumn("ingest_seq", F.col("turn"))
    return ordering.longest(c, ["conv_id"], "text").select("conv_id", "turn")


def numbered_tables(spark, sf):
    """Tables of a page numbered, and named."""
    n = ordering.numbered(table(spark, sf, "events").select("event_id", "user_id"), ["user_id"], [F.col("event_id")])
    return n.select("event_id", ordering.table_id(F.col("user_id").cast("int"), F.col("n")).alias("table_id"))


def _moves(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit("r/판매중__"), F.col("o_orderkey").cast("string")).alias("source"), F.concat(F.lit("r/판매완료__"), F.col("o_orderkey").cast("string")).alias("destination"))
    last = F.when(F.col("o_orderkey") % 5 == 0, "COMMITTED").otherwise("MOVING")
    step = lambda seq, phase: o.select(F.concat(F.lit("a"), F.col("o_orderkey").cast("string")).alias("action_id"), F.lit(seq).alias("ingest_seq"), phase.alias("phase"), "source", "destination", F.col("o_orderkey").cast("string").alias("logical_key"), F.lit("ACTIVE").alias("old_state"), F.lit("ENDED").alias("new_state"))
    there = o.where("o_orderkey % 3 <> 0").select(F.col("source").alias("path")).union(o.where("o_orderkey % 2 = 0").select(F.col("destination").alias("path")))
    return o, reconcile.open_moves(step(1, F.lit("PLANNED")).union(step(2, last)), there)


def open_moves(spark, sf):
    """Moves that a stopped run left open, and what is to be done about them."""
    return _moves(spark, sf)[1].groupBy("decision").agg(F.count("*").alias("moves"))


def recovered_moves(spark, sf):
    """Rows after recovered moves."""
    o, moves = _moves(spark, sf)
    rows = o.where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").cast("string").alias("key"), F.lit("ACTIVE").alias("state"), F.concat(F.col("source"), F.lit("/f.pdf")).alias("saved_relative_path"))
    return reconcile.reapply_moves(rows, moves)[0].groupBy("state", F.split("saved_relative_path", "__")[0].alias("folder")).agg(F.count("*").alias("rows"))


def recovery_counts(spark, sf):
    o, moves = _moves(spark, sf)
    rows = o.where("o_orderkey % 7 <> 0").select(F.col("o_orderkey").cast("string").alias("key"), F.lit("ACTIVE").alias("state"), F.col("source").alias("saved_relative_path"))
    return reconcile.reapply_moves(rows, moves)[1]


def committed_rows(spark, sf):
    """Rows after their folders were moved, or not."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("key"), F.lit(1).alias("ingest_seq"), "o_orderkey")
    before = o.select("key", "ingest_seq", F.lit("ACTIVE").alias("state"), F.concat(F.lit("r/old"), F.col("key"), F.lit("/f.pdf")).alias("saved_relative_path"))
    after = o.select("key", "ingest_seq", F.lit("ENDED").alias("state"), F.concat(F.lit("r/new"), F.col("key"), F.lit("/f.pdf")).alias("saved_relative_path"))
    outcomes = o.where("o_orderkey % 3 <> 0").select("key", (F.col("o_orderkey") % 3 == 1).alias("moved"), F.concat(F.lit("r/real"), F.col("key")).alias("destination"), F.concat(F.lit("r/new"), F.col("key")).alias("proposed"))
    done = reconcile.committed(before, after, outcomes)
    return done.groupBy("state", F.regexp_extract("saved_relative_path", "^r/([a-z]+)", 1).alias("folder")).agg(F.count("*").alias("rows"))


def catalog_companies(spark, sf):
    """Documents by company."""
    told = _catalog(spark, sf).withColumn("company_code", F.concat(F.lit("C"), F.substring("document_key", 14, 1)))
    return catalog.company_counts(told)


_FEEDS = (
    list_payloads, bad_payloads, inner_cells, xml_lists, xml_column_lists, html_lists, section_links, journal_rows, journal_errors, outbox_events, outbox_errors, latest_runs, published_runs, filed_by_month, record_files, extracted_records, folder_digests, stored_folders, content_digests,
    catalog_lookups, catalog_row, company_documents, projected_records, metadata_entries, provenance_errors, replayed_catalog, replayed_states, stored_rows, quarantined_events, outbox_summary, event_previews, detail_periods, zipped_lists, best_details, unfinished_products, redirected_records, usable_images,
    longest_texts, numbered_tables, open_moves, recovered_moves, recovery_counts, committed_rows, catalog_companies,
)
QUERIES = {f.__name__: f for f in _FEEDS}

_L = f"l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE)}) - 1 AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"
_A = "a AS (SELECT page_id, url AS base, generate_subscripts(x, 1) - 1 AS pos, unnest(x) AS x FROM (SELECT page_id, url, regexp_extract_all(html, '<a [^>]*?href=\"[^\"]*\"[^>]*>.*?</a>') AS x FROM pages)), h AS (SELECT page_id, pos, base, regexp_extract(x, 'href=\"([^\"]*)\"', 1) AS href, regexp_extract(x, '>([^<]*)</a>', 1) AS label FROM a)"
_OUT = f"""{_E}, x AS (SELECT *, CASE WHEN event_id % 4 = 0 THEN 'update_status_rows' WHEN event_id % 15 = 1 THEN 'drop_all' ELSE operation END AS op FROM e),
y AS (SELECT *, CASE op WHEN 'update_status_rows' THEN event_id % 20 <> 4 WHEN 'drop_all' THEN false ELSE event_id % 10 <> 3 END AS good FROM x)"""
_MOVE = """m AS (SELECT o_orderkey AS k, CASE WHEN NOT s AND d THEN 'MOVED' WHEN s AND NOT d THEN 'REDO' WHEN s AND d THEN 'CONFLICT' ELSE 'PENDING' END AS decision FROM (SELECT o_orderkey, o_orderkey % 3 <> 0 AS s, o_orderkey % 2 = 0 AS d FROM orders) WHERE o_orderkey % 5 <> 0)"""
_STATE = "CASE WHEN o_orderstatus = 'F' THEN 'SUCCESS' WHEN o_orderstatus = 'P' THEN 'DUPLICATE_SKIPPED' END"

ORACLES = {
    "list_payloads": f"WITH {_L} SELECT l_orderkey AS page, pos, l_partkey AS part, l_quantity AS qty, l_returnflag AS flag FROM l WHERE l_orderkey % 50 > 1",
    "bad_payloads": "SELECT DISTINCT l_orderkey AS page FROM lineitem WHERE l_orderkey % 50 < 2",
    "inner_cells": "SELECT l_orderkey, count(*) FILTER (l_returnflag <> 'R') AS rows, sum(l_partkey) FILTER (l_returnflag <> 'R')::BIGINT AS parts, sum(l_quantity::INTEGER) FILTER (l_returnflag <> 'R')::BIGINT AS qty, count(*) FILTER (l_returnflag = 'R') AS lacking FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag <> 'R') > 0",
    "xml_lists": f"WITH {_L} SELECT l_orderkey::VARCHAR AS company, pos, l_partkey::VARCHAR AS \"PARTNO\", 'A & ' || l_returnflag AS \"NAME\", NULL AS \"NOTE\", (l_quantity::INTEGER)::VARCHAR AS \"QTY\" FROM l",
    "xml_column_lists": f"WITH {_L} SELECT l_orderkey::VARCHAR AS company, pos, l_partkey::VARCHAR AS part, CASE WHEN pos < n - 1 THEN l_returnflag ELSE '' END AS flag FROM l",
    "html_lists": f"WITH {_L} SELECT l_orderkey AS page_id, pos + 1 AS row_no, CASE WHEN pos = 0 THEN 'order' END AS kind, l_partkey::VARCHAR AS part, l_returnflag AS flag FROM l",
    "section_links": f"WITH {_A}, s AS (SELECT *, last_value(CASE WHEN pos % 4 = 0 THEN label END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM h) SELECT page_id, pos, regexp_extract(base, '^https?://[^/?#]*') || href AS url, label, section FROM s WHERE pos % 4 <> 0",
    "journal_rows": "SELECT o_orderstatus, count(*) AS rows, count(*) AS places, sum(o_custkey)::BIGINT AS customers FROM orders WHERE o_orderkey % 41 <> 0 GROUP BY 1",
    "journal_errors": "SELECT o_orderkey FROM orders WHERE o_orderkey % 41 = 0",
    "outbox_events": f"WITH {_OUT} SELECT op AS operation, count(*) AS events, min(seq) AS first_seq, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_at FROM y WHERE good GROUP BY 1",
    "outbox_errors": f"WITH {_OUT} SELECT seq AS ingest_seq FROM y WHERE NOT good",
    "latest_runs": "SELECT strftime(ts, '%Y-%m-%d') AS run_day, 'run_' || event_type AS run_id, count(*) AS total_records FROM events GROUP BY 1, 2 ORDER BY 1 DESC, 2 DESC LIMIT 1",
    "published_runs": """SELECT strftime(ts, '%Y-%m-%d') AS run_day, 'run_' || event_type AS run_id, CASE WHEN count(*) % 3 = 0 THEN 'PARTIAL_SUCCESS' ELSE 'SUCCESS' END AS run_status, count(*) AS total_records FROM events GROUP BY 1, 2 HAVING count(*) % 5 <> 0""",
    "filed_by_month": "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS items, sum(o_orderkey)::BIGINT AS seqs FROM orders GROUP BY 1",
    "record_files": """WITH d AS (SELECT CASE WHEN doc_id % 30 <> 0 THEN source END AS doc_id, doc_id AS n FROM documents)
SELECT doc_id, count(*) AS rows, count(*) FILTER (n % 7 = 0) AS total, 'pages' AS kind FROM d WHERE doc_id IS NOT NULL GROUP BY 1 UNION ALL SELECT doc_id, count(*), sum(n)::BIGINT, 'images' FROM d WHERE doc_id IS NOT NULL GROUP BY 1
UNION ALL SELECT NULL, count(*), 0, 'bad pages' FROM d WHERE doc_id IS NULL UNION ALL SELECT NULL, count(*), 0, 'bad images' FROM d WHERE doc_id IS NULL""",
    "extracted_records": """WITH d AS (SELECT CASE WHEN doc_id % 30 <> 0 THEN source END AS doc_id, doc_id AS n, lang, string_split(text, chr(10)) AS l FROM documents), l AS (SELECT doc_id, unnest(l) AS x FROM d)
SELECT doc_id, count(*) AS rows, sum(length(x))::BIGINT AS total, 'lines' AS kind FROM l WHERE doc_id IS NOT NULL GROUP BY 1 UNION ALL SELECT doc_id, count(*), sum(len(l) + n % 4)::BIGINT, 'tables' FROM d WHERE doc_id IS NOT NULL GROUP BY 1
UNION ALL SELECT doc_id, count(*), sum(2 * length(lang) + 13)::BIGINT, 'warnings' FROM d WHERE doc_id IS NOT NULL GROUP BY 1
UNION ALL SELECT NULL, (SELECT count(*) FROM l WHERE doc_id IS NULL), 0, 'bad lines' UNION ALL SELECT NULL, (SELECT count(*) FROM d WHERE doc_id IS NULL), 0, 'bad tables' UNION ALL SELECT NULL, (SELECT count(*) FROM d WHERE doc_id IS NULL), 0, 'bad warnings'""",
    "folder_digests": "SELECT (o_orderkey % 100)::VARCHAR AS folder, count(*) AS files, CASE WHEN bool_or(o_orderkey = 7) THEN 2 ELSE 1 END AS contents FROM orders GROUP BY 1",
    "stored_folders": "SELECT event_type, 1 AS files, 64 AS digits FROM events GROUP BY 1",
    "content_digests": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "catalog_lookups": f"WITH {_K} SELECT cat.document_key IS NOT NULL AS found, file_status, count(*) AS keys FROM (SELECT CASE WHEN event_id % 9 <> 1 THEN document_key END AS key FROM e) LEFT JOIN cat ON cat.document_key = key GROUP BY 1, 2",
    "catalog_row": f"WITH {_K} SELECT document_key, file_status, last_attempt_status FROM cat WHERE document_key = 'DOC_0000000003'",
    "company_documents": f"WITH {_K} SELECT 'C3' AS company_code, file_status, count(*) AS documents FROM cat WHERE substr(document_key, 14, 1) = '3' GROUP BY 2",
    "catalog_companies": f"WITH {_K} SELECT 'C' || substr(document_key, 14, 1) AS company_code, count(*) AS documents, count(*) FILTER (file_status = 'AVAILABLE') AS available FROM cat GROUP BY 1",
    "projected_records": f"""WITH r AS (SELECT *, {_STATE} AS tried, CASE WHEN o_orderkey % 2 = 0 THEN true ELSE false END AS proof, CASE WHEN o_orderkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS name FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey AS record_id, CASE WHEN tried IS NULL THEN 'upsert_seen' ELSE 'upsert_result' END AS operation, name AS product_name, name AS product_name_normalized, CASE WHEN o_orderkey % 3 = 0 THEN 'ACTIVE' ELSE 'ENDED' END AS sale_status,
  CASE WHEN o_orderkey % 3 = 0 THEN '판매중' END AS sale_status_raw, strftime(o_orderdate, '%Y-%m-%d') AS document_date, CASE WHEN tried IS NULL THEN 'PENDING' WHEN proof THEN 'AVAILABLE' WHEN tried = 'SUCCESS' THEN 'UNAVAILABLE' ELSE 'PENDING' END AS file_status,
  tried AS last_attempt_status, CASE WHEN tried IS NOT NULL AND proof THEN 'r1' END AS last_download_run_id, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END AS file_size, 0 AS status_missing_count FROM r""",
    "metadata_entries": "SELECT 'checkpoint_key' AS name, count(*) AS rows, 1 AS values FROM events UNION ALL SELECT CASE WHEN event_id % 2 = 0 THEN 'migration' ELSE 'final_url' END, count(*), count(DISTINCT event_id) FROM events GROUP BY 1",
    "provenance_errors": "WITH r AS (SELECT CASE WHEN event_id % 100 = 0 THEN '07' WHEN event_id % 10 = 1 THEN user_id::VARCHAR ELSE (event_id + 1000000)::VARCHAR END AS source_row FROM events) SELECT source_row, count(*) AS documents FROM r GROUP BY 1 HAVING NOT regexp_full_match(source_row, '[1-9][0-9]*') OR count(*) > 1",
    "replayed_catalog": f"WITH {_K}, later AS (SELECT DISTINCT document_key FROM e WHERE seq > (SELECT count(*) // 2 FROM e)) SELECT file_status, last_attempt_status, count(*) AS documents, count(later.document_key) AS replayed FROM cat LEFT JOIN later USING (document_key) GROUP BY 1, 2",
    "replayed_states": _RECORDS["merged_catalog"],
    "stored_rows": f"SELECT * FROM ({_RECORDS['merged_catalog']}) WHERE document_key IN ('DOC_0000000003', 'DOC_0000000004', 'DOC_0000000013', 'DOC_x')",
    "quarantined_events": "SELECT event_id, 'bad' AS reason FROM events WHERE event_type = 'error' AND event_id % 3 <> 0 AND event_id % 5 <> 0",
    "outbox_summary": "SELECT 'pending' AS what, count(*) AS n FROM events WHERE event_type <> 'view' UNION ALL SELECT 'failure:' || event_type, count(*) FROM events GROUP BY 1",
    "event_previews": f"WITH {_E} SELECT event_id, operation, event_id % 14 AS rows, array_to_string(list_transform(range(least(event_id % 14, 10)), lambda i: substr(document_key, 1, 12)), ',') AS first_keys FROM e",
    "detail_periods": "SELECT l_partkey AS part, count(*) AS periods, min(s_name) AS first_supplier FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1",
    "zipped_lists": f"WITH {_L} SELECT l_orderkey, pos, l_partkey::VARCHAR AS part, CASE WHEN pos < n - 1 THEN l_returnflag ELSE '-' END AS flag FROM l",
    "best_details": f"WITH {_L}, r AS (SELECT o_orderkey AS key, pos + 1 AS pos, l_partkey, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate::DATE IS DISTINCT FROM o_orderdate::DATE, pos) AS rank FROM orders LEFT JOIN l ON l_orderkey = o_orderkey) SELECT key, pos, l_partkey FROM r WHERE rank = 1",
    "unfinished_products": "WITH d AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_linenumber % 2 = 0 AND l_returnflag = 'A' AND l_linestatus = 'F'), a AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_linestatus = 'O' AND l_quantity > 45) SELECT p_partkey AS part FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM d) OR p_partkey IN (SELECT l_partkey FROM a)",
    "redirected_records": "SELECT o_orderkey AS record_id, 'k' || c_custkey AS known_key FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 10 <> 3 AND (c_custkey % 2 <> 0 OR o_orderpriority = '5-LOW')",
    "usable_images": "SELECT p_size * 4 AS pixel_width, count(*) AS images FROM part WHERE p_size * 4 >= 64 AND p_size / 4000 >= 0.005 GROUP BY 1",
    "longest_texts": "SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS rn FROM conversations) WHERE rn = 1",
    "numbered_tables": "SELECT event_id, format('page_{:04d}_table_{:03d}', user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id)) AS table_id FROM events",
    "open_moves": f"WITH {_MOVE} SELECT decision, count(*) AS moves FROM m GROUP BY 1",
    "recovered_moves": f"WITH {_MOVE}, r AS (SELECT o_orderkey, decision IN ('MOVED', 'REDO') AS hit FROM orders LEFT JOIN m ON k = o_orderkey WHERE o_orderkey % 7 <> 0) SELECT CASE WHEN hit THEN 'ENDED' ELSE 'ACTIVE' END AS state, CASE WHEN hit THEN 'r/판매완료' ELSE 'r/판매중' END AS folder, count(*) AS rows FROM r GROUP BY 1, 2",
    "recovery_counts": f"WITH {_MOVE} SELECT count(*) FILTER (decision IN ('MOVED', 'REDO') AND k % 7 <> 0) AS moved, count(*) FILTER (decision = 'CONFLICT') AS conflicts, count(*) FILTER (decision = 'PENDING') AS pending, count(*) FILTER (decision IN ('MOVED', 'REDO') AND k % 7 = 0) AS unmatched FROM m",
    "committed_rows": "SELECT CASE WHEN o_orderkey % 3 = 2 THEN 'ACTIVE' ELSE 'ENDED' END AS state, CASE o_orderkey % 3 WHEN 0 THEN 'new' WHEN 1 THEN 'real' ELSE 'old' END AS folder, count(*) AS rows FROM orders GROUP BY 1, 2",
}
