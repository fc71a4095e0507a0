"""WARC archives: writing pages with revisit records, and reading them back by boundary-chain verification.

A reader task that starts anywhere in an archive can only look for the magic line, which payloads may hold too. So tasks
emit candidates, each with the offset at which its successor must begin by its declared length, and pointer jumping
from offset 0 keeps those that the chain of records reaches.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.llm.store import discard, fresh_path, materialize

#: Fixed values of the format.
VERSION, BREAK, END = "WARC/1.1\r\n", "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 100

_MAGIC = (END + VERSION).encode()
_CANDIDATE = (
    "file string, block long, rel long, size long, head int, length long, record_type string, record_id string, refers_to string, "
    "payload_bytes long, payload_digest string, whole boolean"
)


def write_archive(pages: DataFrame, path: str) -> None:
    """Write a record for every row of ``pages(page_id, url, html)`` to archives in ``path``.

    Of rows with equal payloads of ``LEAST_BYTES`` at least, that with the smallest page_id is stored and the others
    become revisits of it. A null html is an empty payload, a null url is left out, line ends in a url become %0A; rows
    without page_id and repeated rows of the stored page are stored themselves. Only those three columns are read.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.regexp_replace(F.col("url").cast("string"), r"[\r\n]", "%0A").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    equal = rows.where((F.col("bytes") >= LEAST_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest")
    first = equal.groupBy("digest").agg(F.min("page_id").alias("stored"), F.max("page_id").alias("last")).where("stored < last").drop("last")
    again = materialize(equal.join(first, "digest").where("page_id > stored").distinct(), "revisits")
    told = rows.join(again, ["page_id", "digest"], "left")
    revisit = F.col("stored").isNotNull()
    body = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload")))

    def line(name: str, *value) -> F.Column:
        return F.concat(F.lit(f"{name}: "), *value, F.lit(BREAK))

    page = lambda c: (F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    record = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", *page("page_id")),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.lit("sha256:"), F.col("digest")),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", *page("stored")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit(BREAK),
        body,
    )
    told.select(record.alias("value")).write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The archives cut at every magic line, wherever Spark splits them: bytes, and the split they came from."""
    read = spark.read.option("lineSep", END + VERSION).text(path)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("long").alias("block"), F.col("value").cast("binary").alias("raw"))


_HEADER = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)")


def _header(raw: bytes) -> tuple[int, dict[str, str]]:
    """Length of a record's header with the blank line, and its fields; -1 if it doesn't end here or has no length."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return -1, {}
    fields = {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, v in _HEADER.findall(raw[:end])}
    return (end + 4 if re.fullmatch(r"\d{1,18}", fields.get("content-length", "")) else -1), fields


def _urn(value: str | None) -> str | None:
    m = re.fullmatch(r"<urn:page:(.*)>", value or "")
    return m[1] if m else None


def _payload(content: bytes) -> bytes:
    """What follows the HTTP header of a response."""
    end = content.find(b"\r\n\r\n")
    return content[end + 4 :] if content.startswith(b"HTTP/") and end >= 0 else content


def _described(fields: dict[str, str], content: bytes) -> tuple[int | None, str | None]:
    """Size and digest of a record's full payload: of the content, or for a revisit as it declares."""
    if fields.get("warc-type") == "revisit":
        declared = fields.get("warc-payload-length", "")
        return int(declared) if declared.isdigit() else None, fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    payload = _payload(content)
    return len(payload), hashlib.sha256(payload).hexdigest()


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk as a candidate record, with its place in its split."""
    at, rel = None, 0
    for batch in batches:
        out = []
        for file, block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            raw = raw.as_py()
            if at != (file, block):
                at, rel = (file, block), 0
            opening = raw.startswith(VERSION.encode())
            text = raw[len(VERSION) :] if opening else raw
            head, fields = _header(text)
            length = int(fields["content-length"]) if head >= 0 else -1
            whole = head >= 0 and len(text) >= head + length
            size, digest = _described(fields, text[head : head + length]) if whole else (None, None)
            out.append((file, block, rel, len(raw) + len(_MAGIC), head, length, fields.get("warc-type"), _urn(fields.get("warc-record-id")), _urn(fields.get("warc-refers-to")), size, digest, whole))
            rel += len(raw) + len(_MAGIC)
        if out:
            columns = [c.split() for c in _CANDIDATE.split(", ")]
            kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(zip(*out, strict=True), columns, strict=True)], names=[n for n, _ in columns])


def _placed(chunks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Chunks with ``at``, the offset of their magic line; splits follow each other without gaps, so sums of their sizes place them."""
    so_far = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.withColumn("base", F.coalesce(F.sum("bytes").over(so_far), F.lit(0))).select("file", "block", "base")
    start = F.col("base") + F.col("rel")
    return chunks.join(base, ["file", "block"]).withColumn("at", F.when(start == 0, F.lit(0)).otherwise(start - len(VERSION))).drop("base")


def reachable(candidates: DataFrame, rounds: int = 64) -> DataFrame:
    """``candidates(file, at, next)`` -> ``(file, at)`` of those on the chain from offset 0, by pointer jumping.

    After k rounds the first 2 ** k records of every chain are known and pointers span as many.
    """
    jump = candidates.select("file", "at", "next")
    seen = materialize(jump.where("at = 0").select("file", "at"), "seen")
    count = seen.count()
    for _ in range(rounds):
        ahead = jump.join(seen, ["file", "at"]).select("file", F.col("next").alias("at"))
        ahead = ahead.join(candidates.select("file", "at"), ["file", "at"], "left_semi")
        grown = materialize(seen.union(ahead).distinct(), "seen")
        more = grown.count()
        discard(seen)
        seen = grown
        if more == count:
            break
        count = more
        leap = jump.select(F.col("file"), F.col("at").alias("next"), F.col("next").alias("after"))
        further = materialize(jump.join(leap, ["file", "next"]).select("file", "at", F.col("after").alias("next")), "jump")
        if hasattr(jump, "_corvane_path"):
            discard(jump)
        jump = further
    return seen


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in ``path``: ``record_id, record_type, refers_to, payload_bytes, payload_digest, damaged``.

    One row per record on the chain of its file. Archives may be split anywhere; payloads may hold magic lines and even
    whole records, which are then parts of that payload. A record that its file's end cuts short is ``damaged`` and has
    no digest. Empty archives give no row. A revisit tells size and digest of the payload that it refers to.
    """
    chunks = materialize(_chunks(spark, path).mapInArrow(_candidates, _CANDIDATE), "candidates")
    sizes = chunks.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    places = materialize(_placed(chunks, sizes), "places")
    discard(chunks)
    end = F.col("at") + len(VERSION) + F.col("head") + F.col("length") + len(END)
    usable = places.where("head >= 0").withColumn("next", end)
    chain = reachable(usable)
    good = usable.join(chain, ["file", "at"])
    fields = ["record_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    done = good.where("whole").select(*fields, F.lit(False).alias("damaged"))
    cut = materialize(good.where("not whole").select("file", "at", "next"), "cut")
    if cut.isEmpty():
        return done

    # Chunks behind a cut record belong to the last record of the chain ahead of them.
    owner = F.last(F.when(F.col("own"), F.col("at")), ignorenulls=True).over(Window.partitionBy("file").orderBy("at"))
    marked = places.select("file", "block", "rel", "at").join(chain.withColumn("own", F.lit(True)), ["file", "at"], "left")
    owned = marked.withColumn("owner", owner).select("file", "block", "rel", "owner")
    parts = materialize(owned.join(cut.select("file", F.col("at").alias("owner")), ["file", "owner"]), "parts")
    wanted = _chunks(spark, path).mapInArrow(_numbered, "file string, block long, rel long, raw binary").join(parts, ["file", "block", "rel"])

    def join_parts(group: pd.DataFrame) -> pd.DataFrame:
        raw = _MAGIC.join(group.sort_values(["block", "rel"])["raw"])
        text = raw.removeprefix(VERSION.encode())
        head, told = _header(text)
        length = int(told["content-length"])
        whole = len(text) >= head + length
        size, digest = _described(told, text[head : head + length]) if whole else (None, None)
        return pd.DataFrame([(_urn(told.get("warc-record-id")), told.get("warc-type"), _urn(told.get("warc-refers-to")), size, digest, not whole)], columns=[*fields, "damaged"])

    mended = wanted.groupBy("file", "owner").applyInPandas(join_parts, "record_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, damaged boolean")
    return done.unionByName(mended)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with their place in their split."""
    at, rel = None, 0
    for batch in batches:
        rels = np.zeros(batch.num_rows, np.int64)
        sizes = pc.binary_length(batch.column(2)).to_numpy()
        for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if at != key:
                at, rel = key, 0
            rels[i] = rel
            rel += int(sizes[i]) + len(_MAGIC)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rels), batch.column(2)], names=["file", "block", "rel", "raw"])


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to fresh archives in the shared folder and read them back: a row per page, see ``op6`` in the README."""
    spark = pages.sparkSession
    path = fresh_path(spark, "archive")
    write_archive(pages, path)
    back = read_archive(spark, path)
    return back.select(
        F.expr("try_cast(record_id as bigint)").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.expr("try_cast(refers_to as bigint)").alias("refers_to")
    )
