"""List payloads of sites: JSON envelopes, JSON in JSON, XML lists, HTML tables and links, odd encodings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.functions.text import absolute_url, clean

#: Fixed value: encodings tried after the one that the header names.
ENCODINGS = ("utf-8", "euc-kr", "cp949")
#: So many payloads are decoded at a time.
AT_A_TIME = 64


def unwrap(payloads: DataFrame, item: str, ok: str = "S") -> tuple[DataFrame, DataFrame]:
    """``payloads(company, tab, page, body)`` with ``{"result": ok, "data": {"list": [...]}}`` -> rows with ``pos`` and ``item``, and bad payloads.

    ``item`` is the DDL of an entry. An empty list is a result without rows; any other result, or no list of objects, is bad.
    """
    told = payloads.withColumn("e", F.from_json("body", f"result string, data struct<list:array<struct<{_fields(item)}>>>"))
    raw = F.get_json_object("body", "$.data.list")
    good = F.coalesce((F.col("e.result") == ok) & F.col("e.data.list").isNotNull() & raw.startswith("["), F.lit(False))
    rows = told.where(good).select("company", "tab", "page", F.posexplode("e.data.list").alias("pos", "item"))
    return rows, told.where(~good).select("company", "tab", "page", "body")


def _fields(ddl: str) -> str:
    return ",".join(f"{n}:{k}" for n, k in (part.split() for part in ddl.split(", ")))


def inner_json(rows: DataFrame, column: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """A column of JSON text as a map ``cells``; rows that lack a required cell are errors."""
    told = rows.withColumn("cells", F.from_json(column, "map<string,string>"))
    good = F.col("cells").isNotNull()
    for name in required:
        good = good & F.coalesce(F.map_contains_key("cells", F.lit(name)), F.lit(False))
    return told.where(good), told.where(~good)


def xml_rows(payloads: DataFrame, schema: str, tag: str) -> DataFrame:
    """``payloads(company, body)`` of an XML list -> one row for each ``tag``: child texts and attributes by upper-cased name, prefixes gone."""
    bare = F.regexp_replace(F.regexp_replace("body", r"<(/?)[A-Za-z0-9_]+:", "<$1"), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    items = F.regexp_extract_all(bare, F.lit(rf"(?is)(<{tag}\b[^>]*?(?:/>|>.*?</{tag}>))"))
    told = payloads.select("company", F.posexplode(items).alias("pos", "_x"))
    names = [p.split()[0] for p in schema.split(", ")]

    def value(name: str) -> Column:
        child = F.regexp_extract("_x", rf"(?is)<{name}\b[^>]*>(?:<!\[CDATA\[)?(.*?)(?:\]\]>)?</{name}>", 1)
        attribute = F.regexp_extract("_x", rf"(?is)^<{tag}\b[^>]*?\s{name}=\"([^\"]*)\"", 1)
        return F.coalesce(F.nullif(_unescaped(child), F.lit("")), F.nullif(_unescaped(attribute), F.lit(""))).alias(name.upper())

    return told.select("company", "pos", *[value(n) for n in names])


def _unescaped(text: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(text)


def xml_columns(payloads: DataFrame, tags: list[str]) -> DataFrame:
    """XML with one parallel list for each tag -> rows by place; short lists are filled up with empty texts."""
    values = [F.transform(F.regexp_extract_all("body", F.lit(rf"(?s)<{t}>(.*?)</{t}>|<{t}/>"), F.lit(1)), lambda x: _unescaped(x)).alias(t) for t in tags]
    told = payloads.select("company", F.arrays_zip(*values).alias("_z"))
    rows = told.select("company", F.posexplode("_z").alias("pos", "_r"))
    return rows.select("company", "pos", *[F.coalesce(F.col(f"_r.{t}"), F.lit("")).alias(t) for t in tags])


class _Tables(HTMLParser):
    """Rows of all tables of a page, with spans written out to the cells they cover."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[tuple[bool, list[tuple[str, int]]]]] = []
        self.open: list[int] = []
        self.cell: list[str] | None = None
        self.span, self.head = 1, False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.open.append(len(self.tables))
            self.tables.append([])
        elif tag == "tr" and self.open:
            self._end()
            self.tables[self.open[-1]].append((True, []))
        elif tag in ("td", "th") and self.open and self.tables[self.open[-1]]:
            self._end()
            span = dict(attrs).get("rowspan") or "1"
            self.cell, self.span, self.head = [], int(span) if span.isdigit() else 1, tag == "th"

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self._end()
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)

    def _end(self) -> None:
        if self.cell is None or not self.open:
            return
        rows = self.tables[self.open[-1]]
        head, cells = rows[-1]
        rows[-1] = (head and self.head, [*cells, (" ".join("".join(self.cell).split()), self.span)])
        self.cell = None


def table_grid(page: str | None) -> list[tuple[int, int, bool, list[str]]]:
    """Rows of a page's tables as (table, row, is header, cells); a cell that spans rows is only in its first."""
    parser = _Tables()
    parser.feed(page or "")
    parser.close()
    return [(t, r, head, [c for c, _ in cells]) for t, rows in enumerate(parser.tables) for r, (head, cells) in enumerate(rows) if cells]


def html_rows(pages: DataFrame) -> DataFrame:
    """``pages(page_id, html)`` -> ``page_id, table_no, row_no, is_header, cells`` of all tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.string()))
        for batch in batches:
            rows = [(i, *row) for i, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for row in table_grid(page)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["page_id", "table_no", "row_no", "is_header", "cells"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, table_no int, row_no int, is_header boolean, cells array<string>")


def by_header(rows: DataFrame) -> DataFrame:
    """Rows of tables as maps from the header's words to cells; rows that a span shortens are aligned to the right."""
    whole = Window.partitionBy("page_id", "table_no")  # a join with the headers would parse all pages twice
    headed = rows.where("page_id is not null and table_no is not null").withColumn("head", F.min_by("cells", F.when(F.col("is_header"), F.col("row_no"))).over(whole))
    body = headed.where("not is_header and head is not null")
    short = F.greatest(F.size("head") - F.size("cells"), F.lit(0))
    filled = F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), short), "cells"), 1, F.size("head"))
    return body.select("page_id", "table_no", "row_no", F.map_from_entries(F.arrays_zip(F.transform("head", lambda h, i: F.when(h == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(h)), filled)).alias("row"))


def html_links(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> every link in order: ``page_id, pos, href, url, label``."""
    anchors = F.regexp_extract_all("html", F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']?[^\"'\s>]*[\"']?[^>]*>.*?</a>"), F.lit(0))
    told = pages.select("page_id", F.col("url").alias("_base"), F.posexplode(anchors).alias("pos", "_a"))
    href = F.regexp_extract("_a", r"(?is)href\s*=\s*[\"']?([^\"'\s>]*)", 1)
    label = clean(_unescaped(F.regexp_replace("_a", r"(?s)<[^>]*>", " ")))
    return told.select("page_id", "pos", href.alias("href"), absolute_url(F.col("_base"), href).alias("url"), label.alias("label"))


def decode_bytes(body: bytes | None, header: str | None, fallback: str = "utf-8") -> tuple[str, str, bool]:
    """Text, encoding used and whether characters were replaced: the header's encoding first, then the usual ones."""
    named = re.search(r"charset=([\w\-]+)", header or "", re.IGNORECASE)
    for encoding in ([named[1].lower()] if named else []) + [fallback, *ENCODINGS]:
        try:
            return (body or b"").decode(encoding), encoding, False
        except (UnicodeDecodeError, LookupError):
            continue
    return (body or b"").decode("utf-8", "replace"), "utf-8", True


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, so that texts of a whole batch needn't be held as objects, as a table and as output at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_A_TIME):
            yield batch.slice(start, AT_A_TIME)


def decoded(payloads: DataFrame, fallback: str = "utf-8") -> DataFrame:
    """``payloads(..., body binary, content_type)`` with ``text, charset, replaced``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few(batches):
            found = [decode_bytes(b.as_py(), c, fallback) for b, c in zip(batch.column("body"), batch.column("content_type").to_pylist(), strict=True)]
            extra = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "text", "charset", "replaced"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in payloads.schema)
    return payloads.mapInArrow(run, f"{kinds}, text string, charset string, replaced boolean")
