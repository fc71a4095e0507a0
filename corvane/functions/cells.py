"""Table cells: ``array<array<string>>`` columns, rows of cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import empty_if_null, let

#: Words of header rows, and the sizes that rules go by.
HEADER_WORDS = (
    "구분", "항목", "내용", "비고", "가입조건", "가입나이", "보험기간", "납입기간", "납입주기", "급부명", "급부명칭", "보장내용",
    "지급사유", "지급금액", "보험료", "납입보험료", "해약환급금", "환급률", "기간", "목적", "시기", "비용", "합계",
)
LONG_CELL, PAGE_END = 10, 0.80
EMPTY_SHARE, LONGEST_CELL = 0.25, 120
CONTROLS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def clean_cell(cell: Column) -> Column:
    """A cell without marks of width zero, hard blanks as blanks, none at the ends; null is empty."""
    text = F.regexp_replace(empty_if_null(cell), "[​﻿]", "")
    return F.trim(F.replace(text, F.lit("\xa0"), F.lit(" ")))


def compact_cell(cell: Column) -> Column:
    return F.trim(F.regexp_replace(empty_if_null(cell), r"(?U)\s+", " "))


def width(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))


def clean_rows(rows: Column) -> Column:
    """Cells cleaned, blank rows dropped, short rows filled up, columns dropped that are blank in every row."""
    told = F.filter(F.transform(rows, lambda r: F.transform(r, clean_cell)), lambda r: F.exists(r, lambda c: c != ""))
    sized = let(told, lambda t: F.struct(t.alias("rows"), width(t).cast("int").alias("wide")))

    def filled(x: Column) -> Column:
        full = F.transform(x["rows"], lambda r: F.concat(r, F.array_repeat(F.lit(""), x["wide"] - F.size(r))))
        return F.struct(full.alias("rows"), x["wide"].alias("wide"))

    def used(x: Column) -> Column:
        columns = F.filter(F.sequence(F.lit(1), F.greatest(x["wide"], F.lit(1))), lambda i: F.exists(x["rows"], lambda r: F.try_element_at(r, i) != ""))
        return F.struct(x["rows"].alias("rows"), columns.alias("columns"))

    return let(let(let(sized, filled), used), lambda x: F.transform(x["rows"], lambda r: F.transform(x["columns"], lambda i: F.element_at(r, i))))


def without_controls(rows: Column) -> Column:
    """Cells without control characters other than tab and line ends."""
    return F.transform(rows, lambda r: F.transform(r, lambda c: F.regexp_replace(c, CONTROLS, "")))


def control_report(rows: Column) -> Column:
    """Which cells lost control characters: ``row, column, removed_count``, counted from 1."""
    cells = F.transform(rows, lambda r, i: F.transform(r, lambda c, j: F.struct((i + 1).alias("row"), (j + 1).alias("column"), (F.length(c) - F.length(F.regexp_replace(c, CONTROLS, ""))).alias("removed_count"))))
    return F.filter(F.flatten(cells), lambda x: x["removed_count"] > 0)


def _markdown_line(row: Column) -> Column:
    flat = F.transform(row, lambda c: F.replace(F.regexp_replace(c, r"\r\n|\r|\n", " "), F.lit("|"), F.lit("\\|")))
    return F.concat(F.lit("| "), F.array_join(flat, " | "), F.lit(" |"))


def markdown(rows: Column) -> Column:
    """A table as Markdown, its first row as header; nothing for no rows."""

    def told(t: Column) -> Column:
        head = F.try_element_at(t, F.lit(1))
        rule = F.concat(F.lit("| "), F.array_join(F.transform(head, lambda _: F.lit("---")), " | "), F.lit(" |"))
        body = F.transform(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), _markdown_line)
        return F.when(F.size(t) > 0, F.array_join(F.concat(F.array(_markdown_line(head), rule), body), "\n")).otherwise("")

    return let(rows, told)


def page_markdown(parts: Column) -> Column:
    """Parts of a page ``(y, x, kind, content)`` in reading order; tables and images stand between blank lines."""
    block = lambda p: p["kind"].isin("TABLE", "IMAGE")
    told = F.filter(F.array_sort(parts), lambda p: F.trim(empty_if_null(p["content"])) != "")
    pieces = F.transform(
        told,
        lambda p, i: F.concat(
            F.when(i == 0, "").when(block(p) | block(F.element_at(told, F.greatest(i, F.lit(1)).cast("int"))), "\n\n").otherwise("\n"), F.trim(p["content"])
        ),
    )
    return F.array_join(pieces, "")


def canonical_cell(cell: Column) -> Column:
    return F.lower(F.regexp_replace(compact_cell(cell), r"[^가-힣A-Za-z0-9%]+", ""))


def shape_fingerprint(rows: Column) -> Column:
    """Canonical cells with the table's shape."""
    told = F.array_join(F.transform(rows, lambda r: F.array_join(F.transform(r, canonical_cell), "\x1f")), "\x1e")
    return F.concat(F.size(rows).cast("string"), F.lit("x"), width(rows).cast("string"), F.lit(":"), told)


def text_fingerprint(rows: Column) -> Column:
    """Canonical cells without the shape."""
    return F.array_join(F.transform(F.flatten(rows), canonical_cell), "")


def metrics(rows: Column) -> Column:
    """Seven counters of a table."""
    cells = F.filter(F.transform(F.flatten(rows), compact_cell), lambda c: c != "")
    filled = F.transform(rows, lambda r: F.size(F.filter(r, lambda c: compact_cell(c) != "")))
    count = lambda test: F.size(F.filter(cells, test))
    return F.struct(
        F.size(rows).alias("row_count"),
        width(rows).alias("column_count"),
        F.size(cells).alias("nonempty_cell_count"),
        F.size(F.filter(filled, lambda n: n >= 2)).alias("multi_cell_row_count"),
        count(lambda c: c.rlike(r"(?U)\d|%|％")).alias("value_cell_count"),
        count(lambda c: F.length(c) >= LONG_CELL).alias("long_text_cell_count"),
        count(lambda c: c.rlike("[:：?？]")).alias("relation_cell_count"),
    )


def assess(rows: Column, m: Column, bottom: Column | None = None, page_height: Column | None = None) -> Column:
    """``status, reason`` of a clean table with metrics ``m``; the first rule that applies decides."""
    cells = F.filter(F.transform(F.flatten(rows), compact_cell), lambda c: c != "")
    signal = (m["value_cell_count"] + m["long_text_cell_count"] + m["relation_cell_count"]) > 0
    headers = F.forall(cells, lambda c: canonical_cell(c).isin(*HEADER_WORDS))
    letters = (F.size(cells) >= 3) & ~signal & F.forall(cells, lambda c: F.length(c) == 1)
    low = F.lit(False) if bottom is None or page_height is None else F.coalesce((page_height > 0) & (bottom / page_height >= PAGE_END), F.lit(False))
    rules = [
        (F.size(cells) == 0, "REJECTED", "EMPTY_TABLE"),
        (F.size(cells) == 1, "REJECTED", "SINGLE_CELL_LAYOUT"),
        ((m["row_count"] == 1) & ~signal & headers, "REJECTED", "HEADER_ONLY"),
        (m["row_count"] == 1, "FRAGMENT", "SINGLE_ROW_DATA_FRAGMENT"),
        ((m["column_count"] == 1) & letters, "FRAGMENT", "SPLIT_TEXT_FRAGMENT"),
        (m["column_count"] == 1, "FRAGMENT", "ONE_COLUMN_FRAGMENT"),
        (low & ~signal, "FRAGMENT", "HEADER_FRAGMENT_NEAR_PAGE_END"),
        (m["value_cell_count"] > 0, "MEANINGFUL", "VALUE_TABLE"),
    ]
    return F.struct(
        F.coalesce(*[F.when(test, status) for test, status, _ in rules], F.lit("MEANINGFUL")).alias("status"),
        F.coalesce(*[F.when(test, reason) for test, _, reason in rules], F.lit("STRUCTURED_TEXT_TABLE")).alias("reason"),
    )


def representation(rows: Column, nested: Column) -> Column:
    """How a table is best rebuilt: as prose with bullets if it is nested, has many blank cells or a very long one."""
    cells = F.flatten(rows)
    blank = F.size(F.filter(cells, lambda c: compact_cell(c) == "")) / F.nullif(F.size(cells), F.lit(0))
    longest = F.array_max(F.transform(cells, lambda c: F.length(compact_cell(c))))
    structured = nested | F.coalesce(blank >= EMPTY_SHARE, F.lit(False)) | F.coalesce(longest >= LONGEST_CELL, F.lit(False))
    return F.when(structured, "STRUCTURED_MARKDOWN").otherwise("MARKDOWN_TABLE")


def area(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box[2] - box[0]) * F.greatest(F.lit(0.0), box[3] - box[1])


def contains_box(outer: Column, inner: Column, slack: float = 1.0) -> Column:
    return (outer[0] - slack <= inner[0]) & (outer[1] - slack <= inner[1]) & (outer[2] + slack >= inner[2]) & (outer[3] + slack >= inner[3])


def overlap_share(a: Column, b: Column) -> Column:
    """The common area as a share of the smaller box."""
    common = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    smaller = F.least(area(a), area(b))
    return F.when(smaller > 0, common / smaller).otherwise(0.0)
