"""Rows of list payloads as maps from cells' names to texts, whatever their form."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.text import let, split_arguments
from corvane.sources.payloads import _unescaped

_CELLS = "map<string,string>"
_ROWS = f"array<{_CELLS}>"
#: What sites add to the labels of their links.
DECORATIONS = ("새창열림_", "PDF보기", "PDF 보기")


class _Rows(HTMLParser):
    """Rows of a page's tables: a cell's text, and of its links the address, the arguments of a call and the label."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[dict] = []
        self.open: list[dict] = []
        self.row: dict | None = None
        self.cell: dict | None = None
        self.link: dict | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        told = {k: v or "" for k, v in attrs}
        if tag == "table":
            self.close_row()
            self.open.append({"heads": [], "rows": []})
            self.tables.append(self.open[-1])
        elif tag == "tr" and self.open:
            self.close_row()
            self.row = {"th": [], "td": []}
        elif tag in ("td", "th") and self.row is not None:
            self.close_cell()
            self.cell = {"kind": tag, "text": [], "links": [], "button": False}
        elif self.cell is not None:
            if tag == "a":
                self.link = {"href": told.get("href", "").strip().strip("'\""), "call": told.get("onclick") or told.get("href", ""), "label": told.get("title", ""), "text": []}
                self.cell["links"].append(self.link)
            elif tag == "img" and self.link is not None and told.get("alt"):
                self.link["label"] = told["alt"]
            elif tag == "button":
                self.cell["button"] = True

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self.link = None
        elif tag in ("td", "th"):
            self.close_cell()
        elif tag == "tr":
            self.close_row()
        elif tag == "table" and self.open:
            self.close_row()
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell["text"].append(data)
            if self.link is not None:
                self.link["text"].append(data)

    def close_cell(self) -> None:
        if self.cell is not None and self.row is not None:
            self.row[self.cell["kind"]].append(self.cell)
        self.cell = self.link = None

    def close_row(self) -> None:
        self.close_cell()
        if self.row is not None and self.open:
            if self.row["td"]:
                self.open[-1]["rows"].append(self.row)
            else:
                self.open[-1]["heads"] += [_text(c["text"]) for c in self.row["th"]]
        self.row = None


def _text(parts: list[str]) -> str:
    return " ".join("".join(parts).split())


def _told(name: str, cell: dict, out: dict[str, str]) -> None:
    out[name] = _text(cell["text"])
    for i, link in enumerate(cell["links"]):
        own = name if not i else f"{name}+{i}"
        out.setdefault(own, _text(link["text"]))
        label = link["label"] or _text(link["text"])
        for extra in DECORATIONS:
            label = label.replace(extra, "")
        out[f"{own}@label"] = label.strip()
        if link["href"] and not link["href"].lower().startswith("javascript"):
            out[f"{own}@href"] = link["href"]
        called = link["call"].split("(", 1)[0].removeprefix("javascript:").split()
        for n, argument in enumerate(split_arguments(link["call"], called[-1]) if called and "(" in link["call"] else []):
            out[f"{own}@arg{n}"] = argument


def page_rows(page: str | None, head: int | None) -> list[dict[str, str]]:
    """Rows of a page's tables as cells by place ("td0", "th0") and by header, aligned to the right where a span shortens them.

    With ``head``, a row of so many cells begins with the cell "head", and places count from the next; so does a row of one cell and a button.
    """
    parser = _Rows()
    parser.feed(page or "")
    parser.close()
    out = []
    for number, table in enumerate(parser.tables):
        for row in table["rows"]:
            cells, told = row["td"], {"#table": str(number)}
            for i, cell in enumerate(row["th"]):
                _told(f"th{i}", cell, told)
            short = len(table["heads"]) - len(cells)
            if 0 <= short:
                for name, cell in zip(table["heads"][short:], cells, strict=True):
                    _told(name, cell, told)
            if head and len(cells) == 2 and cells[1]["button"]:
                _told("head", cells[0], told)
                cells = []
            elif head and len(cells) >= head:
                if _text(cells[0]["text"]):
                    _told("head", cells[0], told)
                cells = cells[1:]
            for i, cell in enumerate(cells):
                _told(f"td{i}", cell, told)
            out.append({k: v for k, v in told.items() if k} | {"#cells": str(len(cells))})
    return out


@F.pandas_udf(T.ArrayType(T.MapType(T.StringType(), T.StringType())))
def _html(pages: pd.Series, heads: pd.Series) -> pd.Series:
    return pd.Series([None if page is None else page_rows(page, head) for page, head in zip(pages, heads, strict=True)], dtype="object")


def _json(body: Column, path: Column) -> Column:
    """A list of objects; a lone object is a list of one, anything else null."""
    found = F.call_function("get_json_object", body, F.concat(F.lit("$."), path))
    listed = let(found, lambda f: F.when(F.startswith(f, F.lit("{")), F.concat(F.lit("["), f, F.lit("]"))).when(F.startswith(f, F.lit("[")), f))
    return let(F.from_json(listed, _ROWS), lambda rows: F.when(F.forall(rows, lambda r: r.isNotNull()), rows))


def _leaves(xml: Column, upper: bool) -> Column:
    """Elements without elements inside, as names and texts, prefixes gone; their attributes don't count."""
    pattern = r"(?s)<(?:\w+:)?(\w+)(?:\s[^<>]*)?(?:/>|>(?:<!\[CDATA\[.*?\]\]>|[^<]*)</(?:\w+:)?\1\s*>)"

    def leaf(x: Column) -> Column:
        name, inside = F.regexp_extract(x, r"^<(?:\w+:)?(\w+)", 1), F.regexp_extract(x, r"(?s)^<[^>]*>(.*)</[^<]*$", 1)
        plain = F.when(F.startswith(inside, F.lit("<![CDATA[")), F.regexp_extract(inside, r"(?s)^<!\[CDATA\[(.*)\]\]>$", 1)).otherwise(_unescaped(inside))
        return F.struct((F.upper(name) if upper else name).alias("name"), plain.alias("text"))

    return F.transform(F.regexp_extract_all(xml, F.lit(pattern), F.lit(0)), leaf)


def _elements(body: Column, tag: Column) -> Column:
    """Elements of a tag with children or attributes; of equal names in one the first counts."""
    def cells(x: Column) -> Column:
        inside = F.regexp_replace(x, r"(?s)^<[^>]*>", "")
        opening = F.regexp_extract(x, r"(?s)^<[^>]*>", 0)
        attribute = r'\s(?:\w+:)?(\w+)\s*=\s*"([^"]*)"'
        own = F.arrays_zip(F.transform(F.regexp_extract_all(opening, F.lit(attribute), F.lit(1)), F.upper).alias("name"), F.transform(F.regexp_extract_all(opening, F.lit(attribute), F.lit(2)), _unescaped).alias("text"))
        return _first_of_each(F.concat(own, _leaves(inside, True)))

    pattern = F.concat(F.lit(r"(?is)(<(?:\w+:)?"), tag, F.lit(r"\b[^>]*?(?:/>|>.*?</(?:\w+:)?"), tag, F.lit(r"\s*>))"))
    return F.transform(F.regexp_extract_all(body, pattern, F.lit(1)), cells)


def _names(pairs: Column) -> Column:
    return F.array_distinct(F.transform(pairs, lambda p: p["name"]))


def _first_of_each(pairs: Column) -> Column:
    def mapped(ps: Column) -> Column:
        return F.map_from_entries(F.transform(_names(ps), lambda n: F.struct(n.alias("key"), F.get(F.filter(ps, lambda p: p["name"] == n), F.lit(0))["text"].alias("value"))))

    return let(pairs, mapped)


def _columns(body: Column, lead: Column) -> Column:
    """Parallel lists, one for each tag, as rows by place; as many as the leading list has, short ones give nothing."""
    def lists(ps: Column) -> Column:
        return F.map_from_entries(F.transform(_names(ps), lambda n: F.struct(n.alias("key"), F.transform(F.filter(ps, lambda p: p["name"] == n), lambda p: p["text"]).alias("value"))))

    def rows(m: Column) -> Column:
        size = F.coalesce(F.size(F.try_element_at(m, lead)), F.lit(0))
        places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.transform_values(m, lambda _, v: F.get(v, i)))

    return F.when(F.coalesce(F.startswith(F.trim(body), F.lit("<")), F.lit(False)), let(let(_leaves(body, False), lists), rows))


def _marked(body: Column, marks: Column) -> Column:
    """Texts cut by marks: of the blocks the one of that number, of it the rows, of them the cells, named by their places."""
    part = F.split(marks, " ")
    block = F.try_element_at(F.split(body, _literally(F.get(part, 0))), F.get(part, 1).cast("int"))

    def cells(row: Column) -> Column:
        values = F.split(row, _literally(F.get(part, 3)))
        return F.map_concat(F.map_from_entries(F.transform(values, lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value")))), F.create_map(F.lit("#cells"), F.size(values).cast("string")))

    return F.transform(F.filter(F.split(block, _literally(F.get(part, 2))), lambda r: r != ""), cells)


def _literally(mark: Column) -> Column:
    return F.concat(F.lit(r"\Q"), mark, F.lit(r"\E"))


def payload_rows(form: Column, body: Column, rows: Column, head: Column, zipped: Column, inner: Column) -> Column:
    """A payload's rows in order as maps of cells; null where it isn't what its form demands, empty where it has no rows."""
    page = F.when(form == "html", body)
    empty = F.create_map().cast(_CELLS)

    def zip_second(rows: Column) -> Column:
        second = F.coalesce(_json(F.when(form == "json", body), zipped), F.array().cast(_ROWS))
        return F.when(zipped == "", rows).otherwise(let(second, lambda more: F.transform(rows, lambda r, i: _under(r, F.coalesce(F.get(more, i), empty)))))

    def open_inner(rows: Column) -> Column:
        return F.when(inner == "", rows).otherwise(F.transform(rows, lambda r: let(F.coalesce(F.from_json(F.try_element_at(r, inner), _CELLS), empty), lambda more: _under(r, more))))

    listed = let(let(_json(F.when(form == "json", body), rows), zip_second), open_inner)
    return (
        F.when(form == "json", listed).when(form == "html", _html(page, head)).when(form == "xml", F.when(F.startswith(F.trim(body), F.lit("<")) & ~F.regexp_like(body, F.lit("(?i)^\\s*(<!doctype[^>]*>\\s*)?<(html|body)\\b")), _elements(body, rows)))
        .when(form == "columns", _columns(body, rows)).when(form == "marks", _marked(body, rows))
    )


def _under(row: Column, more: Column) -> Column:
    """A row with the cells of another that it lacks."""
    return F.map_concat(row, F.map_filter(more, lambda k, _: ~F.map_contains_key(row, k)))
