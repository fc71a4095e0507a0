"""One job for all sites: payloads and the rule table in, product versions with their documents out."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import or_
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.dates import is_open_ended, parse_date, parse_period
from corvane.functions.documents import collected
from corvane.functions.text import clean, let, link_of
from corvane.operators.ordering import first_wins
from corvane.rules.cells import payload_rows
from corvane.rules.sites import site_rules

#: How sites call the two states, and what version keys end in.
ON_SALE, ENDED, OPENED = "판매중", "판매중지", "_판매개시"
VERSION = ("ingest_seq", "row_no", "company", "product_name_raw", "product_category", "source_product_id", "sale_status", "sale_start_date", "sale_end_date", "disclosure_date", "version_key", "source_page_url")
_CELLS = "map<string,string>"


def _cell(name: Column) -> Column:
    """What a row says under a name, or else its payload's context; blank is null."""
    own = F.coalesce(F.nullif(F.trim(F.try_element_at("cells", name)), F.lit("")), F.nullif(F.trim(F.try_element_at("context", name)), F.lit("")))
    return own


def _ruled(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows with the columns of their rule. These are the same for all rows of a site, so they are joined where they are used."""
    return rows.join(rules.drop("rows"), ["company", "variant"])


def _once(rows: DataFrame, /, **columns: Column) -> DataFrame:
    """Rows with columns that are computed once, however often they are used: Spark takes no explode apart and moves no filter below it."""
    kept = [c for c in rows.columns if c not in columns]
    made = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return rows.select(*kept, F.explode_outer(made).alias("_made")).select(*kept, *[F.col(f"_made.{name}").alias(name) for name in columns])


def _captured(text: Column, pattern: Column) -> Column:
    return F.call_function("regexp_extract", text, pattern, F.lit(1))


def _first(names: Column) -> Column:
    return F.get(F.filter(F.transform(names, _cell), lambda v: v.isNotNull()), F.lit(0))


def _filled(names: Column) -> Column:
    """Values of the cells that are filled; "a|b" is the first filled of two."""
    return F.filter(F.transform(names, lambda n: _first(F.split(n, r"\|"))), lambda v: v.isNotNull())


def _read(payloads: DataFrame, rules: DataFrame) -> DataFrame:
    """Each payload with its rule and its rows (null if they can't be read)."""
    empty = F.create_map().cast(_CELLS)
    told = payloads.select("ingest_seq", "company", F.coalesce("context", empty).alias("context"), "body").withColumn("variant", F.coalesce(F.try_element_at("context", F.lit("variant")), F.lit("")))
    known = told.join(rules.withColumnRenamed("rows", "rows_at"), ["company", "variant"])
    return known.withColumn("rows", payload_rows(F.col("form"), F.col("body"), F.col("rows_at"), F.col("head"), F.col("zipped"), F.col("inner"))).drop("body")


def unread_payloads(payloads: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """``ingest_seq, company, reason`` of payloads that no rule is for or whose rows can't be read; a caller stops if there are any."""
    rules = rules if rules is not None else site_rules(payloads.sparkSession)
    unread = _read(payloads, rules).where("rows is null").select("ingest_seq", "company", F.lit("UNREADABLE").alias("reason"))
    variant = F.coalesce(F.try_element_at("context", F.lit("variant")), F.lit("")).alias("variant")
    strange = payloads.select("ingest_seq", "company", variant).join(rules.select("company", "variant"), ["company", "variant"], "left_anti")
    return unread.union(strange.select("ingest_seq", "company", F.lit("NO_RULE").alias("reason")))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _filled_down(lists: pd.Series) -> pd.Series:
    """Lists in which each null has become the last value before it."""
    return pd.Series([None if x is None else list(accumulate(x, lambda last, v: last if v is None else v)) for x in lists], dtype="object")


def _rows(payloads: DataFrame, rules: DataFrame) -> DataFrame:
    """A row for each row of a payload, ``ingest_seq, row_no, company, variant, context, cells``; the carried cells are those of the rows above, rows that only are titles or lack cells go.

    A payload's rows are together in one value, so cells are carried down there, without a shuffle.
    """

    def own(cells: Column, i: int) -> Column:
        return F.nullif(F.trim(F.try_element_at(cells, F.get("carried", i))), F.lit(""))

    def is_title(cells: Column) -> Column:
        return F.coalesce(F.try_element_at(cells, F.get("title", 0)) == F.get("title", 1), F.lit(False))

    def told(i: int) -> Column:
        return F.transform("rows", lambda r: F.when((F.size("title") == 0) | is_title(r), own(r, i)))

    read = _once(_read(payloads, rules), rows=F.col("rows"))
    down = [_filled_down(F.when(F.size("carried") > i, told(i))) for i in range(2)]
    read = read.select("ingest_seq", "company", "variant", "context", "carried", "title", "least_cells", "rows", *[F.coalesce(d, F.array().cast("array<string>")).alias(f"down{i}") for i, d in enumerate(down)])
    numbered = F.transform(F.arrays_zip("rows", "down0", "down1"), lambda r, i: F.struct((i + 1).cast("int").alias("no"), r["rows"].alias("cells"), r["down0"].alias("down0"), r["down1"].alias("down1")))
    each = read.select("*", F.explode_outer(numbered).alias("_row")).where("_row is not null").withColumn("cells", F.col("_row.cells"))
    each = each.where((F.coalesce(F.try_element_at("cells", F.lit("#cells")).cast("int"), F.lit(1 << 30)) >= F.col("least_cells")) & ((F.size("carried") == 0) | ~is_title(F.col("cells"))))
    entries = F.filter(F.array(*[F.struct(F.get("carried", i).alias("key"), F.coalesce(own(F.col("cells"), i), F.col(f"_row.down{i}")).alias("value")) for i in range(2)]), lambda e: e["key"].isNotNull())
    cells = F.map_concat(F.map_filter("cells", lambda k, _: ~F.array_contains(F.col("carried"), k)), F.map_from_entries(entries))
    return each.select("ingest_seq", F.col("_row.no").alias("row_no"), "company", "variant", "context", F.when(F.size("carried") == 0, F.col("cells")).otherwise(cells).alias("cells"))


def _dated(rows: DataFrame) -> DataFrame:
    def day(names: Column) -> Column:
        text = _first(names)
        return F.when(F.col("cut") > 0, F.substr(text, F.lit(1), F.col("cut"))).otherwise(text)

    told = _once(rows, _period=clean(_first(F.col("period"))), _start=day(F.col("start")), _end=day(F.col("end")))
    told = _once(told, _p=parse_period(F.col("_period")))
    return _once(told, sale_start_date=F.coalesce(F.col("_p.start"), parse_date(F.col("_start"))), sale_end_date=F.coalesce(F.col("_p.end"), parse_date(F.col("_end"))), disclosure_date=parse_date(day(F.col("disclosed"))))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _joined_urls(base: pd.Series, links: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [None if v is None else urljoin(b or "", v) for v in x] for b, x in zip(base, links, strict=True)], dtype="object")


def _told_documents(rows: DataFrame) -> DataFrame:
    """Rows with ``told``: what their rule's documents tell in order, ``spec`` (a place in ``docs``), ``own`` (the cell), ``value`` and ``absolute`` (the value's whole address, where it is resolved)."""
    none = F.array().cast("array<struct<spec:int,own:string,value:string>>")

    def of_cell(spec: Column, at: Column, own: Column) -> Column:
        marked = F.get(F.split(_cell(own), r"\^"), F.lit(0))
        value = F.when(spec["of"] == "", _cell(own)).when(spec["of"] == "marked", marked).otherwise(_cell(F.concat(own, F.lit("@"), spec["of"])))
        several = let(value, lambda v: F.when(spec["lines"], F.split(v, r"\r\n|\r|\n")).otherwise(F.array(v)))
        each = F.transform(several, lambda v: F.struct(at.cast("int").alias("spec"), own.alias("own"), F.nullif(F.trim(v), F.lit("")).alias("value")))
        page = lambda v: F.coalesce((spec["of"] == "marked") & F.endswith(F.lower(v), F.lit(".html")), F.lit(False))
        return F.coalesce(F.filter(each, lambda d: d["value"].isNotNull() & (d["value"] != "-") & ~page(d["value"])), none)

    def of_spec(spec: Column, at: Column) -> Column:
        pattern = F.substring(spec["cell"], 2, 1000)
        names = F.when(F.startswith(spec["cell"], F.lit("~")), F.array_sort(F.filter(F.map_keys("cells"), lambda k: F.regexp_like(k, pattern)))).otherwise(F.array(spec["cell"]))
        return F.flatten(F.transform(names, lambda own: of_cell(spec, at, own)))

    rows = _once(rows, told=F.coalesce(F.flatten(F.transform("docs", of_spec)), none))
    resolves = lambda d: F.coalesce(F.get(F.get("docs", d["spec"])["url"], F.lit(0)) == "^", F.lit(False))
    rows = _once(rows, _links=F.transform("told", lambda d: F.when(resolves(d), link_of(d["value"]))))
    joined = _joined_urls(F.col("base"), F.when(F.exists("_links", lambda x: F.coalesce(x["relative"], F.lit(False))), F.transform("_links", lambda x: F.when(x["relative"], x["link"]))))
    rows = rows.withColumn("_joined", joined)
    return rows.withColumn("told", F.transform("told", lambda d, i: F.struct(d["spec"], d["own"], d["value"], let(F.get("_links", i), lambda x: F.when(x["relative"], F.get("_joined", i)).otherwise(x["link"])).alias("absolute")))).drop("_links", "_joined")


def _document(d: Column, spec: Column) -> Column:
    """The document that a place tells of, its call's arguments, and whether it is one that is collected."""
    value, own = d["value"], d["own"]

    def encoded(text: Column) -> Column:
        out = F.url_encode(text)
        for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
            out = F.replace(out, F.lit(a), F.lit(b))
        return out

    def piece(p: Column) -> Column:
        kind, rest = F.substring(p, 1, 1), F.substring(p, 2, 1000)
        whole = F.startswith(value, F.lit("http"))
        stamp = F.date_format(F.timestamp_millis(F.try_to_number(value, F.lit("99999999999999999")).cast("long")), "yyyy/MMdd")
        return (
            F.when(p == "$", value).when(p == "%", encoded(value)).when(p == "+", F.when(whole, value).otherwise(F.concat("base", value))).when(p == "^", d["absolute"]).when(p == "@stamp", stamp)
            .when(kind == "$", _cell(rest)).when(kind == "%", encoded(_cell(rest))).when((kind == "&") & F.regexp_like(rest, F.lit(r"^arg\d+$")), _cell(F.concat(own, F.lit("@"), rest))).otherwise(p)
        )

    def written(pieces: Column) -> Column:
        return let(F.transform(pieces, piece), lambda parts: F.when((F.size(parts) > 0) & F.forall(parts, lambda p: F.coalesce(p, F.lit("")) != ""), F.array_join(parts, "")).otherwise(""))

    file, label = spec["file"], spec["label"]
    parameter = _captured(value, F.concat(F.lit(r"[?&]"), F.regexp_replace(file, r"^\?+", ""), F.lit("=([^&]*)")))
    named = (
        F.when(file == "whole", value).when(file == "none", "").when(file == "after", F.regexp_replace(value, "^[^_]*_", "")).when(file == "text", _cell(own))
        .when(file == "pdf", F.concat(value, F.lit(".pdf"))).when(F.startswith(file, F.lit("??")), F.coalesce(F.try_url_decode(parameter), parameter)).when(F.startswith(file, F.lit("?")), parameter).otherwise(F.try_element_at(F.split(value, "/"), F.lit(-1)))
    )
    labelled = F.when(label == "=head", own).when(label == "=", F.coalesce(_cell(F.concat(own, F.lit("@label"))), F.lit(""))).otherwise(label)
    argument = F.when(F.get("product_id", 0) == "argument", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: _cell(F.concat(own, F.lit("@arg"), i.cast("string")))))

    def typed(x: Column) -> Column:
        said = F.struct(collected(x["label"], x["file"]).alias("document_type"), x["label"].alias("document_label"), x["url"].alias("document_url"), x["file"].alias("original_filename"), x["hint"].alias("source_locator"))
        return F.struct(said.alias("document"), x["arguments"].alias("arguments"))

    return let(F.struct(labelled.alias("label"), F.coalesce(named, F.lit("")).alias("file"), written(spec["url"]).alias("url"), written(spec["hint"]).alias("hint"), argument.alias("arguments")), typed)


def _documents(rows: DataFrame) -> DataFrame:
    """Rows with ``_listed``, their documents that are collected, in order; all of a row's are made in it, without a shuffle."""
    is_one = lambda d: d["document_type"].isNotNull() & ((d["document_url"] != "") | (d["source_locator"] != ""))
    return _once(_told_documents(rows), _listed=F.filter(F.transform("told", lambda d: _document(d, F.get("docs", d["spec"]))), lambda x: is_one(x["document"]))).drop("told")


def site_versions(payloads: DataFrame, rules: DataFrame | None = None) -> DataFrame:
    """``payloads(ingest_seq, company, context map<string,string>, body)`` of any sites -> product versions with ``documents``.

    A payload's context is what it was asked for: its tab's state (``tab``), names and categories found on the way (by the names that the rules use), its ``variant``.
    A row's columns, state, identity, documents follow from its company's rule alone; a new site is a new row of the rule table. Rows keep their payload's number and their place in
    it (from 1). Payloads that can't be read give no rows here, see ``unread_payloads``. Null contexts are empty.

    Only versions of sites whose rule says what makes two rows the same meet each other; all others are made from their payload where it lies, and nothing is shuffled or stored.
    """
    rules = rules if rules is not None else site_rules(payloads.sparkSession)
    told = _versions(payloads, F.broadcast(rules.where(F.size("identity") == 0))).select(*VERSION, "documents")
    known = [r[0] for r in rules.where(F.size("identity") > 0).select("company").distinct().collect()]
    if not known:
        return told
    # Equalities, not a list: Spark sees from them if none of these companies can occur, and then leaves the whole branch out.
    some = reduce(or_, [F.col("company") == c for c in known])
    return told.unionByName(_identified(_versions(payloads.where(some), F.broadcast(rules.where(F.size("identity") > 0)))))


def _versions(payloads: DataFrame, rules: DataFrame) -> DataFrame:
    """All rows that have what their rule requires, with what identifies them."""
    rows = _dated(_documents(_ruled(_rows(payloads, rules), rules)))
    rows = _once(rows, documents=F.transform("_listed", lambda d: d["document"]))
    how, names = F.get("product_id", 0), F.slice("product_id", 2, 10)
    urls = F.filter(F.transform("documents", lambda d: _captured(d["document_url"], F.coalesce(F.get("product_id", 1), F.lit("()")))), lambda x: x != "")
    arguments = F.filter(F.transform("_listed", lambda d: F.get(d["arguments"], F.substring(F.coalesce(F.get("product_id", 1), F.lit("arg0")), 4, 2).try_cast("int"))), lambda x: x.isNotNull())
    product = (
        F.when(how == "first", _first(names)).when(how == "joined", F.array_join(_filled(names), "_")).when(how == "all", F.array_join(F.transform(names, lambda n: F.coalesce(_cell(n), F.lit(""))), "|"))
        .when(how == "file", F.get(F.transform("documents", lambda d: d["original_filename"]), F.lit(0))).when(how == "link", F.get(urls, F.lit(0))).when(how == "last_link", F.try_element_at(urls, F.lit(-1))).when(how == "argument", F.get(arguments, F.lit(0)))
        .when(how == "context_link", _captured(_cell(F.get(names, 0)), F.coalesce(F.get(names, 1), F.lit("()"))))
    )
    rule, flag, tab = F.get("state", 0), _cell(F.get("state", 1)), F.coalesce(F.try_element_at("context", F.lit("tab")), F.lit(""))
    ended, open_end = F.col("sale_end_date").isNotNull(), is_open_ended(F.col("_end"))

    def either(on_sale: Column) -> Column:
        return F.when(F.coalesce(on_sale, F.lit(False)), ON_SALE).otherwise(ENDED)

    state = (
        F.when(rule == "tab", tab).when(rule == "fixed", F.get("state", 1)).when(rule == "text", F.coalesce(flag, F.lit(ON_SALE))).when(rule == "open", either(~ended)).when(rule == "flag", either(flag == "1"))
        .when(rule == "flag_end", F.when(flag == "1", ON_SALE).when(flag == "2", ENDED).otherwise(either(open_end))).when(rule == "yes_open", either((flag == "Y") & ~ended)).otherwise(F.when(ended, ENDED).otherwise(tab))
    )
    undated = F.when(F.endswith("undated", F.lit("_")), F.concat("undated", F.col("row_no").cast("string"))).otherwise(F.col("undated"))
    told = _once(rows, **{
        "product_name_raw": _first(F.col("name")), "product_category": F.array_join(_filled(F.col("category")), " / "), "source_product_id": F.coalesce(product, F.lit("")), "sale_status": state,
        "version_key": F.coalesce(F.concat(F.date_format("sale_start_date", "yyyyMMdd"), F.lit(OPENED)), undated), "source_page_url": F.concat("base", "page"),
    })
    columns = ("product_name_raw", "product_category", "source_product_id", "sale_start_date", "sale_end_date")
    values = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(c).alias("key"), F.nullif(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns], F.struct(F.lit("period").alias("key"), F.nullif(F.col("_period"), F.lit("")).alias("value"))), lambda e: e["value"].isNotNull()))
    told = told.withColumn("_values", values).withColumn("_whole", F.forall("required", lambda c: F.map_contains_key(F.col("_values"), c)))
    return _once(told, documents=F.when(F.col("_whole"), F.col("documents"))).where("documents is not null")


def _identified(told: DataFrame) -> DataFrame:
    """The first of the rows that agree in what identifies them."""
    agreed = F.transform("identity", lambda c: F.coalesce(F.try_element_at("_values", c), _cell(c)))
    signature = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("cells"))))
    key = F.when(F.exists(agreed, lambda v: v.isNotNull()), F.to_json(F.transform(agreed, lambda v: F.coalesce(v, F.lit(""))))).otherwise(signature)
    keyed = told.select("company", key.alias("_key"), F.struct("ingest_seq", "row_no").alias("_order"), *[c for c in VERSION if c != "company"], "documents")
    return first_wins(keyed, ["company", "_key"], "_order").select(*VERSION, "documents")
