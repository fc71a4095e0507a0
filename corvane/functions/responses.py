"""Checks of downloaded responses and stored files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import empty_if_null

#: First bytes of formats, hexadecimal.
MAGIC = {
    ".pdf": ("255044462D",),
    ".zip": ("504B0304", "504B0506"),
    ".hwpx": ("504B0304", "504B0506"),
    ".docx": ("504B0304", "504B0506"),
    ".hwp": ("D0CF11E0", "48575020446F63756D656E742046696C652056332E3030201A0102030405"),
    ".doc": ("D0CF11E0",),
}
#: How an HTML page begins, extensions and content types that are taken.
HTML_MARKS = ("<!doctype html", "<html", "<head", "<script", "<br>", "<meta")
#: Fixed value: the word for "blocked", UTF-8 in hexadecimal; 200 bytes may end inside a character, so they aren't decoded.
BLOCKED = "차단".encode().hex().upper()
EXTENSIONS = (".pdf", ".zip", ".hwp", ".hwpx", ".doc", ".docx")
CONTENT_TYPES = (
    "application/pdf", "application/x-pdf", "application/octet-stream", "application/haansofthwp", "application/x-hwp", "application/vnd.hancom.hwp",
    "application/vnd.hancom.hwpx", "application/msword", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/zip", "application/x-zip-compressed",
)


def _start(body: Column, n: int) -> Column:
    return F.decode(F.substring(body, 1, n), "ISO-8859-1")


def looks_like_html(body: Column) -> Column:
    """Whether the body is a page, an error page most likely."""
    head = F.lower(F.regexp_replace(_start(body, 2048), r"^[\s\x0b\x1c-\x1f]+", ""))
    return F.substring(head, 1, 512).rlike("|".join(HTML_MARKS))


def magic_ok(body: Column, extension: Column) -> Column:
    """Whether the first bytes fit the extension; unknown extensions always do."""
    first = F.hex(F.substring(body, 1, 30))
    fits = F.lit(True)
    for ext, marks in MAGIC.items():
        fits = F.when(extension == ext, first.rlike("^(" + "|".join(marks) + ")")).otherwise(fits)
    return fits


def check_response(status_code: Column, content_type: Column, extension: Column, body: Column) -> Column:
    """``ok, status, reason`` of a response; the first check that fails decides."""
    ext = F.lower(empty_if_null(extension))
    kind = F.lower(F.trim(F.element_at(F.split(empty_if_null(content_type), ";"), 1)))
    size = F.coalesce(F.octet_length(body), F.lit(0))
    blocked = F.lower(_start(body, 200)).contains("firewall") | F.hex(F.substring(body, 1, 200)).rlike(f"^(..)*{BLOCKED}")
    strange = ~kind.isin("", *CONTENT_TYPES) & ~ext.isin(*MAGIC)
    html = (size > 0) & looks_like_html(body)
    rules = [
        (status_code == 403, "ACCESS_DENIED", "HTTP 403"),
        (F.coalesce(status_code != 200, F.lit(True)), "INVALID_RESPONSE", "HTTP status"),
        (size == 0, "INVALID_FILE", "empty body"),
        (html & blocked, "ACCESS_DENIED", "firewall page"),
        (html, "INVALID_RESPONSE", "HTML page"),
        ((ext != "") & ~ext.isin(*EXTENSIONS), "INVALID_FILE", "extension"),
        (~magic_ok(body, ext), "INVALID_FILE", "signature"),
        (strange, "INVALID_RESPONSE", "content type"),
    ]
    status = F.coalesce(*[F.when(test, name) for test, name, _ in rules], F.lit(""))
    reason = F.coalesce(*[F.when(test, why) for test, _, why in rules], F.lit(""))
    return F.struct((status == "").alias("ok"), status.alias("status"), reason.alias("reason"))


def check_stored(body: Column, expected_size: Column, extension: Column) -> Column:
    """``ok, reason`` of a stored file: there, not empty, of the size expected (if any) and with the right first bytes."""
    size = F.octet_length(body)
    reason = F.coalesce(
        F.when(body.isNull(), "missing"),
        F.when(size == 0, "empty"),
        F.when((expected_size != 0) & (size != expected_size), "size"),
        F.when(~magic_ok(body, F.lower(empty_if_null(extension))), "signature"),
        F.lit(""),
    )
    return F.struct((reason == "").alias("ok"), reason.alias("reason"))
