"""Paths of stored documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.documents import LABELS, UNKNOWN
from corvane.functions.status import PREFIXES, state_prefix
from corvane.functions.text import empty_if_null, fit, let, normalize_extension, split_extension, storage_name

#: Where undated versions go, the longest path, and the longest file name of a kind.
UNDATED = "날짜미상"
PATH_LIMIT = 240
FILE_NAME = max(map(len, LABELS.values())) + len(".hwpx")
DOCUMENT_ENDS = r"(?i)\.(pdf|doc|docx|hwp|txt|xlsx|xls)$"


def product_folder(product: Column, composed: bool = True) -> Column:
    """A product's name as part of a path, of any length."""
    return storage_name(F.coalesce(F.nullif(product, F.lit("")), F.lit("상품")), 10_000, composed)


def version_dir(root: Column, storage: Column, state: Column, target: Column, product: Column, composed: bool = True, stored: bool = False) -> Column:
    """The folder of a product version; the product's name is cut so that the path stays within its limit.

    ``stored``: company and product come as ``storage_name`` and ``product_folder`` give them. Names are few and versions many, so a
    job over versions does that for the distinct names first.
    """
    company = storage if stored else storage_name(storage, composed=composed)
    month = F.concat_ws("/", root, company, F.coalesce(F.date_format(target, "yyyy/MM"), F.lit(UNDATED)))
    day = F.coalesce(F.date_format(target, "yyyyMMdd"), F.lit(UNDATED))
    prefix = F.concat(state_prefix(state), day, F.lit("_"))
    name = product if stored else product_folder(product, composed)
    head = F.concat(month, F.lit("/"), prefix)
    parts = F.struct(head.alias("head"), name.alias("name"))
    return let(parts, lambda p: F.concat(p["head"], fit(fit(p["name"], 120), F.lit(PATH_LIMIT) - F.length(p["head"]) - FILE_NAME - 1)))


def file_name(document_type: Column, extension: Column, original: Column) -> Column:
    """A document's file name: what its kind is called, and the extension given or that of the original name."""
    known = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    ext = F.coalesce(F.nullif(normalize_extension(extension), F.lit("")), split_extension(original)["extension"])
    return F.concat(F.coalesce(F.try_element_at(known, document_type), F.lit(LABELS[UNKNOWN])), ext)


def target_path(folder: Column, document_type: Column, extension: Column, original: Column) -> Column:
    return F.concat(folder, F.lit("/"), file_name(document_type, extension, original))


def saved_version_dir(path: Column, filename: Column) -> Column:
    """The version's folder in the path of a stored document."""
    path = empty_if_null(path)
    parent, last = F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.element_at(F.split(path, "/"), -1)
    return F.when(((F.trim(empty_if_null(filename)) != "") & (last == F.trim(empty_if_null(filename)))) | path.rlike(DOCUMENT_ENDS), parent).otherwise(path)


def with_state_prefix(path: Column, state: Column) -> Column:
    """A folder's path with the prefix of a state in place of any other."""

    def swapped(p: Column) -> Column:
        bare = F.regexp_replace(F.element_at(F.split(p, "/"), -1), f"^({'|'.join(PREFIXES.values())})", "")
        return F.when(empty_if_null(p) == "", p).otherwise(F.concat(F.regexp_extract(p, r"^(.*/)[^/]*$", 1), state_prefix(state), bare))

    return let(path, swapped)


def moved_path(path: Column, old_dir: Column, new_dir: Column) -> Column:
    """A document's path after its version's folder was renamed: the part that is the folder's name changes."""
    name = lambda p: F.element_at(F.split(p, "/"), -1)

    def moved(x: Column) -> Column:
        at = F.array_position(x["parts"], name(x["old"]))
        parts = F.transform(x["parts"], lambda p, i: F.when(i + 1 == at, name(x["new"])).otherwise(p))
        return F.when(x["path"] == x["old"], x["new"]).when(at > 0, F.array_join(parts, "/")).otherwise(F.replace(x["path"], x["old"], x["new"]))

    told = let(path, lambda p: F.struct(p.alias("path"), F.split(p, "/").alias("parts")))
    return let(told, lambda t: let(F.struct(t["path"].alias("path"), t["parts"].alias("parts"), old_dir.alias("old"), new_dir.alias("new")), moved))
