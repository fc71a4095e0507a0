"""Keys of versions and documents."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.text import canonical_json, clean, empty_if_null

#: Fixed values of the key format.
PAYLOAD_VERSION, KEY_VERSION, KEY_DIGITS = 2, 4, 10
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
PRODUCT_PREFIX, DOCUMENT_PREFIX = "PROD_VER_", "DOC_"
PRODUCT_KEY = f"^{PRODUCT_PREFIX}[0-9A-Za-z]{{{KEY_DIGITS}}}$"
DOCUMENT_KEY = f"^{DOCUMENT_PREFIX}[0-9A-Za-z]{{{KEY_DIGITS}}}$"
#: How many keys there are, and two digits at a time.
_KEYS, _PAIRS = 62**KEY_DIGITS, [a + b for a in DIGITS for b in DIGITS]
SHA256 = "^[0-9a-f]{64}$"


def short_key(kind: str, payload: dict) -> str:
    """Ten digits of base 62 from the BLAKE2b digest of a canonical payload."""
    digest = hashlib.blake2b(canonical_json({"kind": kind, "payload": payload}).encode(), digest_size=32).digest()
    number = int.from_bytes(digest, "big") % _KEYS
    out = []
    for _ in range(KEY_DIGITS // 2):
        number, last = divmod(number, 3844)
        out.append(_PAIRS[last])
    return "".join(reversed(out))


@F.pandas_udf(T.StringType())
def _version_bodies(parts: pd.DataFrame) -> pd.Series:
    names = list(parts.columns)
    rows = zip(*(parts[c] for c in names), strict=True)
    return pd.Series([short_key("product_version", {"identity_version": PAYLOAD_VERSION, **dict(zip(names, r, strict=True))}) for r in rows], dtype=object)


@F.pandas_udf(T.StringType())
def _document_bodies(parent: pd.Series, identity: pd.Series) -> pd.Series:
    return pd.Series([short_key("document", {"product_version_key": p, "document_identity": i}) for p, i in zip(parent, identity, strict=True)], dtype=object)


def product_version_key(company: Column, product_id: Column, name: Column, sale_start: Column, target: Column, page_url: Column) -> Column:
    """The key of a product version; kinds of documents, states and paths don't enter."""
    parts = {"company_code": company, "source_product_id": product_id, "product_name": name, "sale_start_date": sale_start, "target_date": target, "source_page_url": page_url}
    return F.concat(F.lit(PRODUCT_PREFIX), _version_bodies(F.struct(*[clean(c).alias(n) for n, c in parts.items()])))


def document_identity(checkpoint: Column, company: Column, product_id: Column, name: Column, target: Column, document_type: Column, locator: Column, url: Column, filename: Column) -> Column:
    """What tells documents apart, texts untrimmed: a checkpoint key, or six parts with the first locator there is."""
    where = F.coalesce(*[F.nullif(empty_if_null(c), F.lit("")) for c in (locator, url, filename)], F.lit(""))
    composed = F.concat_ws("|", *[empty_if_null(c) for c in (company, product_id, name, target, document_type)], where)
    return F.when(empty_if_null(checkpoint) != "", F.concat(F.lit("PLAN|"), checkpoint)).otherwise(composed)


def document_key(version_key: Column, identity: Column) -> Column:
    """The key of a document from that of its version; a version key of a wrong form fails the job."""
    body = F.substring(version_key, len(PRODUCT_PREFIX) + 1, KEY_DIGITS)
    checked = F.when(version_key.rlike(PRODUCT_KEY), body).otherwise(F.raise_error(F.concat(F.lit("not a version key: "), empty_if_null(version_key))))
    return F.concat(F.lit(DOCUMENT_PREFIX), _document_bodies(checked, identity))


def logical_key(company: Column, product_id: Column, sale_start: Column, target: Column, name: Column) -> Column:
    """The key that states are kept by: all documents of a version share it."""
    return F.concat_ws("|", *[F.trim(empty_if_null(c)) for c in (company, product_id, sale_start, target, name)])


def plan_identity(company: Column, storage: Column, product_id: Column, name: Column, target: Column, sale_start: Column, version: Column, document_type: Column, url: Column, filename: Column, hint: Column) -> Column:
    """What makes a plan item one and the same; states and ends of sale don't enter. ``hint`` is canonical JSON."""
    where = F.coalesce(F.nullif(empty_if_null(url), F.lit("")), empty_if_null(filename))
    parts = [empty_if_null(c) for c in (company, storage, product_id, name, target, sale_start, version, document_type)]
    return F.concat_ws("|", *parts, where, F.coalesce(F.nullif(empty_if_null(hint), F.lit("")), F.lit("{}")))


def plan_key(identity: Column) -> Column:
    return F.sha2(identity, 256)


def content_key(body: Column) -> Column:
    return F.sha2(body, 256)


def row_key(row_id: Column, *columns: Column) -> Column:
    """A list row's own id, else a signature of all its values."""
    return F.when(empty_if_null(row_id) != "", F.concat(F.lit("seq:"), row_id)).otherwise(F.concat(F.lit("row:"), F.to_json(F.struct(*columns))))


def detail_key(ids: list[Column], values: list[Column]) -> Column:
    """The first id that is there, else all values joined."""
    return F.coalesce(*[F.nullif(empty_if_null(c), F.lit("")) for c in ids], F.concat_ws("|", *[empty_if_null(v) for v in values]))


def folder_digests(files: DataFrame) -> DataFrame:
    """``files(folder, path, sha256)`` -> ``folder, files, digest``: equal for folders that hold the same files at the same relative paths.

    A folder is one document's, so its files are listed in one row.
    """
    inside = F.substring(F.col("path"), F.length("folder") + 2, F.length("path"))
    lines = F.array_sort(F.collect_list(F.struct(inside.alias("path"), F.col("sha256"))))
    return files.groupBy("folder").agg(F.count("*").alias("files"), F.sha2(F.array_join(F.transform(lines, lambda f: F.concat(f["path"], F.lit("\t"), f["sha256"])), "\n"), 256).alias("digest"))


def stored_files(spark: SparkSession, root: str, depth: int = 1) -> DataFrame:
    """Files below a folder with their content digests: ``folder`` (the first ``depth`` levels), ``path`` and ``sha256``."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    below = F.regexp_extract("path", rf"{re.escape(root.removeprefix('file:').rstrip('/'))}/(.*)$", 1)
    return read.select(F.substring_index(below, "/", depth).alias("folder"), below.alias("path"), F.sha2("content", 256).alias("sha256"))
