"""Kinds of documents, by the words in their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import empty_if_null, let

#: Keywords of the kinds, kinds in order, and words of documents that are left out.
KEYWORDS = {
    "POLICY": ("약관", "보통약관", "특별약관", "보험약관", "상품약관"),
    "SUMMARY": ("상품요약서", "상품요약", "요약서", "요약"),
    "METHOD": ("사업방법서", "사업방법"),
}
EXCLUDED = ("보험료 예시", "보험료예시", "가입설계서", "핵심설명서", "비교안내서", "확인서", "안내장", "브로슈어", "상품설명서", "청약서")
UNKNOWN = "UNKNOWN_DOCUMENT_TYPE"
#: What files of a kind are called.
LABELS = {"POLICY": "약관", "SUMMARY": "상품요약서", "METHOD": "사업방법서", UNKNOWN: "미분류"}


def compact(text: Column) -> Column:
    """Lower case, without any white space."""
    return F.lower(F.regexp_replace(empty_if_null(text), r"(?U)\s+", ""))


def _squeezed(keyword: str) -> str:
    return "".join(keyword.split()).lower()


def is_excluded(text: Column) -> Column:
    """Whether a label or file name belongs to a document that is not collected."""
    return compact(text).rlike("|".join(sorted({_squeezed(k) for k in EXCLUDED})))


def classify(label: Column, filename: Column) -> Column:
    """The kind of a document: the longest keyword decides, the label before the file name."""
    rules = sorted(((_squeezed(k), kind) for kind, words in KEYWORDS.items() for k in words), key=lambda r: -len(r[0]))

    def kind_of(text: Column) -> Column:
        def told(bare: Column) -> Column:
            kind = F.when(F.lit(False), F.lit(None).cast("string"))
            for keyword, name in rules:
                kind = kind.when(bare.contains(keyword), name)
            return kind

        return let(compact(text), told)

    return F.coalesce(kind_of(label), kind_of(filename), F.lit(UNKNOWN))


def collected(label: Column, filename: Column) -> Column:
    """The kind of a document that is collected, null for one that is not."""
    return F.when(~(is_excluded(label) | is_excluded(filename)), classify(label, filename))


def has_link(url: Column, hint: Column) -> Column:
    """Whether there is anything to fetch a document by; ``hint`` is a JSON object."""
    return (empty_if_null(url) != "") | ~F.trim(empty_if_null(hint)).isin("", "{}", "null")
