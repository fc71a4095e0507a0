"""Sale states, file states and the outcome of a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corvane.functions.text import clean, empty_if_null, nfc

#: Words for a state.
ACTIVE_WORDS = ("판매중", "판매", "진행중", "정상판매", "active", "open", "ongoing", "y", "yes", "true", "1")
ENDED_WORDS = (
    "판매중지", "판매중단", "판매종료", "판매완료", "판매중지됨", "판매중단됨", "판매종료됨", "종료", "중지",
    "ended", "closed", "discontinued", "inactive", "n", "no", "false", "0",
)
STATES = ("ACTIVE", "ENDED", "UNKNOWN")
PREFIXES = {"ACTIVE": "판매중__", "ENDED": "판매완료__", "UNKNOWN": "상태미상__"}
#: Download states that may be tried again, those that are done, and states of files.
RETRYABLE = ("INVALID_RESPONSE", "INVALID_FILE", "DOWNLOAD_FAILED", "ACCESS_DENIED")
COMPLETED = ("SUCCESS", "DUPLICATE_SKIPPED")
FILE_STATES = ("PENDING", "AVAILABLE", "UNAVAILABLE", "INVALID", "MANUAL_REVIEW")


def _key(raw: Column, composed: bool) -> Column:
    text = nfc(raw) if composed else raw.cast("string")
    return F.regexp_replace(F.lower(empty_if_null(text)), r"(?U)[\s\x{200b}\x{feff}]+", "")


def sale_state(raw: Column, explicit: Column | None = None, end: Column | None = None, as_of: Column | None = None, composed: bool = True) -> Column:
    """ACTIVE, ENDED or UNKNOWN: an explicit state, else the word, else ACTIVE if the end lies ahead; a past end proves nothing.

    ``composed=False`` spares the Unicode composition of raw states that are known to be composed.
    """
    given = F.upper(empty_if_null(explicit)) if explicit is not None else F.lit("")
    word = _key(F.when(explicit.isNotNull(), explicit).otherwise(raw) if explicit is not None else raw, composed)
    state = F.when(given.isin(*STATES), given).when(word.isin(*ACTIVE_WORDS), "ACTIVE").when(word.isin(*ENDED_WORDS), "ENDED")
    if end is not None:
        state = state.when(end > (as_of if as_of is not None else F.current_date()), "ACTIVE")
    return state.otherwise("UNKNOWN")


def site_state(rule: Column, flag: Column, end: Column, tab: Column) -> Column:
    """A site's raw state by its rule: ``flag`` (1 on sale, 2 not, else by the end), ``end`` (an end means not), ``tab`` (as listed)."""
    by_end = F.when(end.isNotNull(), "판매중지")
    flagged = F.when(flag == "1", "판매중").when(flag == "2", "판매중지").otherwise(F.coalesce(by_end, F.lit("판매중")))
    return F.when(rule == "flag", flagged).when(rule == "end", F.coalesce(by_end, tab)).otherwise(tab)


def state_prefix(state: Column) -> Column:
    """What the folders of a state begin with; odd states count as unknown."""
    known = F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.upper(state)), F.lit(PREFIXES["UNKNOWN"]))


def file_state(value: Column, attempt: Column) -> Column:
    """A file's state: a valid one as it is, else what the last attempt implies."""
    told, tried = F.upper(clean(value)), F.upper(clean(attempt))
    return (
        F.when(told.isin(*FILE_STATES), told)
        .when(tried.isin(*COMPLETED), "AVAILABLE")
        .when(tried == "INVALID_FILE", "INVALID")
        .when(tried.isin("UNKNOWN_DOCUMENT_TYPE", "MANUAL_REVIEW_REQUIRED"), "MANUAL_REVIEW")
        .when(tried.isin("DRY_RUN", ""), "PENDING")
        .otherwise("UNAVAILABLE")
    )


def proven_file_state(attempt: Column, path: Column, sha256: Column) -> Column:
    """The state that an attempt proves: success without a path or digest proves no file."""
    evidence = (empty_if_null(path) != "") | (empty_if_null(sha256) != "")
    return F.when((attempt == "DUPLICATE_SKIPPED") & ~evidence, "PENDING").when((attempt == "SUCCESS") & ~evidence, "UNAVAILABLE").otherwise(file_state(F.lit(""), attempt))


def only_if_available(state: Column, value: Column) -> Column:
    """Run ids and clocks of a download, which only an available file has."""
    return F.when(state == "AVAILABLE", value)


def checkpoint_state(file_status: Column, attempt: Column) -> Column:
    """The download state that a catalog row stands for when work goes on."""
    file, tried = F.upper(empty_if_null(file_status)), empty_if_null(attempt)
    done = tried.isin(*COMPLETED)
    return (
        F.when(file == "AVAILABLE", F.when(done, tried).otherwise("SUCCESS"))
        .when(file == "INVALID", "INVALID_FILE")
        .when(((file == "PENDING") & (tried == "")) | done, "DOWNLOAD_FAILED")
        .otherwise(tried)
    )


def document_outcome(target: Column, linked: Column, previous: Column, previous_file_ok: Column, document_type: Column, retry_only: bool = False, dry_run: bool = False) -> Column:
    """What becomes of a document in a run; the first rule that applies decides."""
    state = F.when(target.isNull(), "MANUAL_REVIEW_REQUIRED").when(~linked, "NO_DOCUMENT_LINK")
    state = state.when(previous.isin(*COMPLETED) & F.coalesce(previous_file_ok, F.lit(False)), "DUPLICATE_SKIPPED")
    if retry_only:
        state = state.when(~F.coalesce(previous.isin(*RETRYABLE, *COMPLETED), F.lit(False)), "DUPLICATE_SKIPPED")
    return state.when(document_type == "UNKNOWN_DOCUMENT_TYPE", "UNKNOWN_DOCUMENT_TYPE").otherwise("DRY_RUN" if dry_run else "DOWNLOAD")
