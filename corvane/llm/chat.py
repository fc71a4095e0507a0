"""Chat formatting: records of many layouts become canonical turns, turns become one string with a loss mask.

A record's layout is known by its fingerprint, the hash of the sorted paths of its fields; a registry maps
fingerprints to declarative mappings. The template marks turns by control strings; such strings inside texts are
escaped, so that a formatted conversation can be read back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template. A turn is OPEN role MIDDLE text CLOSE; none of these occurs in an escaped text.
OPEN, MIDDLE, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings, of this template and of common others, that texts must not smuggle in.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile(rf"\\|(?={'|'.join(map(re.escape, CONTROL))}).", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_PIECES = re.compile(f"{re.escape(OPEN)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(CLOSE)}", re.DOTALL)


def escape(text: str) -> str:
    """A backslash is doubled, and one is put behind the first character of every control string, overlapping ones too."""
    return _CONTROL.sub(lambda m: f"{m[0]}\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def paths(value: object) -> set[str]:
    """Paths of the leaves of a nested record; list items share the path ``[]``, and kinds are told apart. Depth is bounded by memory only."""
    found, todo = set(), [("", value)]
    while todo:
        at, own = todo.pop()
        if isinstance(own, dict):
            todo += [(f"{at}.{k}", v) for k, v in own.items()]
            if not own:
                found.add(f"{at}:object")
        elif isinstance(own, list):
            todo += [(f"{at}[]", v) for v in own]
            if not own:
                found.add(f"{at}[]")
        else:
            found.add(at)
    return found


def fingerprint(value: object) -> str:
    return hashlib.sha256("\n".join(sorted(paths(value))).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Layout:
    """How a layout's turns are found: earlier exchanges, fixed fields in order, a list of messages.

    ``fields``: (role, fields whose non-blank texts are joined by a blank line). ``messages``: the list, and in its
    items the field of the role (none: roles alternate from user) and that of the text. ``history``: the list of earlier
    exchanges, each a list of texts whose roles alternate from user. ``verbatim``: roles are kept as they stand.
    """

    example: object
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    messages: tuple[str, str, str] | None = None
    history: str = ""
    verbatim: bool = False


#: Role names of known layouts.
ROLES = {"human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "assistant": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant", "system": "system", "tool": "tool", "function": "tool"}
_T = "text"
LAYOUTS = (
    Layout({"turns": [{"role": _T, "text": _T}]}, messages=("turns", "role", "text"), verbatim=True),
    Layout({"messages": [{"role": _T, "content": _T}]}, messages=("messages", "role", "content")),
    Layout({"conversation": [{"role": _T, "content": _T}]}, messages=("conversation", "role", "content")),
    Layout({"conversations": [{"from": _T, "value": _T}]}, messages=("conversations", "from", "value")),
    Layout({"system": _T, "conversations": [{"from": _T, "value": _T}]}, (("system", ("system",)),), ("conversations", "from", "value")),
    Layout({"system": _T, "messages": [{"role": _T, "content": _T}]}, (("system", ("system",)),), ("messages", "role", "content")),
    Layout({"dialog": [_T]}, messages=("dialog", "", "")),
    Layout({"prompt": _T, "completion": _T}, (("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout({"prompt": _T, "response": _T}, (("user", ("prompt",)), ("assistant", ("response",)))),
    Layout({"question": _T, "answer": _T}, (("user", ("question",)), ("assistant", ("answer",)))),
    Layout({"instruction": _T, "output": _T}, (("user", ("instruction",)), ("assistant", ("output",)))),
    Layout({"instruction": _T, "input": _T, "output": _T}, (("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout({"instruction": _T, "context": _T, "response": _T}, (("user", ("instruction", "context")), ("assistant", ("response",)))),
    Layout({"system_prompt": _T, "question": _T, "response": _T}, (("system", ("system_prompt",)), ("user", ("question",)), ("assistant", ("response",)))),
    Layout({"instruction": _T, "input": _T, "output": _T, "history": [[_T]]}, (("user", ("instruction", "input")), ("assistant", ("output",))), history="history"),
)
BY_FINGERPRINT = {fingerprint(x.example): x for x in LAYOUTS}
_FIELDS = {p for x in LAYOUTS for p in paths(x.example)}


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def layout_of(record: object) -> Layout | None:
    """By the fingerprint of all fields, else by that of the fields that any layout names (others are extra, but a history is not)."""
    found = BY_FINGERPRINT.get(fingerprint(record))
    if found is None and isinstance(record, dict):
        own = "\n".join(sorted(paths(record) & _FIELDS))
        found = BY_FINGERPRINT.get(hashlib.sha256(own.encode()).hexdigest()[:16])
        if found and not found.history and record.get("history"):
            return None
    return found


def canonical(record: object) -> list[tuple[str, str]] | None:
    """The turns of a record, or None if its layout is not known or an item of its list is of another kind than the layout says."""
    layout = layout_of(record)
    if layout is None:
        return None
    turns = []
    for exchange in (record.get(layout.history) or []) if layout.history else []:
        if not isinstance(exchange, list):
            return None
        turns += [(("user", "assistant")[i % 2], _text(t)) for i, t in enumerate(exchange)]
    for role, names in layout.fields:
        if role == "system" and not _text(record.get(names[0])):
            continue
        turns.append((role, "\n\n".join(t for t in (_text(record.get(n)) for n in names) if t)))
    if layout.messages:
        where, role, text = layout.messages
        for i, m in enumerate(record.get(where) or []):
            if role:
                if not isinstance(m, dict):
                    return None
                said = _text(m.get(role))
                turns.append((said if layout.verbatim else ROLES.get(said.lower(), said), _text(m.get(text))))
            else:
                turns.append((("user", "assistant")[i % 2], _text(m)))
    return turns


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation, and the character spans of the assistant's texts: the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}{CLOSE}")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in _PIECES.findall(formatted)]


def format_records(records: DataFrame) -> DataFrame:
    """``records(conv_id, record)``, each record a JSON string -> ``conv_id, layout, formatted, mask``.

    ``layout`` is the record's fingerprint; ``formatted`` and ``mask`` (spans of characters under the loss) are null if
    no mapping is known for it, or if the record is null, no JSON, or nested beyond what the JSON reader takes (some thousand levels). Missing and null texts are empty; rows are formatted one by one,
    so repeated ones come out repeated; an empty table gives an empty one; other columns are not read.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for conv, text in zip(frame["conv_id"], frame["record"], strict=True):
                try:
                    record = json.loads(text) if isinstance(text, str) else None
                except (ValueError, RecursionError):
                    record = None
                turns = canonical(record)
                formatted, spans = render(turns) if turns is not None else (None, None)
                out.append((conv, None if record is None else fingerprint(record), formatted, spans and [{"start": a, "end": b} for a, b in spans] if spans is not None else None))
            yield pd.DataFrame(out, columns=["conv_id", "layout", "formatted", "mask"])

    rows = records.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("record").cast("string").alias("record"))
    kind = records.schema["conv_id"].dataType
    out = rows.mapInPandas(run, "conv_id string, layout string, formatted string, mask array<struct<start:int,end:int>>")
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))


def as_records(turns: DataFrame, varied: bool = False) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` -> one JSON record for each conversation, of the layout ``turns``.

    ``varied``: conversations that another layout holds without loss come in one of these, dealt by a hash of conv_id: a question
    and its answer as prompt, question or instruction (with the rest of the question behind its first blank line as input), an
    exchange that begins with the user and alternates as dialog or as from and value, with a system text ahead of it too.

    A conversation's rows are in order of turn, nulls first, ties by role and text; it is one record, so it is held whole.
    """
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    plain = F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")))
    if not varied:
        return listed.select("conv_id", plain.alias("record"))

    def record(**fields: Column) -> Column:
        return F.to_json(F.struct(*[value.alias(name) for name, value in fields.items()]))

    system = F.try_element_at("turns", F.lit(1))
    led = (system["role"] == "system") & (system["text"] != "")
    spoken = F.when(led, F.slice("turns", 2, F.greatest(F.size("turns") - 1, F.lit(0)))).otherwise(F.col("turns"))
    dealt = listed.withColumn("led", F.coalesce(led, F.lit(False))).withColumn("spoken", spoken).withColumn("way", F.pmod(F.xxhash64("conv_id"), F.lit(5)))
    alternates = (F.size("spoken") > 0) & F.forall(F.transform("spoken", lambda t, i: t["role"] == F.when(i % 2 == 0, "user").otherwise("assistant")), lambda x: x)
    pair = alternates & (F.size("spoken") == 2) & ~F.col("led")
    asked, answered = F.try_element_at("spoken", F.lit(1))["text"], F.try_element_at("spoken", F.lit(2))["text"]
    head, rest = F.substring_index(asked, "\n\n", 1), F.expr("substring(spoken[0].text, locate('\n\n', spoken[0].text) + 2)")
    cut = asked.contains("\n\n") & (head != "") & (rest != "")
    said = F.transform("spoken", lambda t: F.struct(F.when(t["role"] == "user", "human").otherwise("gpt").alias("from"), t["text"].alias("value")))
    told = (
        F.when(pair & (F.col("way") == 0), record(prompt=asked, completion=answered))
        .when(pair & (F.col("way") == 1), record(question=asked, answer=answered))
        .when(pair & (F.col("way") == 2) & cut, record(instruction=head, input=rest, output=answered))
        .when(pair & (F.col("way") == 2), record(instruction=asked, output=answered))
        .when(alternates & ~F.col("led") & (F.col("way") == 3), record(dialog=F.transform("spoken", lambda t: t["text"])))
        .when(alternates & F.col("led"), record(system=system["text"], conversations=said))
        .when(alternates & (F.col("way") < 4), record(conversations=said))
        .otherwise(plain)
    )
    return dealt.select("conv_id", told.alias("record"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation holds: turns, their digest, and length and digest of the text under the loss mask."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for conv, text, mask in zip(frame["conv_id"], frame["formatted"], frame["mask"], strict=True):
                turns = parse(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                told = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = formatted.schema["conv_id"].dataType
    rows = formatted.where("formatted is not null").select(F.col("conv_id").cast("string").alias("conv_id"), "formatted", "mask")
    out = rows.mapInPandas(run, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return out.withColumn("conv_id", F.col("conv_id").cast(kind))
