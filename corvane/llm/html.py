"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of tags and texts. Siblings that follow one another and begin alike, or that repeat a pattern, fold into repeated groups, however
long they are; streams of one host are then aligned, and what only some of them have becomes optional. Ids, and classes with numbers, are a page's own and take no part.
The wrapper says where the article is: of the containers that at least half of the pages have and that are no part of a repeated group (lists of teasers or remarks
are), the one whose text slots hold the most text, or one inside it that holds much of that and is more telling. A page is read by that place in its host's wrapper: its main text are
the text slots below it, without menus, forms, notices and the like.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.store import materialize

#: Elements without content, with text that is no markup, that end a paragraph, and that are never main text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Fixed value: of those that are never main text, the ones that stand inside a line: the text around them is one block.
WITHIN_LINE = set("button select option input label svg canvas object video audio map".split())
NEVER = set("head nav footer aside form button select option input label fieldset menu dialog template svg canvas object video audio map".split()) | RAW
#: Words in a class or an id that say the element is no part of the article.
OUTSIDE = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "newsletter subscribe subscription signup login paywall sidebar widget widgets related recommended recommendations share sharing social comment comments commentlist reply "
    "replies respond disqus discussion feedback responses talkback menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer masthead topbar toolbar skip hidden".split()
)
REMARKS = set("comment comments commentlist reply replies respond disqus discussion feedback responses talkback".split())
#: Words that may stand beside those in a class or an id: "share-box" is a frame, "share-price" is not.
BESIDE = set(
    "area article bar big block body bottom box btn button buttons card cards col column container content counter desktop entry fixed footer form global group head header holder icon icons inline inner "
    "item items js l label large left link links list main media message mobile module nav outer page pane panel post posts primary r right row secondary section site slot small sticky story strip tab "
    "tabs tag tags text thread title tool tools top unit user view wrap wrapper zone".split()
)
#: Words in a class or an id of a main container, where no element says so.
INSIDE = set("article articlebody post postbody entry story content maincontent bodytext text".split())
KINDS = ("article", "main", "class", "body")

#: A text is fixed if so many distinct pages of the host, and such a share of them, have it in the same place.
FIXED_PAGES, FIXED_SHARE = 10, 0.8
SALTS = 64
#: A container inside another is the article's place if it holds this share of its text and is more telling.
MUCH = 0.5
#: Elements below so many others are aligned without being folded, and those in so many main containers are none themselves; nothing of their texts is lost.
DEEP, MANY_MAINS = 200, 50
#: Beyond this product of lengths streams are aligned by their rarer tokens.
LARGE = 25_000_000
#: Siblings whose pattern repeats: patterns of so many siblings, each of any length.
_LOOP = re.compile(r"(.{1,8}?)\1+", re.DOTALL)

#: Nothing here is tried twice: a tag reaches to its ">" without passing a "<", else to the next ">", which is then used up.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/<>]*+)(?P<attrs>(?:\"[^\"<]*+\"|'[^'<]*+'|[^<>\"'])*+|[^>]*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)
_PART = re.compile(r"[^a-z0-9]+")


class _Element:
    __slots__ = ("framed", "held", "inside", "key", "kind", "name", "mains_above", "parent", "path", "skip", "within")

    def __init__(self, name: str, key: str, path: str, skip: str, kind: str, framed: bool, parent: _Element | None):
        self.name, self.key, self.path, self.skip, self.kind, self.framed, self.parent = name, key, path, skip, kind, framed, parent
        self.mains_above = parent.mains_above + bool(parent.kind) if parent else 0
        if self.mains_above >= MANY_MAINS:
            self.kind = kind = ""
        self.within = kind == "article" or (parent is not None and parent.within)
        self.inside = kind in ("article", "main") or (parent is not None and parent.inside)
        self.held: list[str] | None = None

    def mains(self) -> list[_Element]:
        """The main containers around, itself included."""
        out, at = [], self
        while at is not None:
            if at.kind:
                out.append(at)
            at = at.parent
        return out


def _joined(path: str, key: str) -> str:
    """A place below another; of deep ones the beginning is told by a digest, so that places stay short."""
    if len(path) > 500:
        path = "~" + hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=8).hexdigest()
    return f"{path}/{key}" if path else key


class Block(NamedTuple):
    """A text of a page: kinds and places of the main containers around it, whether a frame is around these, its path and the text."""

    kinds: frozenset[str]
    places: frozenset[str]
    framed: bool
    path: str
    text: str


def _telling(value: str) -> set[str]:
    """The outside words of a class or an id list: those of names that say nothing else."""
    found: set[str] = set()
    for name in value.split():
        parts = {x for x in _PART.split(name) if x and not x.isdigit()}
        told = parts & OUTSIDE
        if told and parts - told <= BESIDE:
            found |= told
    return found


def _element(name: str, attrs: str, parent: _Element | None) -> _Element:
    """An opened element: its key, whether (and why) its texts are skipped, and which kind of main container it is. An article in an article is a remark."""
    inside, within = (parent.inside, parent.within) if parent else (False, False)
    parts: set[str] = set()
    outside: set[str] = set()
    key, hidden, role = name, False, ""
    for a, value in _ATTRIBUTE.findall(attrs) if attrs else ():
        a, value = a.lower(), value.strip("\"'").lower()
        if a in ("class", "id", "itemprop"):
            parts.update(_PART.split(value))
            outside |= _telling(value)
            if a == "class":
                key += "".join(f".{c}" for c in value.split() if not any(x.isdigit() for x in c))
        elif a == "role":
            role = value
        elif a == "hidden" or (a == "aria-hidden" and value == "true") or (a == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
    before, framed = (parent.skip, parent.framed) if parent else ("", False)
    container = name in ("article", "main") or role == "main"
    if hidden:
        skip = "hidden"
    elif container:
        skip = "remarks" if outside & REMARKS or (name == "article" and within) else "" if before == "frame" else before
        framed = framed or before == "frame"
    elif before:
        skip = before
    elif name in NEVER or (name == "header" and not inside) or role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert"):
        skip = "frame"
    elif name not in ("html", "body") and outside:
        skip = "remarks" if outside & REMARKS else "frame"
    else:
        skip = ""
    kind = "article" if name == "article" else "main" if container else "body" if name == "body" else "class" if name in ("div", "section", "td") and parts & INSIDE else ""
    return _Element(name, key, _joined(parent.path if parent else "", key), skip, "" if skip else kind, framed, parent)


def scan(page: str) -> tuple[list[tuple[str, str, int]], list[Block]]:
    """A page's token stream for inference (tokens, and how long their texts are), and its blocks.

    A text ends where an element that isn't part of a line begins or ends. Time grows with the page, however it is malformed or nested.
    """
    stream: list[tuple[str, str, int]] = []
    blocks: list[Block] = []
    stack: list[_Element] = []
    pieces: list[str] = []
    opened: dict[str, int] = {}

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                top = stack[-1] if stack else None
                path = top.path if top else ""
                told = not (top and top.skip)
                stream.append(("#", "", len(text) if told else 0))
                if told:
                    main = top.mains() if top else []
                    blocks.append(Block(frozenset(e.kind for e in main), frozenset(e.path for e in main), bool(top and top.framed), path, text))

    def say(raw: str) -> None:
        if raw:
            pieces.append(html.unescape(raw))

    def end_from(i: int) -> None:
        """End the elements from the i-th open one on; the text around the first that stood inside a line goes on."""
        flush()
        held = next((e.held for e in stack[i:] if e.held is not None), None)
        for e in reversed(stack[i:]):
            stream.append(("/", e.key, 0))
            opened[e.name] -= 1
        del stack[i:]
        if held is not None:
            pieces.extend(held)
            pieces.append(" ")

    def close(names: set[str], stop: set[str]) -> None:
        """End the nearest open element of these names, and what is open in it, unless one of ``stop`` is nearer."""
        if not any(opened.get(n) for n in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                end_from(i)
                return
            if stack[i].name in stop:
                return

    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        m = _TOKEN.search(page, at) if at <= last or "<!" in page[at : at + 2] else None
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA["):
                say(m[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            continue
        if m["close"]:
            close({name}, set())
            continue
        if name in RAW:
            done = re.compile(rf"</{re.escape(name)}[^>]*>", re.IGNORECASE).search(page, at)
            at = done.end() if done else end
            stream.append(("=", name, 0))
            continue
        if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            close({"dt", "dd"} if name in ("dt", "dd") else {"td", "th"} if name in ("td", "th") else {name}, {"ul", "ol", "dl", "table", "select"})
        elif name not in VOID and name not in WITHIN_LINE:
            close({"p"}, {"table", "div", "section", "article", "main", "body", "li", "blockquote"})
        if name in VOID or m["attrs"].endswith("/"):
            if name == "hr" or (name not in VOID and name not in WITHIN_LINE):
                flush()
            stream.append(("=", name, 0))
            continue
        if name not in WITHIN_LINE:
            flush()
        element = _element(name, m["attrs"], stack[-1] if stack else None)
        if name in WITHIN_LINE:
            element.held = pieces[:]
            pieces.clear()
        stack.append(element)
        opened[name] = opened.get(name, 0) + 1
        stream.append(("<" if element.framed else f"<{element.kind}", element.key, 0))
    for i, e in enumerate(stack):
        if e.held is not None:
            end_from(i)
            break
    flush()
    return stream, blocks


Wrapper = list[list]


def folded(stream: list[tuple[str, str, int]]) -> Wrapper:
    """The stream as entries [token, whether repeated, text]: siblings that begin alike one after another are one repeated group, and so are patterns of siblings.

    Inside, members of a group are aligned: what some lack stays as a part. The text of a slot is that of all its members.
    """
    root: list[tuple[str, Wrapper]] = []
    open_: list[tuple[str, str, list]] = [("", "", root)]

    def end_one() -> None:
        kind, key, children = open_.pop()
        open_[-1][2].append((kind + key, [[kind + key, False, 0], *_siblings(children), [f"/{key}", False, 0]]))

    deeper = 0
    for kind, key, size in stream:
        if kind.startswith("<") and len(open_) > DEEP:
            deeper += 1
            open_[-1][2].append(("", [[kind + key, False, 0]]))
        elif kind.startswith("<"):
            open_.append((kind, key, []))
        elif kind == "/" and deeper:
            deeper -= 1
            open_[-1][2].append(("", [[f"/{key}", False, 0]]))
        elif kind == "/":
            if len(open_) > 1:
                end_one()
        else:
            open_[-1][2].append(("", [[kind + key, False, size]]))
    while len(open_) > 1:
        end_one()
    return _siblings(root)


def _siblings(children: list[tuple[str, Wrapper]]) -> Wrapper:
    """Siblings in order, repeated ones as one."""
    groups: list[tuple[str, Wrapper]] = []
    for name, entries in children:
        if name and groups and groups[-1][0] == name:
            groups[-1] = (name, _repeated(_united(groups[-1][1], entries)))
        else:
            groups.append((name, entries))
    code: dict[tuple, str] = {}
    text = "".join(code.setdefault((name or entries[0][0], *(x[0] for x in entries)), chr(0x100 + len(code) if len(code) < 0xD000 else 0xF000)) for name, entries in groups)
    out: Wrapper = []
    at = 0
    for m in _LOOP.finditer(text):
        size = len(m[1])
        if "\uf000" in m[0]:
            continue
        for _, entries in groups[at : m.start()]:
            out += entries
        turns = [[x for _, entries in groups[i : i + size] for x in entries] for i in range(m.start(), m.end(), size)]
        whole = turns[0]
        for turn in turns[1:]:
            whole = [[x[0], x[1] or y[1], x[2] + y[2]] for x, y in zip(whole, turn, strict=True)]
        out += _repeated(whole)
        at = m.end()
    for _, entries in groups[at:]:
        out += entries
    return out


def _repeated(entries: Wrapper) -> Wrapper:
    return [[t, True, size] for t, _, size in entries]


def _matcher(a: Wrapper, b: Wrapper) -> SequenceMatcher:
    return SequenceMatcher(None, [x[0] for x in a], [x[0] for x in b], autojunk=len(a) * len(b) > LARGE)


def _united(a: Wrapper, b: Wrapper) -> Wrapper:
    """Two members of a group as one."""
    if len(a) == len(b) and all(x[0] == y[0] for x, y in zip(a, b, strict=True)):
        return [[x[0], x[1] or y[1], x[2] + y[2]] for x, y in zip(a, b, strict=True)]
    out: Wrapper = []
    for what, i, j, k, n in _matcher(a, b).get_opcodes():
        if what == "equal":
            out += [[x[0], x[1] or y[1], x[2] + y[2]] for x, y in zip(a[i:j], b[k:n], strict=True)]
        else:
            out += [list(x) for x in [*a[i:j], *b[k:n]]]
    return out


def start(entries: Wrapper, pages: int) -> Wrapper:
    """A wrapper of one stream: entries [token, repeated, pages that have it, text of all of them]."""
    return [[t, many, pages, size * pages] for t, many, size in entries]


def align(a: Wrapper, b: Wrapper) -> Wrapper:
    """Two wrappers as one: common tokens meet, the others stay as parts that not all pages have."""
    if len(a) == len(b) and all(x[0] == y[0] for x, y in zip(a, b, strict=True)):
        return [[x[0], x[1] or y[1], x[2] + y[2], x[3] + y[3]] for x, y in zip(a, b, strict=True)]
    out: Wrapper = []
    for what, i, j, k, n in _matcher(a, b).get_opcodes():
        if what == "equal":
            out += [[x[0], x[1] or y[1], x[2] + y[2], x[3] + y[3]] for x, y in zip(a[i:j], b[k:n], strict=True)]
        else:
            # A mismatch that says again what stands just ahead is one more turn of a repeated group.
            for side in (a[i:j], b[k:n]):
                size = len(side)
                if size and [x[0] for x in out[-size:]] == [x[0] for x in side]:
                    for x in out[-size:]:
                        x[1] = True
                else:
                    out += [list(x) for x in side]
    return out


def expression(wrapper: Wrapper, pages: int) -> str:
    """The wrapper as a union-free regular expression over tokens; ``#`` is a text slot."""
    out, at = [], 0
    while at < len(wrapper):
        _, many, n, _ = wrapper[at]
        to = at
        while to < len(wrapper) and wrapper[to][1] == many and (wrapper[to][2] < pages) == (n < pages):
            to += 1
        mark = ("*" if n < pages else "+") if many else "?" if n < pages else ""
        body = " ".join(x[0] for x in wrapper[at:to])
        out.append(f"({body}){mark}" if mark else body)
        at = to
    return " ".join(out)


def main_kind(pages: str, has: dict[str, str]) -> F.Column:
    """The most telling kind of main container that at least half of the pages have, however the elements are called.

    ``pages`` and the values of ``has`` are columns with numbers of pages: all, and those that have a container of the kind.
    """
    return F.coalesce(*[F.when(2 * F.col(has[kind]) >= F.col(pages), kind) for kind in KINDS], F.lit("body"))


def main_place(wrapper: Wrapper, pages: int) -> str:
    """Where the article is: of the containers that half of the pages have and that are in no repeated group the one that holds the most text.

    A container inside it that holds ``MUCH`` of its text goes first if its kind tells more. The body counts only where there is no other.
    """
    open_: list[tuple[str, bool, tuple | None]] = []
    found: dict[tuple[int, str], list[int]] = {}
    inside: dict[tuple[int, str], set[tuple[int, str]]] = {}
    kinds = {f"<{kind}": i for i, kind in enumerate(KINDS)}
    for token, many, n, size in wrapper:
        if token.startswith("<"):
            mark = next((m for m in kinds if token.startswith(m) and token != m), "<")
            key = token.removeprefix(mark)
            path = _joined(open_[-1][0] if open_ else "", key)
            repeated = many or bool(open_ and open_[-1][1])
            around = open_[-1][2] if open_ else None
            own = None
            if mark in kinds and not repeated:
                own = (kinds[mark], path)
                found.setdefault(own, [0, 0])[0] += n
                inside.setdefault(own, set()).update(({around} | inside[around]) if around else ())
            open_.append((path, repeated, own or around))
        elif token.startswith("/"):
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0].rsplit("/", 1)[-1] == token[1:]:
                    del open_[i:]
                    break
        elif token == "#" and open_ and open_[-1][2]:
            for own in {open_[-1][2]} | inside[open_[-1][2]]:
                found[own][1] += size
    usual = {own: size for own, (n, size) in found.items() if 2 * n >= pages}
    usual = {own: size for own, size in usual.items() if own[0] < len(KINDS) - 1} or usual
    if not usual:
        return ""
    most = min(usual, key=lambda own: (-usual[own], own))
    near = [own for own in usual if own == most or (most in inside[own] and usual[own] >= MUCH * usual[most])]
    return min(near, key=lambda own: (own[0], -usual[own], own[1]))[1]


def chosen(blocks: list[Block], kind: str, place: str = "") -> list[tuple[str, str]]:
    """The blocks at the wrapper's place for the article; without it, in main containers of that kind, or of the next telling one that the page has; without any, all.

    Containers in a frame count only where the page has none outside.
    """
    for k in (place, kind, *KINDS):
        own = [b for b in blocks if k and k in (b.places if k == place else b.kinds)]
        if own:
            free = [b for b in own if not b.framed]
            return [(b.path, b.text) for b in free or own]
    return [(b.path, b.text) for b in blocks]


def _number(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _host(url) -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            stream, blocks = scan(page.as_py())
            own = chosen(blocks, KINDS[0])
            entries = folded(stream)
            rows.append((host, "\n".join(f"{t}{'+' if many else ''}" for t, many, _ in entries), [size for _, _, size in entries], _number(*(t for _, t in own)), sorted({_number(p, t) for p, t in own}), sorted({kind for b in blocks if not b.framed for kind in b.kinds} or {kind for b in blocks for kind in b.kinds})))
        if rows:
            kinds = (pa.string(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["host", "stream", "sizes", "content", "texts", "kinds"])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fold the streams of each host that lie in this partition, one after another, sorted by host."""
    host, wrapper, pages, out = None, None, 0, []
    for batch in batches:
        for h, stream, sizes, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if wrapper is not None and h != host:
                out.append((host, json.dumps(wrapper), pages))
                wrapper, pages = None, 0
            own = start([[t.removesuffix("+"), t.endswith("+"), size] for t, size in zip(stream.split("\n"), sizes, strict=True)] if stream else [], n)
            host, wrapper, pages = h, own if wrapper is None else align(wrapper, own), pages + n
    if wrapper is not None:
        out.append((host, json.dumps(wrapper), pages))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["host", "wrapper", "pages"])


def _one(group: pd.DataFrame) -> tuple[Wrapper, int]:
    """The wrappers of a group as one, neighbours first, so that each is aligned with few others."""
    parts = [json.loads(text) for text in group["wrapper"].sort_values()]
    while len(parts) > 1:
        parts = [align(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0], int(group["pages"].sum())


def _united_parts(group: pd.DataFrame) -> pd.DataFrame:
    wrapper, pages = _one(group)
    return pd.DataFrame([(group["host"].iloc[0], json.dumps(wrapper), pages)], columns=["host", "wrapper", "pages"])


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    wrapper, pages = _one(group)
    return pd.DataFrame([(group["host"].iloc[0], expression(wrapper, pages), main_place(wrapper, pages), pages)], columns=["host", "expression", "place", "pages"])


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``pages(url, html, ...)`` -> ``host, expression, place, main, pages, fixed``: a wrapper for each host, from all its pages.

    ``place`` is the path of its article, ``main`` the kind of container that most of the pages have.

    ``fixed`` lists hashes of (path, text) that are the template's own. Equal streams are folded once, with their number;
    a host's streams are dealt to ``SALTS`` parts, each aligned in a stream; their wrappers are aligned in eight tasks, and those of the eight in one.
    """
    source = pages.select(_host(F.col("url").cast("string")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    seen = materialize(source.mapInArrow(_streams, "host string, stream string, sizes array<long>, content long, texts array<long>, kinds array<string>"), "streams")
    counted = seen.groupBy("host", "stream").agg(F.min("sizes").alias("sizes"), F.count("*").alias("n"))
    dealt = counted.withColumn("salt", F.pmod(F.xxhash64("stream"), F.lit(SALTS))).repartition("host", "salt").sortWithinPartitions("host", "stream")
    parts = dealt.select("host", "stream", "sizes", "n").mapInArrow(_partial, "host string, wrapper string, pages long")
    eighths = F.pmod(F.xxhash64("wrapper"), F.lit(8))
    parts = parts.groupBy("host", eighths).applyInPandas(lambda _, group: _united_parts(group), "host string, wrapper string, pages long")
    wrappers = parts.groupBy("host").applyInPandas(_merged, "host string, expression string, place string, pages long")
    has = {kind: f"has_{kind}" for kind in KINDS}
    kinds = seen.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.array_contains("kinds", kind).cast("long")).alias(c) for kind, c in has.items()])
    wrappers = wrappers.join(kinds.select("host", main_kind("n", has).alias("main")), "host")

    distinct = seen.groupBy("host", "content").agg(F.min("texts").alias("texts"))
    total = distinct.groupBy("host").agg(F.count("*").alias("distinct_pages"))
    often = distinct.select("host", F.explode("texts").alias("text")).groupBy("host", "text").agg(F.count("*").alias("n")).where(F.col("n") >= FIXED_PAGES)
    fixed = often.join(total, "host").where(F.col("n") >= FIXED_SHARE * F.col("distinct_pages")).groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("fixed"))
    return wrappers.join(fixed, "host", "left").select("host", "expression", "place", "main", "pages", "fixed")


def main_text(page: str, kind: str, fixed: Iterable[int] = (), place: str = "") -> str:
    """The main text of a page: its blocks at the wrapper's place for the article, or in the host's main kind of container, that the template doesn't hold itself."""
    fixed = set(fixed)
    own = chosen(scan(page)[1], kind, place)
    return "\n".join(t for p, t in own if not fixed or _number(p, t) not in fixed)


def extract_main_text(pages: DataFrame, keep_fixed: bool = False) -> DataFrame:
    """One row per row of ``pages(page_id, url, html, ...)``: ``page_id, url, text, n_chars``.

    ``keep_fixed``: texts of the article stay though all pages of the host have them there.

    Character references are decoded, white space in a block is one blank, blocks are joined by line ends. A null or empty html
    gives an empty text; null and odd urls share one host; repeated rows come out repeated; an empty table
    gives an empty one; other columns are not read. Wrappers are joined by host: Spark broadcasts them while
    their table is small, and shuffles beyond that.
    """
    told = ["host", "place", "main", *([] if keep_fixed else ["fixed"])]
    wrappers = materialize(infer_wrappers(pages).select(*told), "wrappers")
    source = pages.select("page_id", "url", _host(F.col("url").cast("string")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = [batch.column(c).to_pylist() for c in told[1:]]
            texts = [main_text(h.as_py(), k or KINDS[0], f[0] or () if f else (), p or "") for h, p, k, *f in zip(batch.column("html"), *where, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.select("page_id", "url").schema}
    joined = source.join(wrappers, "host", "left").select("page_id", "url", "html", *told[1:])
    return joined.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
