"""Where blocks begin and end, pages of any malformation in linear time, and where the article is."""

import random
import time

import pytest

from corvane.llm.html import align, extract_main_text, folded, main_place, main_text, scan, start


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div>Intro<p>Para</p>tail</div>", "Intro\nPara\ntail"),
        ("<ul><li>Item one<ul><li>Sub</li></ul></li></ul>", "Item one\nSub"),
        ("a<hr>b", "a\nb"),
        ("<div>Intro<div class='share-box'>Share this</div>tail</div>", "Intro\ntail"),
        ("<div>Intro<form>..</form>end</div>", "Intro\nend"),
        ("<p>press <button>OK</button> to go</p>", "press to go"),
        ("<p>a <select><option>q<option>r</select>b<p>c", "a b\nc"),
        ("<p>x <label>y", "x"),
        ("<p>one<script>var x='<p>';</script>two</p>", "onetwo"),
        ("<p title=\"a<b\">x</p>y", "x\ny"),
        ("x <y z", "x <y z"),
    ],
)
def test_blocks(page, text):
    assert main_text(page, "article") == text


def made(rnd, depth):
    """A random nest of block elements with the blocks that it must give, by walking the tree."""
    out, blocks, spoke = [], [], False
    for _ in range(rnd.randrange(1, 5)):
        if rnd.random() < 0.5 and not spoke:
            words = [f"w{rnd.randrange(1000)}" for _ in range(rnd.randrange(1, 4))]
            out.append(" ".join(f"<b>{w}</b>" if rnd.random() < 0.3 else w for w in words))
            blocks.append(" ".join(words))
            spoke = True
        elif depth < 5:
            name = rnd.choice(["div", "section", "blockquote", "ul", "h2", "pre", "dl"])
            inner, own = made(rnd, depth + 1)
            if name == "ul":
                inner = f"<li>{inner}</li>"
            out.append(f"<{name}>{inner}</{name}>")
            blocks += own
            spoke = False
    return "".join(out), blocks


def test_blocks_of_random_pages():
    rnd = random.Random(5)
    for _ in range(300):
        page, blocks = made(rnd, 0)
        assert main_text(f"<body>{page}</body>", "article") == "\n".join(blocks)


@pytest.mark.parametrize("page", ["<b" * 500_000, "<a " * 333_000, "<a '\"><a " * 100_000, "<" * 1_000_000, "<!--" * 250_000, "<![CDATA[" * 110_000, "</div>" * 160_000], ids=range(7))
def test_a_megabyte_of_broken_tags(page):
    began = time.perf_counter()
    folded(scan(page)[0])
    assert time.perf_counter() - began < 2


@pytest.mark.parametrize("page", ["<div>" * 10_000 + "x" + "</div>" * 10_000, "<x-y>" * 10_000, "<div class=content>t" * 10_000, "<button>" * 10_000, "<div>x" * 10_000], ids=range(5))
def test_ten_thousand_levels(page):
    began = time.perf_counter()
    entries = folded(scan(page)[0])
    align(start(entries, 1), start(entries, 1))
    assert time.perf_counter() - began < 5
    assert main_text(page, "article").count("x") in (0, 1, 10_000)


def place(*pages):
    wrapper = []
    for page in pages:
        own = start(folded(scan(page)[0]), 1)
        wrapper = align(wrapper, own) if wrapper else own
    return main_place(wrapper, len(pages))


def test_a_teaser_is_not_the_article():
    page = "<body><div class='content'><p>Real article {i}</p></div><div class='x'><article class='teaser'>Read on</article></div></body>"
    assert place(*(page.format(i=i) for i in range(4))) == "body/div.content"
    assert place(*(page.replace("content", "main").replace("<div class='main'>", "<main>").replace("</div><div class='x'>", "</main><div class='x'>").format(i=i) for i in range(4))) == "body/main"


@pytest.mark.parametrize("size", [2, 8, 30])
def test_long_teasers_are_one_repeated_group(size):
    teaser = "<article class='t'>" + "".join(f"<h2>T{i}</h2><p>words</p>" for i in range(size)) + "</article>"
    odd = teaser.replace("<p>words</p>", "", 1)
    page = f"<body><div class='content'><p>{'Real article of some length. ' * size * 9}</p></div><div class='x'>{teaser}{odd}{teaser}</div></body>"
    assert place(*[page] * 4) == "body/div.content"
    assert [many for t, many, _ in folded(scan(page)[0]) if t.endswith("article.t")] == [True, True]


def test_whole_hosts(spark):
    teaser = "<article class='teaser'><h2>Read {i}</h2><p>on and on</p></article>"
    pages = [
        "<body><div class='content'><p>Real article {i} says this and that and more of it</p></div>" + teaser + "</body>",
        "<body>" + teaser * 3 + "<div class='content'>Intro {i}<p>Real article</p>tail</div></body>",
    ]
    rows = [(10 * k + i, f"http://h{k}/{i}", p.format(i=i)) for k, p in enumerate(pages) for i in range(4)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), keep_fixed=True).collect()}
    assert got == {i: f"Real article {i} says this and that and more of it" for i in range(4)} | {10 + i: f"Intro {i}\nReal article\ntail" for i in range(4)}
