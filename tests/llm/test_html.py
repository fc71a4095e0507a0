import html
import re

import pytest

from corvane.llm.html import align, expression, extract_main_text, folded, infer_wrappers, main_text, scan, start

SF = "/root/testdata/sf0.01"


def brute(page):
    """The tables' pages keep the article in one element, with headings and paragraphs in it."""
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.DOTALL)
    blocks = [" ".join(html.unescape(re.sub(r"</?(?:b|br)>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", m[1])] if m else []
    return "\n".join(x for x in blocks if x)


def test_pages_of_the_tables(spark):
    df = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in extract_main_text(df).collect()}
    for r in df.collect():
        assert got[r.page_id].text == brute(r.html) and got[r.page_id].n_chars == len(got[r.page_id].text)
        assert got[r.page_id].url == r.url


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="promo-page"><header>Site</header><nav><ul><li><a>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div id=sidebar>Side</div><main><article class="post"><header><h1>Head &amp; line</h1></header>
<p>First   <b>bold</b>&nbsp;text<br>goes on <script>var x="</p><p>no";</script>here<p>Second &lt;b&gt; 3 < 4
<div class="ad-slot"><p>Buy</p></div><form><p>Name</p></form><ul><li>one<li>two</ul><aside>See also</aside><p hidden>gone</p><!-- <p>c</p> --><table><tr><td>a<td>b</table>
<section class="comments"><article class="comment"><p>Nice!</p></article></section></article></main><footer>Foot</footer></body></html>"""


def test_one_page():
    assert main_text(PAGE, "article") == "Head & line\nFirst bold text goes on here\nSecond <b> 3 < 4\none\ntwo\na\nb"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("just text", "just text"),
        ("<body><div class='entry-content'><h2>A</h2>b</div><div>other</div>", "A\nb"),
        ("<body><nav><p>menu<article><p>in</p></article>", "in"),
        ("<body><p>a</p><p>b", "a\nb"),
        ("<p title='x>y'>q</p>", "q"),
        ("<nav>only menu</nav>", ""),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<article><p>" + "long " * 50_000 + "</p></article>", ("long " * 50_000).strip()),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page, "article") == text


def test_folding_and_alignment():
    lists = [folded(scan(f"<ul>{'<li>x</li>' * n}</ul>{'<p>y</p>' * m}")[0]) for n, m in ((2, 1), (5, 0), (3, 4))]
    wrapper = start(lists[0], 1)
    for x in lists[1:]:
        wrapper = align(wrapper, start(x, 1))
    assert expression(wrapper, 3) == "<ul (<li # /li)+ /ul (<p # /p)*"


def test_fixed_texts(spark):
    page = "<article><h1>Title {i}</h1><p>Body number {i}</p><div>Thanks for reading</div></article>"
    rows = [(i, "http://a.b/x", page.format(i=i)) for i in range(20)] + [(99, "http://a.b/y", page.format(i=3))] * 40 + [(50 + i, "http://small.b/", page.format(i=i)) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert got[7] == "Title 7\nBody number 7" and got[99] == "Title 3\nBody number 3"
    assert got[51] == "Title 1\nBody number 1\nThanks for reading"
    assert {r.host: (r.main, r.pages) for r in infer_wrappers(df).collect()} == {"a.b": ("article", 60), "small.b": ("article", 3)}


def test_edges(spark):
    df = spark.createDataFrame([(1, None, None, 1), (2, "no url", "<p>x</p>", 1), (None, "http://h/", "", 1), (2, "no url", "<p>x</p>", 1)], "page_id int, url string, html string, text int")
    got = sorted((tuple(r) for r in extract_main_text(df).collect()), key=str)
    assert got == sorted([(1, None, "", 0), (2, "no url", "x", 1), (None, "http://h/", "", 0), (2, "no url", "x", 1)], key=str)
    assert extract_main_text(df.limit(0)).collect() == []


def test_containers_with_own_ids(spark):
    page = '<body><div class="x9">Teaser {i}</div><article id="post-{i}" class="c{i}"><h1>Title {i}</h1><p>Body number {i}</p></article><div>Also {i}</div></body>'
    rows = [(i, f"http://{host}/{i}", page.format(i=i)) for host, ids in (("a.b", range(20)), ("small.b", range(20, 22))) for i in ids]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract_main_text(df).collect()} == {i: f"Title {i}\nBody number {i}" for i in range(22)}
    assert {r.host: (r.main, r.pages) for r in infer_wrappers(df).collect()} == {"a.b": ("article", 20), "small.b": ("article", 2)}
