import random

import pytest

from corvane.llm.html import extract_main_text, infer_wrappers, main_text

LEAD = "<html><body class='site'><header><p>Site</p></header><nav><ul><li>Home</li><li>More</li></ul></nav>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>Body</p></article><aside class='related'><article><p>Teaser card</p></article></aside>", "Body"),
        ("<article><p>Body</p><section class='discussion'><article>reader says</article></section></article>", "Body"),
        ("<article><p>Body</p></article><section class='discussion'><article>reader says</article></section>", "Body"),
        ("<article><p>Body</p><div class='feedback'><p>me too</p></div></article>", "Body"),
        ("<article><p class='share-price'>10 EUR</p><div class='social-history'>1848</div><div class='share-box'>Share</div></article>", "10 EUR\n1848"),
        ("<article><p>One</p></article><article><p>Two</p></article>", "One\nTwo"),
    ],
)
def test_probes(page, text):
    assert main_text(LEAD + page + "<footer>Foot</footer></body></html>", "article") == text


def made(rnd, layout, i):
    """A page of one of some layouts, and its article."""
    blocks = [f"Head {i} {rnd.randrange(99)}"] + [f"Paragraph {rnd.randrange(10**6)} of {i}" for _ in range(rnd.randrange(1, 6))]
    inner = f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{b}</p>" for b in blocks[1:])
    if rnd.random() < 0.4:
        items = [f"item {rnd.randrange(99)}" for _ in range(rnd.randrange(1, 5))]
        inner += "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        blocks += items
    if rnd.random() < 0.3:
        inner += f"<blockquote><p>Quote {i}</p></blockquote>"
        blocks.append(f"Quote {i}")
    teasers = "".join(f"<article class='t'><h2>Teaser {rnd.randrange(99)}</h2></article>" for _ in range(rnd.randrange(0, 5)))
    remarks = "".join(f"<article><p>says {rnd.randrange(99)}</p></article>" for _ in range(rnd.randrange(0, 4)))
    if layout == 0:
        page = f"{LEAD}<main><article id='p{i}'>{inner}</article></main><div class='x'>{teasers}</div><footer>F</footer>"
    elif layout == 1:
        page = f"{LEAD}<div class='wrap'><article>{inner}<section class='said'>{remarks}</section></article></div><section class='more'>{teasers}</section>"
    elif layout == 2:
        page = f"{LEAD}<div class='entry-content'>{inner}</div><aside>{teasers}</aside><footer>F</footer>"
    else:
        page = f"{LEAD}<main class='m{i}'>{inner}</main><div class='widget-area'>Widgets</div>"
    return page, "\n".join(blocks)


def test_many_hosts_against_what_was_made(spark):
    rnd = random.Random(11)
    rows, want = [], {}
    for host in range(12):
        for k in range(rnd.choice((1, 2, 9, 10, 25))):
            i = 1000 * host + k
            page, want[i] = made(rnd, host % 4, i)
            rows.append((i, f"http://h{host}.example/{k}", page))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)
    first = {r.page_id: r.text for r in extract_main_text(df, keep_fixed=True).collect()}
    assert first == want
    assert first == {r.page_id: r.text for r in extract_main_text(df.repartition(2), keep_fixed=True).collect()}
    place = {r.host: r.place for r in infer_wrappers(df).collect()}
    assert place["h1.example"].endswith("div.wrap/article") and place["h2.example"].endswith("div.entry-content")


@pytest.mark.parametrize("n", [9, 10, 40])
def test_shared_sentences_of_articles_stay(spark, n):
    rows = [(i, f"http://a.b/{i}", f"<body><article><h1>Title {i}</h1><p>Thanks for reading</p></article></body>") for i in range(n)]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), keep_fixed=True).collect()
    assert {r.page_id: r.text for r in got} == {i: f"Title {i}\nThanks for reading" for i in range(n)}
