"""Main text of pages: cuts against all labellings, planted pages of several layouts."""

import itertools
import random
import re
from html import unescape

from rookery.llm import pages, queries

FOLDER = "/root/testdata/sf0.001"
PARAGRAPHS = [
    "The first paragraph tells at some length what the page is about, and it ends properly.",
    "Short one.",
    "A third paragraph follows with an <a href='/x'>inline link</a>, a <b>bold</b> word &amp; an entity&#33;",
    "The last one is again a longer sentence, as is usual for articles of any kind on the web.",
]
PLAIN = [" ".join(unescape(re.sub("<[^>]*>", "", p)).split()) for p in PARAGRAPHS]
ARTICLE = "<h1>A title</h1>" + "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Entry {i}</a></li>" for i in range(8)) + "</ul>"
COMMENT = "<div class='comment'><p>I liked this article a lot, thank you for writing it down so well.</p></div>"


def text_of(html):
    return "\n\n".join(pages.main_blocks(html))


def test_cut_is_minimal():
    chance = random.Random(2)
    for _ in range(600):
        n = chance.randint(1, 8)
        terminal = [chance.choice([-6, -3, -1, 0, 1, 2, 5]) for _ in range(n)]
        edges = {(chance.randrange(n), chance.randrange(n)): chance.randint(1, 3) for _ in range(chance.randint(0, 14))}

        def cost(sides):
            own = sum(max(0, -t) if s else max(0, t) for t, s in zip(terminal, sides, strict=True))
            return own + sum(w for (a, b), w in edges.items() if sides[a] != sides[b])

        assert cost(pages.minimum_cut(terminal, edges)) == min(map(cost, itertools.product([False, True], repeat=n)))


def test_layouts():
    want = "\n\n".join(["A title", *PLAIN])
    layouts = [
        f"<html><body><nav>{MENU}</nav><article>{ARTICLE}</article><footer>&copy; Somebody. All of it is ours.</footer></body></html>",
        f"<div id='top-nav'>{MENU}</div><div class='main-content'>{ARTICLE}</div><div class='sidebar'><h3>More</h3><p>You may also want to read this other long text about things.</p></div>",
        f"<header><h1>The site</h1><p>The best site there is, as everybody knows by now.</p></header><main>{ARTICLE}<section id='comments'><h2>Comments</h2>{COMMENT * 30}</section></main>",
        f"<div class='cookie-notice'><p>We use cookies to make this page better for you, please agree.</p></div><article>{ARTICLE}</article><div class='advert'>Buy now.</div>",
        f"<form id='page' action='/'><div class='search'><input name=q><button>Go</button></div><main>{ARTICLE}</main></form>",
        f"<div class='layout has-sidebar'><main>{ARTICLE}</main><aside>{MENU}</aside></div>",
        f"<article><header>{ARTICLE}</header><form><label>Your name</label><input><textarea>none</textarea></form></article>",
        f"<script>var t='</p><p>no';</script><style>p{{}}</style><article>{ARTICLE}</article><noscript>Turn it on.</noscript><!-- <p>not this</p>",
    ]
    for html in layouts:
        assert text_of(html) == want, html[:60]


def test_markup():
    assert text_of("<article><p>One<br>two\n\n  three&nbsp;four.<p>Unclosed <b>bold <p>Five &lt;p&gt; six.</article>") == (
        "One two three four.\n\nUnclosed bold\n\nFive <p> six."
    )
    assert text_of("<main><p>A &quot;quoted&quot; caf&eacute; &#x1F600; sentence.</p><p title='a > b'>Another one.</p></main>") == (
        'A "quoted" café \U0001f600 sentence.\n\nAnother one.'
    )
    assert text_of("<article><p>A < b and c > d, 1 <2.</p></article>") == "A < b and c > d, 1 <2."
    assert text_of("<p>Broken <a href=\"x>link</p><p>goes on to the end.</p>").endswith("goes on to the end.")
    assert text_of("") == text_of("<script>never ends") == text_of("<nav><a href='/'>Home</a></nav>") == ""


def test_long_and_deep_pages():
    many = "<article>" + "<p>A paragraph of the page.</p>" * 20_000 + "</article>"
    assert len(pages.main_blocks(many)) == 20_000
    deep = "<div>" * 20_000 + "<p>The only sentence there is.</p>"
    assert pages.main_blocks(deep) == ["The only sentence there is."]


def test_query_returns_the_article(spark):
    got = {r["page_id"]: r for r in queries.op12_html_extraction(spark, FOLDER).collect()}
    given = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    assert len(got) == len(given)
    for page in given:
        inner = re.search("<article>(.*?)</article>", page["html"], re.S).group(1).replace("<br>", " ")
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", part)).split()) for part in re.split("</?(?:p|h1)>", inner)]
        row = got[page["page_id"]]
        assert row["text"] == "\n\n".join(p for p in parts if p)
        assert row["n_chars"] == len(row["text"]) and row["url"] == page["url"]


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, prior double"
    rows = [(1, None, None, "t", 1, 0.5), (None, "u", "", "t", 1, 0.5), (2, "u", f"<article>{ARTICLE}</article>", None, None, None)]
    got = pages.extract(spark.createDataFrame([*rows, rows[2]], schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = sorted(((r["page_id"], r["url"], r["n_chars"] > 0) for r in got.collect()), key=str)
    assert found == [(1, None, False), (2, "u", True), (2, "u", True), (None, "u", False)]
    assert pages.extract(spark.createDataFrame([], schema)).collect() == []
