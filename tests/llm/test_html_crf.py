import html
import random
import re
import time

import pytest

from riskloom.llm import html_crf as hc
from riskloom.llm.html_blocks import leaf_blocks
from riskloom.llm.queries import LLM_QUERIES
from tests.conftest import DATA


def texts(page):
    return [b.text for b in leaf_blocks(page)]


def test_blocks():
    for page, want in {
        "": [], "<": ["<"], "a < b &lt;c&gt; &#233;": ["a < b <c> é"], "<p>a<p>b<ul><li>x<li>y</ul>c": ["a", "b", "x", "y", "c"],
        '<div class="x" title="a>b">q</div>': ["q"], "<!-- c > --><p>k&nbsp;m&amp;n<br>o</p>": ["k m&n o"], "<TITLE>t</TITLE><P>U": ["U"],
        'x<script>if(a<b){"</p>"}</script> z': ["x z"], "<svg><text>no</text></svg>yes": ["yes"], "<table><tr><td>1<td>2<tr><td>3</table>": ["1", "2", "3"],
        '<div style="display:none">h<p>hh</p></div>v': ["v"], "<p hidden>h</p>v": ["v"], "<p>a</x></p>b</p>c": ["a", "b", "c"], "<p>x</p": ["x"],
        "<style>p{}</style ><p> a \n\t b </p>": ["a b"], "<p>İ<script>İ</SCRIPT>b": ["İb"], "</ x>a<?php b?>c<!doctype x>d": ["acd"], "<p>a <b>b</b><i>c</i></p>": ["a bc"],
    }.items():
        assert texts(page) == want, page


@pytest.mark.parametrize("page", ['<a "' * 50_000, "<p " * 50_000, "<!--" * 50_000, "<a b='" * 50_001 + ">x", "<script>" * 20_000, "<" * 100_000, '<a href="x' * 20_001 + ">y", "<div>" * 20_000 + "x"])
def test_broken_pages_take_linear_time(page):
    start = time.time()
    leaf_blocks(page)
    assert time.time() - start < 5


@pytest.fixture(scope="module")
def model(spark):
    return hc.fit(spark.read.parquet(f"{DATA}/pages.parquet"))


def test_held_out_accuracy(model):
    decoder = hc.Decoder(model)
    right = total = 0
    for blocks, labels in hc.labelled_pages(["other words than those of the training pages, by far."], 200, seed=77):
        right += sum(a == b for a, b in zip(decoder.labels(blocks), labels))
        total += len(labels)
    assert right / total >= 0.98


def test_viterbi_equals_all_labelings(model):
    decoder = hc.Decoder(model)
    (t00, t01), (t10, t11) = model["transitions"]
    trans = [[t00, t01], [t10, t11]]
    rng = random.Random(3)
    for _ in range(30):
        blocks, _ = hc.labelled_pages(["some text of a page."], 1, seed=rng.random())[0]
        blocks = blocks[:9]
        scores = [decoder._score(b) for b in blocks]

        def value(y):
            return sum(s for s, k in zip(scores, y) if k) + sum(trans[a][b] for a, b in zip(y, y[1:]))

        every = [[n >> i & 1 for i in range(len(blocks))] for n in range(1 << len(blocks))]
        assert value(decoder.labels(blocks)) == pytest.approx(max(map(value, every)))


def test_query_gives_the_articles(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = LLM_QUERIES["op10_html_crf"](spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = pages[r.page_id].html
        article = body[body.index("<article>"):body.index("</article>")]
        parts = (" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_parts_that_are_no_article(model):
    text = hc.Decoder(model).text(
        "<html><body><div class='cookie-consent'><p>We use cookies on this site to do things.</p></div><header><div class='logo'>Site</div></header>"
        "<div class='navbar'><a href='/'>Home</a></div><main><article><header><h1>Title of it</h1></header><p>First paragraph of the article.</p>"
        "<aside class='related'><p>Read this other story next.</p></aside><p>Second one &amp; last.</p></article></main>"
        "<section id='comments'><h3>Comments</h3><div class='comment'><p>I read it and liked it a lot.</p></div></section>"
        "<form><label>Name</label><button>Send</button></form><div class='sidebar'><p>Some widget text.</p></div><footer>&copy; 2024 Site</footer></body></html>"
    )
    assert text == "Title of it\nFirst paragraph of the article.\nSecond one & last."


# Containers that no training layout has, as sites write them.
UNSEEN_CONTAINERS = (
    '<article class="post hentry category-news tag-politics">', '<article id="follow-up-story">', '<main class="read-more-enabled">', '<article class="newsletter-issue">',
    '<article class="post-4711 type-post status-publish comments-open has-sidebar">', '<main id="search-results-explained">', '<article class="article--banner-top">',
    '<div class="entry tag-economy">', '<section id="story" class="social-theme">', '<article data-x="1" class="card more popular">', '<main role="main" class="content-with-sidebar">',
    '<article class="sponsor-free story">', '<div class="has-sidebar"><article class="h-entry">', '<article class="header-image">', '<article class="footer-dark toc-left">',
)


@pytest.mark.parametrize("opened", UNSEEN_CONTAINERS)
def test_articles_under_misleading_names(model, opened):
    page = (
        "<html><body class='single has-sidebar menu-open'><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>" + opened
        + "<h1>Title of it</h1><p>The first paragraph tells what happened, where and to whom it did.</p><p>Short one.</p><ul><li>a point</li><li>a second point</li></ul>"
        + "<p>The last paragraph, with a <a href='/z'>link</a> in it, says what comes next.</p></" + opened.split()[0][1:].rstrip(">") + ">"
        + ("</article></div>" if opened.startswith("<div class=\"has") else "")
        + "<div class='related-posts'><h3>Related</h3><article class='post'><a href='/o'>Other story</a></article></div>"
        + "<ol class='comment-list'><li><article class='comment-body'><p>I read this one and did not like how it ends.</p></article></li></ol><footer>&copy; 2024 Site</footer></body></html>"
    ).replace("</div></article></div>", "</article></div>")
    want = (
        "Title of it\nThe first paragraph tells what happened, where and to whom it did.\nShort one.\na point\na second point\n"
        "The last paragraph, with a link in it, says what comes next."
    )
    assert hc.Decoder(model).text(page) == want


def test_cases(spark, model):
    frame = spark.createDataFrame(
        [(1, "u", None, "x"), (2, None, "", "x"), (None, "v", "<article><p>a</p></article>", "y"), (4, "w", "<article><p>a</p></article>", "y"), (4, "w", "<article><p>a</p></article>", "y"), (5, "z", "<article>" + "<p>long text here.</p>" * 5000 + "</article>", "z")],
        "page_id long, url string, html string, text string",
    )
    rows = hc.main_texts(frame, model).collect()
    assert sorted(((r.id, r.url, len(r.text)) for r in rows), key=str) == sorted([(1, "u", 0), (2, None, 0), (None, "v", 1), (4, "w", 1), (4, "w", 1), (5, "z", 5000 * 16 - 1)], key=str)
    none = frame.where("false")
    assert hc.main_texts(none, hc.fit(none)).count() == 0
