import math
import random

import numpy as np
import pytest

from ledgerlake.llm.htmltree import main_text
from ledgerlake.llm.op8_vector_search import Approximation, search_block, top_k
from ledgerlake.llm.op9_html_extraction import extract


def brute_top(rows, k, every):
    whole = []
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((vec_id, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    whole = sorted(set(whole))
    out = []
    for q, a in whole:
        if q % every == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b)))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def vectors(seed, n, size):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(size)] for _ in range(5)]
    return [[c + rng.gauss(0, 0.03) for c in rng.choice(centres)] for _ in range(n)]


@pytest.mark.parametrize("k", [5, 40])
def test_top_k_equals_brute_force(spark, monkeypatch, k):
    from ledgerlake.llm import op8_vector_search

    monkeypatch.setattr(op8_vector_search, "BLOCK", 60)
    monkeypatch.setattr(op8_vector_search, "QUERY_BLOCK", 8)
    rows = list(enumerate(vectors(1, 300, 16)))
    hot = rows[3][1]
    rows += [(1000 + i, hot) for i in range(150)]  # a vector that many rows share
    rows += [(2000, None), (2010, [None] * 16), (2020, [float("nan")] + [0.0] * 15), (2030, [float("inf")] * 16),
             (None, hot), (50, rows[50][1]), (2040, [0.0] * 16), (3000, [1.0, 2.0]), (3010, [2.0, 1.0]), (-10, hot),
             (4000, [])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, label string, rank int")
    found = sorted(tuple(r) for r in top_k(frame, k=k, every=10).collect())
    assert found == brute_top(rows, k, 10)
    assert top_k(frame.limit(0)).count() == 0
    assert top_k(frame.where("vec_id = 51"), every=50).count() == 0


def test_bounds_hold_and_few_vectors_are_read():
    data = np.floor(256 * np.array(vectors(2, 500, 32))).astype(np.int64)
    a = Approximation(data.min(0).astype(float), data.max(0).astype(float))
    assert (a.upper(a.cells(data), data[:40].astype(float)) >= data[:40] @ data.T).all()
    found = search_block(np.arange(500), data, np.arange(40), data[:40], a, 5)
    for q, v, score in found:
        assert score == data[q] @ data[v] and q != v
    assert len(found) == 200


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p><article>";</script></head>
<body class="with-sidebar"><header><h2>Site name, with a slogan, and more</h2></header>
<nav><ul><li><a href=/a>one</a><li><a href=/b>two</a></ul></nav><!-- ad --><div class="ad">Buy, buy, and buy this now, dear reader.</div>
<div id="cookie-notice"><p>We use cookies, many of them, on every page, for you.</p></div>
{body}
<aside><p>Beside the text, there is more, to read, and to see, today.</p></aside>
<div class="comments"><div class="comment"><p>I, a reader, disagree with all, of this, and more.</p></div></div>
<form><p>Your name, please, and your address, and your age.</p><input></form>
<footer>&copy; someone</footer></body></html>"""
BODY = "<h1>A &amp; B</h1><p>First,   paragraph,\n with <b>bo</b>ld text, and an entity &eacute;&#33;<br>next line, still long<p>Short.<ul><li>x<li>y</ul><p><i>Last paragraph, long enough to count, surely."
TEXT = "A & B First, paragraph, with bold text, and an entity é! next line, still long Short. x y Last paragraph, long enough to count, surely."


@pytest.mark.parametrize("wrap", [
    "<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<section>{}</section>",
    "<div><div id=content>{}</div></div>", "<article><div class=body>{}</div></article>",
    "<article>{}<div class='share-buttons'>share this</div><section id=comments><p>No, never, not, at, all, I say, no.</p></section></article>"])
def test_article_without_the_rest(wrap):
    assert main_text(PAGE.format(body=wrap.format(BODY))) == TEXT


@pytest.mark.parametrize("odd", ["<![foo]>", "<![1]>", "<![ x]>", "<![]>", "<![CDATA[q]]>", "<![CDATA[q>", "<![if !IE]>",
                                 "<![if IE>", "<![temp>", "<!x>", "<!>"])
def test_nothing_is_cut_behind_declarations(odd):
    assert main_text(f"<p>a</p>{odd}<p>b</p><p>c [d]> e ]]> f</p>") == "a b c [d]> e ]]> f"


def test_pages_that_stand_in_a_form():
    field = "<label>Name</label><input><select><option>one, two, three, four, five, six</select>"
    for attrs in ("", " id=aspnetForm", " id=form1 class='main-form'"):
        page = PAGE.format(body=f"<form{attrs}><input><div>{BODY}</div></form>")
        assert main_text(page) == TEXT
        assert main_text(f"<html><body><form{attrs}><input type=hidden><article>{BODY}</article></form></body></html>") == TEXT
    assert main_text(f"<body><form>{field}</form></body>") == ""
    assert main_text(f"<body><div>{BODY}</div><form>{field}</form></body>") == TEXT


LONG_BODY = "".join(f"<p>Sentence {i}, with commas, and words, of which the article is made.</p>" for i in range(12))
LONG_TEXT = " ".join(f"Sentence {i}, with commas, and words, of which the article is made." for i in range(12))


@pytest.mark.parametrize("attrs", ['class="elementor-widget-container"', 'class="page left-sidebar"', 'id="modal"',
                                   'class="story-text post-share-wrap"', 'class="subscription-page"'])
def test_names_do_not_take_the_article(attrs):
    assert main_text(PAGE.format(body=f"<div {attrs}>{LONG_BODY}</div>")) == LONG_TEXT


def test_headline_and_parts_of_an_article_stay():
    page = f'<article><h1 class="notice-title">The head</h1>{LONG_BODY}</article>'
    assert main_text(PAGE.format(body=page)) == "The head " + LONG_TEXT
    assert main_text(PAGE.format(body=f"<div><article>{LONG_BODY}</article><article>{LONG_BODY}</article></div>")) \
        == LONG_TEXT + " " + LONG_TEXT
    teasers = "".join(f"<article><a href=/{i}>Another story, of which more</a></article>" for i in range(6))
    assert main_text(PAGE.format(body=f"<div><article>{LONG_BODY}</article>{teasers}</div>")) == LONG_TEXT


def test_comments_longer_than_the_article_go():
    replies = "".join(f"<div class=comment><p>I, reader {i}, say this, and that, and more.</p></div>" for i in range(80))
    for tag in ("div", "section"):
        page = PAGE.format(body=f"<div>{LONG_BODY}</div><{tag} id=comments>{replies}</{tag}>")
        assert main_text(page) == LONG_TEXT


def test_defined_results_of_odd_pages(spark):
    deep = "<div>" * 3000 + "text that lies deep, very deep, in the tree" + "</div>" * 3000
    long = "<article>" + "<p>A sentence, not short, again and again.</p>" * 20_000 + "</article>"
    pages = [(1, "u", None, "t"), (2, "u", "", "t"), (3, None, "<nav>menu</nav>", "t"), (4, "u", "no tags, just text", None),
             (5, "u", deep, "t"), (6, "u", long, "t"), (7, "u", "<article>unclosed <b>article", "t"), (7, "u", "<article>unclosed <b>article", "t"),
             (8, "u", "<article><p>a<![broken <p>", "t"), (9, "u", "<script>only", "t"), (10, "u", "<p>x&nbsp;&lt;y&gt;", "t")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    found = sorted(((r.page_id, r.text, r.n_chars) for r in extract(frame).collect()))
    assert [f[0] for f in found] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10]
    texts = {f[0]: f[1] for f in found}
    assert texts[1] == texts[2] == texts[3] == texts[9] == "" and texts[4] == "no tags, just text"
    assert texts[5].startswith("text that lies deep") and texts[6].count("A sentence") == 20_000
    assert texts[7] == "unclosed article" and texts[8].startswith("a") and texts[10] == "x <y>"
    assert all(f[2] == len(f[1]) for f in found)
    assert extract(frame.limit(0)).columns == ["page_id", "url", "text", "n_chars"]


def test_given_pages(spark):
    """On the given pages the article element is marked: it is what must be found."""
    import html
    import re

    source = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    marked = {r.page_id: r.html for r in source.collect()}
    for r in extract(source).collect():
        body = re.search(r"<article>(.*?)</article>", marked[r.page_id], re.S)[1]
        expected = html.unescape(re.sub(r"<(?:/?p|br|/?h1)>", " ", re.sub(r"</?b>", "", body)))
        assert r.text == " ".join(expected.split())
