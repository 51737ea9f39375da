import html
import re

import pytest

from crawlindex.llm import html_text

PAGES = "page_id long, url string, html string, text string, n_chars int, feature string"


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def simple(i, words=60):
    text = " ".join(f"word{j}" for j in range(words))
    return page(
        "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>About</a></li></ul></nav>"
        f"<div class='ad'>Buy this now</div><article><h1>Title {i}</h1><p><b>Lead {i}<br><p>{text}</p></article>"
        "<footer>&copy; someone</footer>"
    ), f"Title {i}\nLead {i}\n{text}"


MESSY = page(
    """<div class="cookie-notice">We use cookies here to track you all day. <button>OK</button></div>
    <header><h1>Site</h1><ul class=menu><li><a href=x>Home</a></ul></header>
    <div id=content class="content main"><h1>Title</h1><div class="share"><a>Tweet</a></div>
    <p>First &amp; only&nbsp;  <i>para</i>graph with 3 < 4 signs of &lt;it&gt; here.
    <p hidden>not shown<p>Second one, quite a bit longer than that.<script>if(a<b){w("<p>x</p>")}</script>
    <!-- <p>old</p> --><div class="ad">Buy now please</div><ul><li>one item<li>two items</ul>
    <form><input name=q><label>Search for it</label></form><p>Last words.</div>
    <div id="comments"><article class="comment"><p>Great post I liked it very very much.</p></article></div>
    <div class="sidebar"><p>Some sidebar text which is rather long and plain.</p></div><footer>(c)</footer>"""
)
MESSY_TEXT = (
    "Title\nFirst & only paragraph with 3 < 4 signs of <it> here.\n"
    "Second one, quite a bit longer than that.\none item\ntwo items\nLast words."
)


@pytest.mark.parametrize("fitted", [True, False])
def test_messy_page(spark, fitted):
    weights = {}
    if fitted:
        rows = [(i, "u", simple(i)[0], "t", 1, "f") for i in range(60)]
        weights = html_text.fit(spark.createDataFrame(rows, PAGES))
        assert weights["word"] > 0 and all(w < 0 for f, w in weights.items() if f.startswith("tag"))
    assert html_text.main_text(MESSY, weights) == MESSY_TEXT


@pytest.mark.parametrize("mark", ["article", "main"])
@pytest.mark.parametrize("weight", [1.0, 0.5])
def test_long_blocks_inside_the_article_part_nothing(mark, weight):
    def words(n, name):
        return " ".join(f"{name}{i}" for i in range(n))

    title, body, last = words(8, "title"), words(300, "body"), words(50, "last")
    aside, comments = words(300, "aside"), words(2_000, "comment")
    text = page(
        f"<nav>{words(300, 'nav')}</nav><{mark}><h1>{title}</h1><aside>{aside}</aside><p>{body}</p>"
        f"<div class=comments><p>{comments}</p></div><p>{last}</p></{mark}>"
        f"<div class=related>{words(300, 'related')}</div><p>{words(5, 'outside')}</p>"
    )
    assert html_text.main_text(text, {"word": weight}) == f"{title}\n{body}\n{last}"


def test_broken_markup_does_not_hang_or_crash():
    for text in ("<", "<p", "<!--", "<script>x", "</p></p>", "<a<b>c", "&#xD800; &bogus; &#0;", "<p a='x", "<" * 20_000, "<p " * 20_000, "<!--" * 20_000, "<![CDATA[x", "<p>\0</p>", "<x y=\"" * 5_000, "<b>" * 50_000 + "</i>" * 50_000 + "</b>" * 50_000):
        html_text.main_text(text, {})


def test_region_is_the_best_of_all():
    import random

    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-2, -1, 1, 2, 0.5]) for _ in range(rng.randint(0, 12))]
        start, end = html_text.region(scores)
        best = max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0)
        assert sum(scores[start:end]) == pytest.approx(max(0, best))


def test_every_row(spark):
    rows = [(i, "u", simple(i)[0], "t", 1, "f") for i in range(30)]
    rows += [(100, None, None, None, None, None), (101, "u", "", "t", 1, "f"), (None, "u", simple(0)[0], "t", 1, "f")]
    rows += [rows[0], (102, "u", simple(7, 40_000)[0], "t", 1, "f")]
    got = html_text.main_texts(spark.createDataFrame(rows, PAGES)).collect()
    want = {i: simple(i)[1] for i in range(30)} | {100: "", 101: "", None: simple(0)[1], 102: simple(7, 40_000)[1]}
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


def test_empty_table(spark):
    assert html_text.main_texts(spark.createDataFrame([], PAGES)).collect() == []


def test_given_pages(spark):
    """The article of every page of the test table, by its own element."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    texts = {r.page_id: r.text for r in html_text.main_texts(pages).collect()}
    for row in pages.collect():
        article = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        blocks = re.split("</?p>|</?h1>|<br>", article)
        clean = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        assert texts[row.page_id] == "\n".join(b for b in clean if b)


def words(n, name):
    return " ".join(f"{name}{i}" for i in range(n))


def links(n):
    return " ".join(f"<a href=/{i}>ref{i}</a>" for i in range(n))


def texts_of(n, name):
    return " ".join(f"{name}{i}" for i in range(n))


TITLE, BODY, LAST = words(8, "title"), words(300, "body"), words(40, "last")
NAV = f"<nav>{links(30)}</nav>"
KINDS = {
    "teaser article below": (
        f"{NAV}<div id=content><h1>{TITLE}</h1><p>{BODY}</p></div><article>short teaser</article>",
        f"{TITLE}\n{BODY}",
    ),
    "teaser article in the content": (
        f"{NAV}<div id=content><h1>{TITLE}</h1><p>{BODY}</p><article>short teaser</article><p>{LAST}</p></div>",
        f"{TITLE}\n{BODY}\n{LAST}",
    ),
    "comments as articles in an unnamed section": (
        f"{NAV}<div><h1>{TITLE}</h1><p>{BODY}</p></div><section>"
        + "".join(f"<article><p>{words(60, f'c{i}x')}</p></article>" for i in range(20)) + "</section>",
        f"{TITLE}\n{BODY}",
    ),
    "comments as articles in the article": (
        f"{NAV}<article><h1>{TITLE}</h1><p>{BODY}</p>"
        + "".join(f"<article><p>{words(60, f'c{i}x')}</p></article>" for i in range(20)) + f"<p>{LAST}</p></article>",
        f"{TITLE}\n{BODY}\n{LAST}",
    ),
    "comments as articles beside the article": (
        f"{NAV}<main><article><h1>{TITLE}</h1><p>{BODY}</p></article><section>"
        + "".join(f"<article><p>{words(60, f'c{i}x')}</p></article>" for i in range(20)) + "</section></main>",
        f"{TITLE}\n{BODY}",
    ),
    "page in one form": (
        f"<form id=aspnet action=/>{NAV}<div><h1>{TITLE}</h1><p>{BODY}</p></div><footer>{words(20, 'f')}</footer></form>",
        f"{TITLE}\n{BODY}",
    ),
    "page in one form, an article in it": (
        f"<form>{NAV}<article><h1>{TITLE}</h1><p>{BODY}</p><form><label>x y</label></form></article></form>",
        f"{TITLE}\n{BODY}",
    ),
    "names that only start or end like boilerplate": (
        f"{NAV}<article><h1>{TITLE}</h1><div class=share-price-report><p>{BODY}</p></div>"
        f"<div class=ad-hoc>{LAST}</div><section id=related-work>{words(30, 'work')}</section>"
        f"<div class=ad-slot>Buy now</div><div class='social-share-buttons'>Share me</div></article>",
        f"{TITLE}\n{BODY}\n{LAST}\n{words(30, 'work')}",
    ),
    "figures": (
        f"{NAV}<article><h1>{TITLE}</h1><p>{LAST}</p>" + "<figure><img src=x></figure>" * 150 + f"<p>{BODY}</p></article>",
        f"{TITLE}\n{LAST}\n{BODY}",
    ),
    "table": (
        f"{NAV}<article><h1>{TITLE}</h1><p>{LAST}</p><table>"
        + "".join(f"<tr><td>{i}</td><td></td><td></td></tr>" for i in range(300)) + f"</table><p>{BODY}</p></article>",
        "\n".join([TITLE, LAST, *map(str, range(300)), BODY]),
    ),
    "links": (
        f"{NAV}<article><h1>{TITLE}</h1><p>{LAST}</p><p>{links(80)}</p><p>{BODY}</p><p>{links(40)}</p></article>",
        f"{TITLE}\n{LAST}\n{texts_of(80, 'ref')}\n{BODY}\n{texts_of(40, 'ref')}",
    ),
    "only links": (
        f"{NAV}<article><p>{links(40)}</p></article><footer>{words(5, 'f')}</footer>",
        texts_of(40, "ref"),
    ),
    "spans": (
        f"{NAV}<article><h1>{TITLE}</h1><p>{LAST}</p>" + "<span></span>" * 900 + f"<p>{BODY}</p></article>",
        f"{TITLE}\n{LAST}\n{BODY}",
    ),
    "spans and figures without a mark": (
        f"{NAV}<div><h1>{TITLE}</h1><p>{LAST}</p>" + "<span></span>" * 900 + "<figure></figure>" * 150
        + f"<p>{BODY}</p></div><footer>{words(9, 'f')}</footer>",
        f"{TITLE}\n{LAST}\n{BODY}",
    ),
    "many articles of one page": (
        f"{NAV}<main><h1>{TITLE}</h1>"
        + "".join(f"<article><h2>entry {i}</h2><p>{words(60, f'e{i}x')}</p></article>" for i in range(6))
        + f"</main><div class=sidebar>{words(50, 's')}</div>",
        "\n".join([TITLE, *(f"entry {i}\n{words(60, f'e{i}x')}" for i in range(6))]),
    ),
    "teasers beside the article in main": (
        f"{NAV}<main><article><h1>{TITLE}</h1><p>{BODY}</p></article>"
        + "".join(f"<article><h3>tease {i}</h3><p>{words(20, f't{i}x')}</p></article>" for i in range(5)) + "</main>",
        f"{TITLE}\n{BODY}",
    ),
    "long comments": (
        f"{NAV}<div class=post><h1>{TITLE}</h1><p>{BODY}</p></div>"
        f"<div class=comments-area><h2>Comments</h2><p>{words(3000, 'c')}</p></div>",
        f"{TITLE}\n{BODY}",
    ),
    "whole page in a named wrapper": (
        f"<div class='widget'>{NAV}<h1>{TITLE}</h1><p>{BODY}</p><footer>{words(9, 'f')}</footer></div>",
        f"{TITLE}\n{BODY}",
    ),
}


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(i, "u", simple(i)[0], "t", 1, "f") for i in range(60)]
    given = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    return [
        {},
        html_text.fit(spark.createDataFrame(rows, PAGES)),
        html_text.fit(given),
    ]


@pytest.mark.parametrize("kind", KINDS)
def test_no_main_text_is_lost(fitted, kind):
    body, text = KINDS[kind]
    for weights in fitted:
        assert html_text.main_text(page(body), weights) == text


def test_names():
    full, part = html_text._USUALLY, html_text._IF_LINKS
    for names, kind in {
        "ad": full, "ad-slot": full, "comments-area": full, "post-comments": full, "sidebarLeft": full,
        "cookie-notice": full, "relatedPosts": full, "ad-300x250": full,
        "ad-hoc": part, "share-price-report": part, "related-work": part, "weather-widget": part,
        "has-sidebar": 0, "article": 0, "unrelated": 0, "headline": 0, "": 0,
    }.items():
        assert html_text._named(names)[0] == kind, names
    assert html_text._named("entry-content")[1] and not html_text._named("price")[1]
