import html
import re
import time

import pytest

from lexspark.llm.main_text import extract_main_text, main_text

PROSE = "One sentence, with commas, and enough words to count as a paragraph of text."


def from_template(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    blocks = re.split(r"</?(?:p|h1|br)>", inner)
    return "\n".join(x for x in (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks) if x)


def test_articles_of_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    source = {r["page_id"]: r for r in pages.collect()}
    rows = extract_main_text(pages).collect()
    assert len(rows) == len(source)
    for r in rows:
        assert r["text"] == from_template(source[r["page_id"]]["html"])
        assert r["n_chars"] == len(r["text"]) and r["url"] == source[r["page_id"]]["url"]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("<script>var a = '<p>x</p>';</script><p>y", "y"),
        ("<p>a &lt; b &amp; c&nbsp;d<!-- <p>no</p> --></p>", "a < b & c d"),
        ("<p>an <b>unclosed <i>tag<p>next", "an unclosed tag\nnext"),
        ("<div class='Main-Nav'>menu</div><p>" + PROSE, PROSE),
        ("<header><h1>site</h1></header><main><header><h1>Title</h1></header><p>" + PROSE + "</main>", "Title\n" + PROSE),
        (f"<div><p>{PROSE}</div><div id=comments><p>{PROSE}, {PROSE}, {PROSE}</div>", PROSE),
        (f"<div><p>{PROSE}</p><ul><li>point</li></ul></div><div><a href=x>link, link, link</a></div>", f"{PROSE}\npoint"),
        ("<p title=\"a>b\">x</p><p title='y", "x"),
        ("a < b", "a < b"),
    ],
)
def test_cases(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "wrapper",
    ["div class='content has-sidebar'", "div class='post comments-open'", "div id=site-with-banner", "section class=social"],
)
@pytest.mark.parametrize("inner", ["<article><h1>Title</h1><p>{0}</p><p>{0}</p></article>", "<h1>Title</h1><p>{0}</p><p>{0}</p>"])
def test_wrappers_with_names_of_furniture_keep_the_article(wrapper, inner):
    page = f"<body><div class='main-nav'>menu</div><{wrapper}>{inner.format(PROSE)}</{wrapper.split()[0]}></body>"
    assert main_text(page) == f"Title\n{PROSE}\n{PROSE}"
    comments = f"<div id=comments><article class=comment-body><p>{PROSE * 9}</p></article></div>"
    if "<article>" in inner:
        assert main_text(page.replace("</body>", comments)) == f"Title\n{PROSE}\n{PROSE}"


def test_clean_siblings_stay_without_an_article():
    short = "<p>A plain section of about sixty characters without a comma.</p>"
    page = (
        f"<div><div><h2>One</h2><p>{PROSE}</p><p>{PROSE * 3}</p></div><section>{short}</section>"
        f"<ul><li>first of the points</li><li>second of the points</li></ul>"
        f"<table><tr><td>a cell with its own words</td></tr></table><ul><li><a href=x>a link to some other page</a></ul></div>"
    )
    text = main_text(page)
    for part in ("One", PROSE, PROSE * 3, short[3:-4], "first of the points", "second of the points", "a cell with its own words"):
        assert part in text
    assert "link" not in text


def test_deep_and_long_pages():
    deep = "<div>" * 3000 + PROSE + "</div>" * 3000
    assert main_text(deep) == PROSE
    assert main_text("<p>" + PROSE * 20_000).count("One sentence") == 20_000


@pytest.mark.parametrize(
    ("opening", "closing"),
    [
        ("<blockquote>x", "</blockquote>"), ("<ul><li>x", "</li></ul>"), ("<div>text here", ""), ("<b>x", "</i>"),
        ("<i><div><b>y</i>", ""), ("<header>h", "</header>"), ("<p>para <a href=x>l</a>", "</p>"), ("<td>z", ""),
        ("<section class=comment>q", "</section>"),
    ],
)
def test_work_grows_with_the_page_only(opening, closing):
    """50,000 nested or unclosed elements of each kind."""
    start = time.perf_counter()
    main_text(opening * 50_000 + closing * 50_000)
    assert time.perf_counter() - start < 20


def test_references_do_not_span_tags():
    assert main_text("<p>a &am<b>p;</b> &amp;amp; &lt;b&gt;</p>") == "a &amp; &amp; <b>"


def test_odd_and_no_pages(spark):
    rows = [(1, None, None, 5), (2, "u", "", 5), (2, "u", "<p>x", 5), (2, "u", "<p>x", 5), (None, "v", "<p>y", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    found = sorted((r["text"], r["n_chars"]) for r in extract_main_text(pages).collect())
    assert found == [("", 0), ("", 0), ("x", 1), ("x", 1), ("y", 1)]
    assert extract_main_text(pages.limit(0)).count() == 0
