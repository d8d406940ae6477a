import time

import pytest
from lakejobs.llm.html_extraction import StyleParams, extract_text, main_text, style_nodes, host_of
from pyspark.sql import functions as F

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="<p>no</p>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Menu</a></ul></nav><!-- no -->
<div class="cookie-notice">Cookies!</div><div class="ad">Buy</div>
<article class=post><header><h1>Title &amp; more</h1></header><p><b>First
  line.<br><p>Second &eacute;&#233;&#x41; <a href='x>y'>link</a>, it<span class="ad">buy</span> ends
<ul><li>one<li>two</ul><table><tr><td>a<td>b</table><aside>Aside</aside>
<section id="comments"><p>Comment</p></section><form><p>Form</p></form><p hidden>Hidden</p></article>
<footer>&copy; host</footer></body></html>"""
TEXT = "Title & more\nFirst line.\nSecond ééA link, it ends\none\ntwo\na\nb"


def test_one_page():
    assert main_text(PAGE) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   \n ", ""),
        ("plain text &lt;3", "plain text <3"),
        ("<p>a<p>b", "a\nb"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<article>cut &am", "cut &am"),
        ("<article><p>x</p><div class='", "x"),
        ("<article><p>a < b and c > d</p></article>", "a < b and c > d"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
        ("<script>never closed <p>x</p>", ""),
        ("<article><p>a  \t b</p></article></p></div>", "a b"),
        ("<article>" + "<div>" * 500 + "deep", "deep"),
        ("<p>" + "word " * 50_000, ("word " * 50_000).strip()),
    ],
)
def test_odd_pages(page, text):
    assert main_text(page) == text


@pytest.fixture(scope="module")
def site(spark):
    body = "<html><body><div class='box'>Follow us on all channels</div><div class='main'><p>Story {0} is new</p><p>Its end {0}</p></div></body></html>"
    rows = [(i, f"https://one.example.com/{i}", body.format(i)) for i in range(30)]
    rows += [(100, "http://two.example.com", "<p>Follow us on all channels</p>"), (101, None, None), (102, "", ""), (102, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("host", F.lit("other")).withColumn("text", F.lit("y"))


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_repeated_branches_go_on_both_ways(site, limit):
    got = extract_text(site, StyleParams(broadcast_nodes=limit))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    rows = sorted((r.page_id, r.text, r.n_chars) for r in got.collect())
    want = [(i, f"Story {i} is new\nIts end {i}") for i in range(30)]
    want += [(100, "Follow us on all channels"), (101, ""), (102, ""), (102, "")]
    assert rows == sorted((i, text, len(text)) for i, text in want)


def test_importance(site):
    nodes = style_nodes(site.withColumn("host", host_of(F.col("url"))), StyleParams()).filter("host = 'one.example.com'").collect()
    values = sorted(r.importance for r in nodes)
    assert values[0] == pytest.approx(0, abs=1e-9) and values[-1] > 0.8


def test_articles_stay_however_often_they_occur(spark):
    page = "<article><h1>Same</h1><p>Same text</p><div class='share'>Share</div><div class='x1'>Read more news</div></article>"
    rows = [(i, "http://h/", page.replace("Same text", f"Same text{'' if i % 9 else i}")) for i in range(60)]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).filter("page_id = 1").first()
    assert got.text == "Same\nSame text"


def test_empty_table(spark):
    assert extract_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='site has-sidebar'><article><p>in</p></article></div>", "in"),
        ("<div id=page class='comments-enabled'><p>in</p></div>", "in"),
        ("<div class=sidebar><article><p>in</p></article></div>", "in"),
        ("<div class=widget><p>in</p></div>", "in"),
        ("<article><div class=entry-header><h1>Title</h1></div><h2 id=related-work>Work</h2><section id=search-methods><p>in</p></section></article>", "Title\nWork\nin"),
        ("<article><h2 id=related>Related</h2><p>in</p><div class=share>no</div></article>", "Related\nin"),
        ("<article><p>in</p></article><div id=comments><article><p>no</p></article></div>", "in"),
        ("<div class=ad>no</div><p>in</p>", "in"),
    ],
)
def test_names_do_not_take_the_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("end", ["", "<p>end</p>"])
@pytest.mark.parametrize("broken", ["a<", "<div class='", '<p a="', "<p ", "</", "<!", "<!-", "<a '\"><b '>", "< ", "<?x", "<div class='x", "<a \"'\" '"])
def test_broken_markup_takes_time_in_proportion(broken, end):
    page = "<p>start</p>" + broken * (2_000_000 // len(broken)) + end
    started = time.process_time()
    text = main_text(page)
    assert time.process_time() - started < 4
    assert text.startswith("start")


def test_broken_markup_is_no_text():
    assert main_text("<p>x</p>" + "<p " * 1000) == "x"
    assert main_text("<p>x</p>" + "<div class='" * 1001 + "<p>end</p>").endswith("end")
    assert main_text("<p>x</p><div class='a\"><p>end</p>") == "x\nend"


@pytest.mark.parametrize(
    "name",
    "comment-list user-comments comments-area site-header site-footer main-nav related-posts share-buttons ad-container sidebar-left "
    "post-comments reader-comments comments_section topbar-menu".split(),
)
def test_names_with_words_for_a_place(name):
    part = f"<div class='{name}'><p>no</p></div>"
    assert main_text(f"<article><p>in</p>{part}<p>too</p></article>") == "in\ntoo"
    assert main_text(f"{part}<div><p>in</p></div>") == "in"
    assert main_text(f"<div class='{name}'><article><p>in</p></article></div>") == "in"
    assert main_text(f"<div class='{name}'><p>all there is</p></div>") == "all there is"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>in</p></article><article class=comment><p>no</p></article>", "in"),
        ("<article><p>in</p></article><section class=replies><article><p>no</p></article></section>", "in"),
        ("<article><div class=post-header><h1>Title</h1></div><p>in</p></article>", "Title\nin"),
        ("<div class=article-header><h1>Title</h1></div><div class=post><p>in</p></div>", "Title\nin"),
        ("<article class='post comments-open'><p>in</p></article>", "in"),
        ("<article class=comment><p>a page of one comment</p></article>", "a page of one comment"),
    ],
)
def test_comments_as_articles_and_headers_of_posts(page, text):
    assert main_text(page) == text
