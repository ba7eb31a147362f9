import re
import time
from html.parser import HTMLParser

import pytest

from lectern.llm import consensus_extract as C
from lectern.llm import queries as Q

MENU = '<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>'
HEAD = "<!DOCTYPE html><html><head><title>Site title</title><style>p{}</style><script>var t='</p>';</script></head><body>"
FOOT = '<div class="sidebar">Side words</div><section id="comments"><p>A reader comment that is rather long, indeed.</p></section><footer>&copy; foot</footer></body></html>'


def page(body, container="div class='post-17 content'"):
    tag = container.split()[0]
    return f"{HEAD}{MENU}<div class='ad'>Buy now</div><{container}>{body}</{tag}>{FOOT}"


def test_article_only():
    body = "<h1>Head &amp; title</h1><p>First   para&nbsp;with <a href='x'>a link</a>,<br>one line.<p>Second\n para.<!-- no --><ul><li>item one<li>item two</ul>" \
           "<table><tr><td>a</td><td>b</td></tr></table><form><label>Name</label><input></form><div class='share-buttons'>Share</div>"
    text = C.text_below(C.read_page(page(body)), C.candidate(C.read_page(page(body)))[0])
    assert text == "Head & title\nFirst para with a link, one line.\nSecond para.\nitem one\nitem two\na b"


@pytest.mark.parametrize("html", ["", "plain text only", "<", "<p", "<p>open <b>bold", "</div></div><p>x", "<script>never ends", "<!-- never ends",
                                  "<a \"'<p>x", "<p>" * 3000 + "deep", "<div>" * 2000 + "deep", "&#99999999; &amp &unknown;"])
def test_broken_pages_do_not_fail(html):
    C.text_below(C.read_page(html), C.candidate(C.read_page(html))[0])


def test_cut_and_nested_pages():
    assert C.text_below(C.read_page("<body><article><h1>T</h1><p>one two</p><p>thr"), "body/article") == "T\none two\nthr"
    nested = "<article><header><h1>Title</h1><span>by line</span></header><p>Body text here.</p><aside>no</aside><div hidden>no</div><div style='display: none'>no</div></article>"
    assert C.text_below(C.read_page(f"<body>{nested}"), "body/article") == "Title\nBody text here."


def test_host_consensus_beats_an_odd_page(spark):
    long = "<p>" + "Words of the article, many of them. " * 12 + "</p>"
    rows = [(i, f"https://User@Site.example:80/p{i}", page(f"<h1>T{i}</h1>{long}")) for i in range(6)]
    odd = f"{HEAD}{MENU}<div class='post-3 content'><p>Short text.</p></div><div class='teasers'>{long}</div>{FOOT}"
    rows += [(10, "http://site.example/odd", odd), (11, "http://other.example/", odd), (12, None, None), (13, "", ""), (14, "nonsense", page(long))]
    rows += [(0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS path", "'y' AS host", "'z' AS text")
    got = C.extract_pages(pages).collect()
    out = {r["page_id"]: r for r in got}
    assert len(got) == len(rows) and out[10]["text"] == "Short text." and "article" in out[11]["text"]
    assert out[0]["text"].startswith("T0\nWords") and out[12]["text"] == "" == out[13]["text"] and out[14]["text"].startswith("Words")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    shuffled = {r["page_id"]: r["text"] for r in C.extract_pages(pages, sent_hosts=1).collect()}
    assert shuffled == {k: r["text"] for k, r in out.items()}
    assert C.extract_pages(pages.limit(0)).count() == 0


def test_winner_has_most_votes_then_score_then_name(spark):
    votes = [("h", "a", 5), ("h", "b", 9), ("h", "b", 1), ("i", "x", 3), ("i", "y", 4), ("j", "n", 2), ("j", "m", 2)]
    got = {r["host"]: r["path"] for r in C.winning_paths(spark.createDataFrame(votes, "host string, path string, score long")).collect()}
    assert got == {"h": "b", "i": "y", "j": "m"}


LEAD = "<h1>Title</h1><p>Lead words.</p><div class='body'><p>" + "Words of the article, many of them. " * 12 + "</p></div><p>Closing words.</p>"
LINKS = "<div class='more'>" + "".join(f"<a href='/{i}'>Another page of this site</a> " for i in range(4)) + "</div>"


@pytest.mark.parametrize(("html", "path"), [
    (f"<article>{LEAD}</article>", "body/article"), (f"<div class=page>{LINKS}<div class=post>{LEAD}</div></div>", "body/div.page/div.post"),
    (f"<main><h1>Top</h1><article>{LEAD}</article></main>", "body/main"), (f"<div id=page><article>{LEAD}</article>{LINKS}</div>", "body/div/article"),
    (f"<main><article>{LEAD}</article><article class='teaser'><p>Another article.</p></article></main>", "body/main/article"),
    (f"<div><main>{LEAD}</main><div>Other words.</div></div>", "body/div/main"), (LEAD, "body")])
def test_heading_lead_and_closing_text_stay(html, path):
    page = C.read_page(f"<body>{html}</body>")
    assert C.candidate(page)[0] == path
    text = C.text_below(page, path)
    if html:
        assert "Title\nLead words.\nWords" in text and text.endswith("Closing words.") and "Another" not in text and "Other" not in text


LONG = "<p>" + "Words of an article that goes on for a while. " * 8 + "</p>"


@pytest.mark.parametrize("container", [
    'article id="post-search-engines"', 'article class="post ad-free"', 'div class="social-science"', 'article data-title="A hidden gem"',
    'article class="post type-post category-social tag-search hentry"', 'div class="sidebar"', 'section id="banner-1"', "div class='has-sidebar'",
    'article class="comments"', 'div title="a > b"'])
def test_an_article_is_not_dropped_for_its_name(container):
    page = C.read_page(f"<body>{MENU}<{container}>{LONG}</{container.split()[0]}><div class='ad'>Buy</div></body>")
    assert C.text_below(page, C.candidate(page)[0]) == C.read_page(LONG).blocks[0][1]


@pytest.mark.parametrize("name", ["ad", "ad-1", "sidebar-left", "cookie-banner", "share-buttons", "related-posts", "site-footer", "commentList comments", "nav_main"])
def test_boilerplate_is_dropped_for_its_name(name):
    for attribute in ("class", "id"):
        page = C.read_page(f'<body><article>{LONG}<div {attribute}="{name}"><p>Something else</p></div></article></body>')
        assert "Something" not in C.text_below(page, C.candidate(page)[0])


def test_parts_of_an_article_stay():
    body = ('<h2 id="related-work">Related work</h2><section id="cookies-and-cream"><p>Mix well.</p></section><p>Let <math><mi>x</mi><annotation>x^2'
            '</annotation></math> be <button>copy</button> positive.</p><p>One <span hidden>no</span><svg><p>no</p></svg>two</p><div hidden="">no</div>')
    page = C.read_page(f"<body><article>{LONG}{body}</article></body>")
    text = C.text_below(page, C.candidate(page)[0]).split("\n")[1:]
    assert text == ["Related work", "Mix well.", "Let x be positive.", "One two"]


def test_different_containers_have_different_paths():
    a, b = (C.read_page(f"<body><div class='a b {c}'>{LONG}</div></body>") for c in "cd")
    assert C.candidate(a)[0] == "body/div.a.b.c" and C.text_below(b, C.candidate(a)[0]) == ""
    deep = C.read_page("<body>" + "<div class='some-longer-name'>" * 40 + f"<article>{LONG}")
    path = C.candidate(deep)[0]
    assert path.startswith("#") and len(path) == 17 and C.text_below(deep, path).startswith("Words of an article")


@pytest.mark.parametrize("html", [
    "<div>" * 100_000 + "x", "<p>" * 100_000 + "x", "<p><button>" + "<div>x" * 30_000, "<span>" * 50_000 + "<p>x" * 30_000, "<div>x" * 50_000,
    "</b>" * 100_000, "<a>" * 50_000 + "</i>x" * 30_000, "<article><div class=ad>" * 20_000 + "x", "<header>" + "<b>x" * 50_000])
def test_time_follows_the_length_of_the_page(html):
    started = time.process_time()
    page = C.read_page(html)
    C.text_below(page, C.candidate(page)[0])
    assert time.process_time() - started < 5


class Plain(HTMLParser):
    """An independent extractor for pages with one article: its text by blocks, but for what is never content."""

    SKIP = {"script", "style", "form", "aside", "nav", "footer", "select", "button", "label", "noscript", "template", "iframe", "title"}

    def __init__(self):
        super().__init__()
        self.inside, self.skipped, self.parts, self.blocks = 0, [], [], []

    def end_block(self):
        joined = " ".join("".join(self.parts).split())
        self.blocks += [joined] if joined else []
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        marked = re.search(r"\b(ad|comments?|sidebar|share|cookie|related)\b", " ".join(v or "" for k, v in attrs if k in ("class", "id")))
        if (tag in self.SKIP or marked) and tag not in C.VOID:
            self.skipped.append(tag)
        if tag == "br":
            self.parts.append(" ")
        elif tag in C.BLOCKS:
            self.end_block()

    def handle_endtag(self, tag):
        if tag in C.BLOCKS:
            self.end_block()
        if self.skipped and self.skipped[-1] == tag:
            self.skipped.pop()
        self.inside -= tag == "article"

    def handle_data(self, data):
        if self.inside > 0 and not self.skipped:
            self.parts.append(data)


def test_query_equals_an_independent_extractor(spark):
    for folder in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
        got = {r["page_id"]: r["text"] for r in Q.QUERIES["op7_consensus_extract"](spark, f"/root/testdata/{folder}").collect()}
        for r in pages.collect():
            plain = Plain()
            plain.feed(r["html"] or "")
            plain.close()
            plain.end_block()
            assert got[r["page_id"]] == "\n".join(plain.blocks), r["page_id"]


def test_odd_pages(spark):
    pages = spark.createDataFrame([(None, None, f"<article>{LONG}"), (1, None, None), (1, None, None)], "page_id long, url string, html string")
    rows = C.extract_pages(pages).collect()
    assert sorted((str(r["page_id"]), r["n_chars"] > 100) for r in rows) == [("1", False), ("1", False), ("None", True)]


def test_host_votes_for_the_whole_article(spark):
    rows = [(i, f"http://site.example/{i}", f"{HEAD}{MENU}<article>{LEAD}</article>{FOOT}") for i in range(5)]
    got = C.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == 5 and all(r["text"].startswith("Title\nLead words.\nWords") and r["text"].endswith("Closing words.") for r in got)
