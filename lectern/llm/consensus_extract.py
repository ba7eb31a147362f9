"""Main text of web pages by consensus host paths.

First every page scores its own containers: from the deepest element that holds most of the page's text outside links
and boilerplate it climbs to the article around it, or as far as the further text is not boilerplate; to the body itself
if headings or paragraphs stand right in it. That is its candidate, written as a generalised path of tags and classes
(digits replaced, ids left out; a long path by its hash). Spark counts the votes of each host's pages for their paths.
Then every page is read again with its host's winning path; a page without such an element, or with no text in it, uses
its own candidate.

A class or id marks boilerplate if all its words are marking or neutral ones, so `post-search-engines` does not; an
element that holds most of the text of a page without an article is not dropped for its name. Reading takes time in proportion to the page,
however deep its elements are nested.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import stored

SHARE = 0.7
SENT_HOSTS = 200_000

#: Element kinds of HTML, and the words in classes and ids that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody tfoot thead "
                    "tr ul").split())
CONTAINERS = frozenset("html body main article section div center td".split())
CLOSES_P = BLOCKS - {"html", "body"}
OUTSIDE = frozenset(("head title nav footer aside form button select textarea option label dialog menu noscript template "
                     "iframe object svg canvas audio video annotation annotation-xml").split())
BREAKING = frozenset("head title nav footer aside form dialog menu".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
RAW = "script|style|noscript|template|textarea|iframe|svg|title"
MARKED = frozenset((
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer masthead topbar cookie cookies consent "
    "gdpr notice notices notification popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended recommendations comments comment disqus respond responses replies reply pagination pager toolbar search "
    "skip").split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Words that may stand beside a marking one in a class or id.
NEUTRAL = frozenset((
    "area author avatar bar block body bottom box btn button buttons card cards center col column container content count "
    "date fixed float floating form full global google group header heading holder icon icons id info inline inner item "
    "items label large law left link links list main media meta mobile modal number outer page panel policy popular position "
    "post posts primary right row secondary section site slot small space sticky text this title toggle top trail unit user "
    "view wide wrap wrapper").split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<close2>/?)(?P<tag2>[a-z][^\s/>]*+)[^>]*+(?:>|\Z)",
    re.S | re.I)
_ATTRIBUTE = re.compile(r"""([a-z][\w:-]*+)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_DIGITS = re.compile(r"\d+")
_VALUE = re.compile(r"""=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++)""")
_PATH_CHARS = 300


@dataclass(slots=True)
class Element:
    tag: str
    step: str
    path_id: int
    above: int
    container: int
    mark: int
    outside: bool
    in_header: bool
    in_article: bool


@dataclass
class Page:
    """Elements of a page in page order and its blocks: (container, text, characters outside links), boilerplate left
    out."""
    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)

    def path(self, at: int) -> str:
        """Steps of the containers down to one, or its hash if that is long; '' for the page as a whole."""
        steps, size, n = [], 0, at
        while n > 0 and size <= _PATH_CHARS:
            if self.elements[n].tag in CONTAINERS:
                steps.append(self.elements[n].step)
                size += len(steps[-1]) + 1
            n = self.elements[n].above
        return "/".join(reversed(steps)) if size <= _PATH_CHARS else f"#{self.elements[at].path_id:016x}"


def _below(path_id: int, step: str) -> int:
    return xxhash.xxh64_intdigest(step.encode(), path_id)


def path_number(path: str) -> int:
    """The hash that the elements at a path have."""
    if path.startswith("#"):
        return int(path[1:], 16)
    number = 0
    for step in path.split("/") if path else ():
        number = _below(number, step)
    return number


def _named_boilerplate(name: str) -> bool:
    parts = [p.lower() for p in _PARTS.findall(name)]
    return any(p in MARKED for p in parts) and all(p in MARKED or p in NEUTRAL or p.isdigit() for p in parts)


def _hidden(tag: str, found: dict[str, str], attrs: str) -> bool:
    """Attributes say that the element is not shown or not content."""
    if tag in ("html", "body", "main"):
        return False
    if found.get("role", "").lower() in ROLES or found.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    return "hidden" in attrs.lower() and ("hidden" in found or "hidden" in _VALUE.sub("", attrs).lower().split())


def _marked(tag: str, found: dict[str, str]) -> bool:
    """A class or id says that the element is boilerplate; headings and articles are never judged by theirs."""
    if tag in ("html", "body", "main", "article") or tag in HEADINGS:
        return False
    return any(_named_boilerplate(name) for name in (*found.get("class", "").split(), found.get("id", "")))


def _is_header(tag: str, found: dict[str, str]) -> bool:
    if tag == "header" or tag not in ("div", "section"):
        return tag == "header"
    names = [[p.lower() for p in _PARTS.findall(n)] for n in (*found.get("class", "").split(), found.get("id", ""))]
    return any("header" in parts and all(p == "header" or p in NEUTRAL or p in MARKED or p.isdigit() for p in parts) for parts in names)


def read_page(html: str) -> Page:
    """Parses a page leniently: unclosed and stray tags are put up with, a cut page ends where it is cut."""
    page = Page()
    elements = page.elements
    elements.append(Element("", "", 0, -1, 0, -1, False, False, False))
    stack = [0]
    places: dict[str, list[int]] = defaultdict(list)  # where each open tag stands in the stack
    blocks: list[tuple[int, int, str, int]] = []
    text: list[str] = []
    text_at = linked = 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                top = elements[text_at]
                blocks.append((top.mark, top.container, joined, max(0, len(joined) - linked)))
            text.clear()
        linked = 0

    def keep(raw: str) -> None:
        nonlocal linked, text_at
        top = elements[stack[-1]]
        if top.outside or (top.in_header and not any(places[h] for h in HEADINGS)):
            return
        if not text:
            text_at = stack[-1]
        piece = entities.unescape(raw) if "&" in raw else raw
        text.append(piece)
        if places["a"]:
            linked += len(piece.strip())

    def close(tag: str) -> None:
        if not places[tag]:
            return
        n = places[tag][-1]
        if any(_breaks(elements[i]) for i in stack[n:]):
            flush()
        while len(stack) > n:
            places[elements[stack.pop()].tag].pop()

    def ends(tag: str, within: tuple[str, ...]) -> None:
        """Closes an open ``tag`` that nothing in ``within`` shields."""
        if places[tag] and not any(places[w] and places[w][-1] > places[tag][-1] for w in within):
            close(tag)

    at = 0
    for token in _TOKEN.finditer(html):
        if token.start() > at:
            keep(html[at:token.start()])
        at = token.end()
        tag = (token["tag"] or token["tag2"] or "").lower()
        if not tag:
            continue
        if token["close"] or token["close2"]:
            close(tag)
            if tag in ("td", "th") and text:
                text.append(" ")
            continue
        if tag == "br":
            if text:
                text.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in CLOSES_P:
            ends("p", ("td", "th", "button", "object"))
        if tag == "li":
            ends("li", ("ul", "ol"))
        elif tag in ("td", "th"):
            ends("td", ("table", "tr"))
            ends("th", ("table", "tr"))
        elif tag == "tr":
            ends("tr", ("table",))
        elif tag in ("dt", "dd"):
            ends("dt", ("dl",))
            ends("dd", ("dl",))
        elif tag in HEADINGS:
            if elements[stack[-1]].tag in HEADINGS:
                close(elements[stack[-1]].tag)
        elif tag in ("body", "main", "article"):
            for open_tag in ("head", "title", "nav", "footer", "aside") if tag != "article" else ("head", "nav", "footer"):
                ends(open_tag, ())
        if tag in BLOCKS or tag in BREAKING:
            flush()
        attrs = token["attrs"] or ""
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attrs)} if "=" in attrs else {}
        above, number = elements[stack[-1]], len(elements)
        step, path_id, container = "", above.path_id, above.container
        if tag in CONTAINERS:
            classes = sorted({_DIGITS.sub("#", c.lower()).replace("/", "|") for c in found.get("class", "").split()})
            step = ".".join((tag, *classes))
            path_id, container = _below(above.path_id, step), number
        header = _is_header(tag, found)
        outside = above.outside or tag in OUTSIDE or (header and not above.in_article) or (bool(attrs) and _hidden(tag, found, attrs))
        mark = above.mark
        if not outside and found and _marked(tag, found):
            if tag in BLOCKS:
                mark = number
            else:
                outside = True
        elements.append(Element(tag, step, path_id, stack[-1], container, mark, outside, above.in_header or header,
                                above.in_article or tag in ("article", "main")))
        places[tag].append(len(stack))
        stack.append(number)
    if at < len(html):
        keep(html[at:])
    flush()
    page.blocks = _unmarked(elements, blocks)
    return page


def _breaks(element: Element) -> bool:
    return element.tag in BLOCKS or element.tag in BREAKING


def _unmarked(elements: list[Element], blocks: list[tuple[int, int, str, int]]) -> list[tuple[int, str, int]]:
    """The blocks outside marked elements. On a page with no article or main outside them, a marked element with two
    thirds of the text does not count as one."""
    total = sum(len(text) for _, _, text, _ in blocks)
    named = any(mark < 0 and elements[at].in_article for mark, at, _, _ in blocks)
    below: dict[int, int] = defaultdict(int)
    for mark, _, text, _ in blocks:
        below[mark] += len(text)
    # An element's mark is the nearest marked one that is itself or above it.
    outer = {n: elements[elements[n].above].mark for n, e in enumerate(elements) if e.mark == n}
    for n in sorted(outer, reverse=True):
        below[outer[n]] += below[n]
    dropped: dict[int, bool] = {-1: False}
    for n in sorted(outer):
        dropped[n] = dropped[outer[n]] or named or 3 * below[n] <= 2 * total
    return [(at, text, size) for mark, at, text, size in blocks if not dropped[mark]]


def candidate(page: Page, share: float = SHARE) -> tuple[str, int]:
    """Path and score of the page's own container; '' if none.

    It is the container around the deepest one with ``share`` of the text outside links: see ``_around``.
    """
    elements = page.elements
    score, length, own, end = ([0] * len(elements) for _ in range(4))
    for at, text, size in page.blocks:
        own[at] += size
        score[at] += size
        length[at] += len(text)
    for n in range(len(elements) - 1, -1, -1):
        end[n] = max(end[n], n + 1)
        if n:
            above = elements[n].above
            score[above] += score[n]
            length[above] += length[n]
            end[above] = max(end[above], end[n])
    best = 0
    for n, element in enumerate(elements):
        if element.tag in CONTAINERS and score[0] and score[n] >= share * score[0]:
            best = n
    best = _around(page, best, score, length, own, end)
    return page.path(best), score[best]


def _around(page: Page, best: int, score: list[int], length: list[int], own: list[int], end: list[int]) -> int:
    """The outermost container around ``best`` whose further text is not boilerplate.

    The nearest article around it always counts. Above that, text that is mostly links and other articles end the
    climb, and so does the nearest main, or the article if there is no main. The body counts if text stands right in it.
    """
    chain, at = [], best
    while at >= 0 and page.elements[at].tag not in ("", "html", "body"):
        if page.elements[at].tag in CONTAINERS:
            chain.append(at)
        at = page.elements[at].above
    tags = [page.elements[n].tag for n in chain]
    if not chain:
        return best
    home = tags.index("article") if "article" in tags else 0
    last = tags.index("main") if "main" in tags else home if "article" in tags else len(chain) - 1
    if last == len(chain) - 1 and not {"article", "main"} & set(tags) and at >= 0 and own[at]:
        chain.append(at)
        last += 1
    articles = [n for n, element in enumerate(page.elements) if element.tag == "article" and length[n]]

    def held(n: int) -> int:
        return bisect_left(articles, end[n]) - bisect_left(articles, n)

    found = chain[home]
    for n in chain[home + 1:last + 1]:
        if 2 * (score[n] - score[found]) < length[n] - length[found] or held(n) > held(found):
            break
        found = n
    return found


def text_below(page: Page, path: str) -> str:
    """Blocks of the elements at ``path``, in page order."""
    wanted = path_number(path)
    inside = [False] * len(page.elements)
    for n, element in enumerate(page.elements):
        inside[n] = (element.above >= 0 and inside[element.above]) or (element.tag in CONTAINERS and element.path_id == wanted)
    return "\n".join(text for at, text, _ in page.blocks if inside[at] or not path)


def host_of(url: Column) -> Column:
    """Host of a URL in lower case, without port or user; '' for a null URL or one without a host."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def page_votes(pages: DataFrame, url_col: str, html_col: str, share: float) -> DataFrame:
    """``host``, ``path``, ``score`` of every page with text."""
    slim = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [candidate(read_page(x.as_py()), share) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.int64())],
                ["host", "path", "score"])

    return slim.mapInArrow(run, "host string, path string, score long").filter("score > 0")


def winning_paths(votes: DataFrame) -> DataFrame:
    """``host``, ``path`` with the most votes, then the highest total score, then the smallest path."""
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score"))
    best = counted.groupBy("host").agg(F.max(F.struct("n", "score")).alias("top"))
    tied = counted.join(best, "host").filter((F.col("n") == F.col("top.n")) & (F.col("score") == F.col("top.score")))
    return tied.groupBy("host").agg(F.min("path").alias("path"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  share: float = SHARE, sent_hosts: int = SENT_HOSTS) -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` of every row of ``pages``.

    Null and empty pages, and pages without an article, give an empty text. Pages without a host vote among
    themselves. Repeated rows come back repeated; ids may be null; other columns are not read. The winning paths (a
    row per host) are sent to all tasks while there are at most ``sent_hosts``; beyond that pages and paths meet in a
    shuffle, where adaptive execution splits hosts with many pages.
    """
    winners = stored(winning_paths(page_votes(pages, url_col, html_col, share)), "host-paths")
    if winners.limit(sent_hosts + 1).count() <= sent_hosts:
        winners = F.broadcast(winners)
    slim = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"),
                        host_of(F.col(url_col)).alias("host"))
    id_type = slim.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, path in zip(batch.column(2), batch.column(3), strict=True):
                page = read_page(html.as_py())
                wanted = path.as_py()
                text = text_below(page, wanted) if wanted is not None else ""
                texts.append(text or text_below(page, candidate(page, share)[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["_id", "_url", "text", "n_chars"])

    joined = slim.join(winners, "host", "left").select("_id", "_url", "_html", "path")
    return (joined.mapInArrow(run, f"_id {id_type}, _url string, text string, n_chars long")
            .withColumnsRenamed({"_id": id_col, "_url": url_col}))
