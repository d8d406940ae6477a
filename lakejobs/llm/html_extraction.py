"""Main text of web pages, with a style tree per site.

Pages of one host are merged by the style of their elements: an element's node is its path of tags and
classes. A node's importance mixes two entropies over the host's pages: how much the presentation of
its children varies, and how much the text below it does. Text that many pages repeat counts little.
What has a known role (menus, adverts, forms, comments, ...) is left out by its tag or role, or by its class
or id if a whole name says so and the page's text does not stand in it; what has none goes when its branch
is of low importance on its host.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.shared import chunks

# Element names by what they do to text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg math title textarea select object canvas noframes".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul caption".split()
)
_CLOSES_P = _BLOCK - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "dd", "dt", "li"}
# An opening tag ends an open element of these names, up to one of the second.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# What is never main text, by element, by role, and by word of a class or id.
_CHROME_TAGS = frozenset("nav aside footer form menu dialog button head fieldset".split())
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_CHROME_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "notification overlay pager pagination popup promo promoted promotion related replies reply respond search share sharing sidebar "
    "signin signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
# Words that say where a part stands or what it looks like, beside one of those above.
_PLACE_WORDS = frozenset(
    "area block bottom box button buttons container global inner left link links list main mobile outer panel post posts "
    "primary reader right secondary section site thread top user wrap wrapper".split()
)
_NEVER_CHROME = frozenset(("html", "body", "main", "article"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*>""", re.S)
# For pages in which a quote inside a tag is never closed.
_TAG_UNQUOTED = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<[!?/][^>]*>""", re.S)
_MARKUP = re.compile("<(?=[a-zA-Z/!?])")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _RAW}
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_SPACE = re.compile(r"\s+")


@dataclass(frozen=True)
class StyleParams:
    """A branch goes when its importance is below `least` on at least `pages` pages of its host.

    `mix` is the weight of what stands below an element against how its children are presented. Low
    branches are sent to every task up to so many of them, counted first; beyond, pages meet them in a join.
    """

    least: float = 0.1
    pages: int = 10
    mix: float = 0.9
    broadcast_nodes: int = 1_000_000


@dataclass
class Element:
    tag: str
    node: int
    parent: Element | None
    styled: bool
    chrome: bool
    article: bool
    main: bool
    children: list[str]
    skipped: bool = False
    named: bool = False


@dataclass
class Block:
    text: str
    home: Element


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text and "hidden" not in text:
        return {}
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)}


def _is_chrome(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in _NEVER_CHROME:
        return False
    if tag in _CHROME_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in _CHROME_ROLES or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    return False


def _is_named(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a whole class or id names chrome: words for it alone, or with words for its place.

    Headings and parts of names do not count. A header is one of the site only if its name says so, as articles
    and posts have their own. Of articles, only those named as comments count.
    """
    if not attributes or tag in _HEADINGS or (tag in _NEVER_CHROME and tag != "article"):
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()
    return any(_names_chrome(frozenset(re.split("[-_]+", name.strip("-_"))), tag) for name in names)


def _names_chrome(words: frozenset[str], tag: str) -> bool:
    known = words & _CHROME_WORDS
    if tag == "article" and not words & {"comment", "comments", "reply", "replies"}:
        return False
    if "header" in known and len(words) > 1:
        return words <= {"header", "site", "main", "top", "global"} or words <= _CHROME_WORDS
    return bool(known) and words <= _CHROME_WORDS | _PLACE_WORDS


def _settle_names(blocks: list[Block], elements: list[Element]) -> None:
    """Make named branches chrome, but not what the page's articles or main element, or else all its text, stand in."""
    if not any(x.named for x in elements):
        return
    within: dict[int, bool] = {}
    # Elements come after those they stand in.
    for x in elements:
        above = x.parent
        while above is not None and id(above) not in within and above.parent is not None:
            above = above.parent
        within[id(x)] = x.named or (above is not None and within.get(id(above), False))
    own = [x for x in elements if x.tag in ("article", "main") or x.article or x.main]
    own = [x for x in own if not x.chrome]
    spared: set[int] = set()
    if own:
        # Only if none stands outside: comments, too, come as articles.
        if all(within[id(x)] for x in own):
            spared = {id(y) for x in own if x.parent is None or not (x.parent.article or x.parent.main) for y in _ancestors(x)}
    else:
        left = [x for x in blocks if not x.home.chrome]
        if all(within.get(id(x.home), False) for x in left):
            spared = {id(x) for x in elements if x.named}
    gone: set[int] = set()
    for x in elements:
        above = x.parent
        while above is not None and id(above) not in within and above.parent is not None:
            above = above.parent
        if (x.named and id(x) not in spared) or (above is not None and id(above) in gone):
            gone.add(id(x))
            x.chrome, x.article, x.main = True, False, False


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """The page's blocks of text with their elements, in order, and all elements that are blocks."""
    root = Element("", _hash(""), None, False, False, False, False, [])
    stack, blocks, elements = [root], [], []
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts)).strip())
            parts.clear()
            text = text.strip()
            if text:
                home = next(x for x in reversed(stack) if x.tag in _BLOCK or x is root)
                blocks.append(Block(text, home))

    def close(names: tuple[str, ...], within: tuple[str, ...]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                flush()
                del stack[depth:]
                return
            if stack[depth].tag in within:
                return

    at, tags, closing = 0, _TAG, page.rfind(">")
    while at < len(page):
        opening = _MARKUP.search(page, at)
        if not stack[-1].skipped:
            parts.append(page[at : opening.start() if opening else len(page)])
        if opening is None:
            break
        at = opening.start()
        if at > closing and not page.startswith("<!--", at):
            # Nothing is closed any more: what looks like a tag is left out as far as the next.
            at = page.find("<", at + 1)
            if at < 0:
                break
            continue
        match = tags.match(page, at)
        if match is None and tags is _TAG:
            # Some quote is open to the end, which is looked for once in a page.
            tags = _TAG_UNQUOTED
            match = tags.match(page, at)
        if match is None:
            parts.append("<")
            at += 1
            continue
        at = match.end()
        if match[2] is None:
            continue
        tag = match[2].lower()
        if match[1]:
            if any(x.tag == tag for x in stack):
                if tag in _BLOCK:
                    flush()
                while stack.pop().tag != tag:
                    pass
            elif tag in _BLOCK:
                flush()
            continue
        if tag in _RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in _BLOCK:
            flush()
            if tag in _CLOSES_P:
                close(("p",), ("article", "section", "div", "td", "th", "li", "blockquote", "main", "aside", "body"))
            if tag in _ENDS:
                close(*_ENDS[tag])
        elif tag == "br":
            parts.append(" ")
        if tag in _VOID:
            continue
        attributes = _attributes(match[3])
        above = stack[-1]
        style = f"{tag}.{'.'.join(sorted(attributes.get('class', '').split()))}#{attributes.get('role', '')}"
        named = _is_named(tag, attributes)
        # Inside a line a name decides at once; of blocks, when the page is known.
        chrome = above.chrome or _is_chrome(tag, attributes, above.article) or (named and tag not in _BLOCK)
        article = (above.article or tag == "article" or "articlebody" in attributes.get("itemprop", "").lower()) and not chrome
        main = (above.main or tag == "main" or attributes.get("role") == "main" or article) and not chrome
        if tag in _BLOCK or chrome != above.chrome:
            above.children.append(style)
        # Elements inside a line share their block's node.
        node = _hash(f"{above.node}>{style}") if tag in _BLOCK else above.node
        styled = bool(attributes.get("class") or attributes.get("id"))
        # Inside a line, what has a role of its own is skipped without dividing the line.
        skipped = above.skipped or (chrome and not above.chrome and tag not in _BLOCK)
        element = Element(tag, node, above, styled, chrome, article, main, [], skipped, named)
        if match[3].endswith("/") and tag not in _BLOCK:
            continue
        stack.append(element)
        if tag in _BLOCK:
            elements.append(element)
    flush()
    _settle_names(blocks, elements)
    return blocks, elements


def _ancestors(element: Element) -> Iterator[Element]:
    here: Element | None = element
    while here is not None and here.parent is not None:
        yield here
        here = here.parent


def main_text(page: str | None, low: frozenset[int] | set[int] = frozenset()) -> str:
    """The page's main text: its articles' blocks, else those of its main element, else all, without what is none.

    `low` holds the nodes of low importance on the page's host. In an article only branches with a style of
    their own can go by it, as an article that many pages repeat is still an article.
    """
    blocks, _ = parse(page or "")
    own = [x for x in blocks if not x.home.chrome]
    for wanted in ("article", "main"):
        if any(getattr(x.home, wanted) for x in own):
            own = [x for x in own if getattr(x.home, wanted)]
            break

    def unimportant(block: Block) -> bool:
        for x in _ancestors(block.home):
            if x.tag in _NEVER_CHROME:
                return False
            if x.node in low and (x.styled or not (x.article or x.main)):
                return True
        return False

    return "\n".join(x.text for x in own if not (low and unimportant(x)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def style_nodes(pages: DataFrame, params: StyleParams) -> DataFrame:
    """(host, node, importance, pages): the merged tree of each host, as far as nodes occur on enough pages."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        above: dict[int, tuple[int, ...]] = {}

        def flush() -> pa.RecordBatch:
            rows = [(host, node, kind, what, n, list(above[node])) for (host, node, kind, what), n in seen.items()]
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            columns = zip(*rows, strict=True) if rows else [[]] * 6
            seen.clear()
            above.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["host", "node", "kind", "what", "n", "above"]
            )

        for batch in batches:
            for part in chunks(batch, "html"):
                for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                    blocks, elements = parse(page or "")
                    # A page counts once for each text and each presentation of a node.
                    found = {(host, x.home.node, 0, _hash(x.text)) for x in blocks}
                    found |= {(host, x.node, 1, _hash("|".join(x.children))) for x in elements if x.children}
                    seen.update(found)
                    for x in [*(b.home for b in blocks), *elements]:
                        if x.node not in above:
                            above[x.node] = tuple(dict.fromkeys(y.node for y in _ancestors(x)))
                if len(seen) > 200_000:
                    yield flush()
        yield flush()

    schema = "host string, node long, kind int, what long, n long, above array<long>"
    rows = pages.select("host", "html").mapInArrow(collect, schema)
    counted = rows.groupBy("host", "node", "kind", "what").agg(F.sum("n").alias("n"), F.any_value("above").alias("above"))
    # Of m occurrences, a text on k pages has an entropy of ln k / ln m: 0 on one page, 1 on all.
    sums = counted.groupBy("host", "node", "kind").agg(
        F.sum("n").alias("m"),
        F.sum(F.col("n") * F.log("n")).alias("spread"),
        F.any_value("above").alias("above"),
    )
    share = F.when(F.col("m") > 1, F.col("spread") / (F.col("m") * F.log("m"))).otherwise(F.lit(0.0))
    text = F.col("kind") == 0
    # Texts count for all nodes above, presentations for their own, in one pass over the parsed pages.
    nodes = F.when(text, F.col("above")).otherwise(F.array("node"))
    rated = sums.select("host", "kind", "m", (1 - share).alias("varies"), F.explode(nodes).alias("node"))
    pages_below = F.sum(F.when(text, F.col("m")))
    joined = (
        rated.groupBy("host", "node")
        .agg(
            (F.sum(F.when(text, F.col("varies") * F.col("m"))) / pages_below).alias("content"),
            F.coalesce(F.max(F.when(~text, F.col("varies"))), F.lit(0.0)).alias("shown"),
            pages_below.alias("pages"),
        )
        .filter(F.col("pages") >= params.pages)
    )
    importance = F.lit(params.mix) * F.col("content") + F.lit(1 - params.mix) * F.col("shown")
    return joined.select("host", "node", importance.alias("importance"), "pages")


def _site_key(host: str, node: int) -> int:
    return _hash(f"{host} {node}")


def extract_text(pages: DataFrame, params: StyleParams | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    `pages` needs `page_id`, `url` and `html`; other columns are ignored. A null or empty page has the text
    ''. Pages without a readable host, or with a null url, are one site. Blocks are what block elements
    divide; in a block, white space is one space; blocks are joined by newlines. Character references are
    decoded. A tag that no '>' ends is left out up to the next '<'; where a quote in a tag is never closed, tags end at
    their first '>'. Time grows with a page's length, however broken. Repeated rows each come out and count as pages of their own.
    """
    params = params or StyleParams()
    sited = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    low = style_nodes(sited, params).filter(F.col("importance") < params.least).select("host", "node")
    few = low.limit(params.broadcast_nodes + 1).toArrow()
    schema = "page_id long, url string, text string, n_chars long"

    def made(part: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        columns = [part.column("page_id").cast(pa.int64()), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    if few.num_rows <= params.broadcast_nodes:
        keys = np.sort(np.array([_site_key(h, n) for h, n in zip(few.column(0).to_pylist(), few.column(1).to_pylist(), strict=True)], np.int64))

        class Low(frozenset):
            """The host's nodes among all low ones."""

            host = ""

            def __bool__(self) -> bool:
                return len(keys) > 0

            def __contains__(self, node: int) -> bool:
                key = _site_key(self.host, node)
                at = np.searchsorted(keys, key)
                return at < len(keys) and keys[at] == key

        def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes = Low()
            for batch in batches:
                for part in chunks(batch, "html"):
                    texts = []
                    for host, page in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
                        nodes.host = host
                        texts.append(main_text(page, nodes))
                    yield made(part, texts)

        return sited.mapInArrow(extract, schema)

    def extract_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                rows = zip(part.column("html").to_pylist(), part.column("low").to_pylist(), strict=True)
                yield made(part, [main_text(page, set(nodes or ())) for page, nodes in rows])

    # A host's low nodes are as many as its templates have, whatever its number of pages.
    sites = low.groupBy("host").agg(F.collect_set("node").alias("low"))
    return sited.join(sites, "host", "left").mapInArrow(extract_joined, schema)
