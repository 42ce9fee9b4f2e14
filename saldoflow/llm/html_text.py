"""Main text of web pages by composite text density.

A page becomes a tree of elements with, for each, its characters C, link characters LC, tags T and link tags LT. Its
density is C / T, adjusted by a logarithm that falls with the share of link characters, against the share of the
whole body. The density sum of an element adds up its children's densities. Elements that are no article text by their
tag, or by a class, id or role of a container, are taken out first. The element with the largest sum is the main content; if it
lies in an article, that is. The least density on its path up to the body is the threshold: beside the path, containers stay
that reach it with their density and with their density sum, and so do headings and text blocks that are not mostly links. A
container of bare text has no density sum, so beside the main content it goes.

Text is whole: character references are decoded, white space inside a block becomes one space, blocks are joined in
page order by one newline. Unclosed, misnested and cut-off markup is read as far as it goes. A null or empty page has an empty
text. Null ids and addresses, repeated rows and extra columns are kept out of the way: every row gives one row.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, elements whose content is no markup, blocks, and implied ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCKS - frozenset("br body html td th tr tbody thead tfoot option optgroup legend summary title".split())
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "tbody": frozenset(["tbody", "thead", "tfoot", "tr", "td", "th"]), "tfoot": frozenset(["tbody", "thead", "tr", "td", "th"]),
}
SCOPES = frozenset("table ul ol dl select body html article section div td th".split())

# No article text: by tag, by role, and by a word of the class or id.
DROPPED_TAGS = frozenset(
    "head script style noscript template nav aside footer form button select textarea iframe object embed svg math canvas audio video"
    " menu dialog input label fieldset search map frameset noframes title".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar side aside footer foot masthead banner topbar toolbar"
    " ad ads advert adverts advertisement advertising adsense promo promotion promoted sponsor sponsored sponsors"
    " comment comments commentlist disqus discussion replies reply respond"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login"
    " share sharing social related recommended pagination pager widget copyright legal search skip".split()
)
# Words that a class or id may have beside those above and still name the same thing, as in "site-footer".
NEUTRAL_WORDS = frozenset(
    "site page main global primary secondary top bottom left right middle upper lower inner outer sticky fixed mobile desktop js"
    " box bar list wrapper wrap container content section block item items area panel row col column group slot unit banner header body"
    " post posts article articles entry link links user users form widget div id google gpt dfp text".split()
)
# Elements that hold the words of a text: their class says how they look, not that they lie outside the article.
WORDED_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd td th tr tbody thead tfoot caption figcaption a abbr b bdi bdo big br cite code data del dfn em"
    " font hr i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
# A header is dropped unless it lies in the article, where it holds its title.
HEADER_PARENTS = frozenset(["article", "main", "section"])
ARTICLE_TAGS = frozenset(["article", "main"])
TEXT_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p pre blockquote ul ol dl table figure br hr".split())

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:--!?>|$(?![\s\S]))|<[!?][^>]*(?:>|$(?![\s\S]))"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|$(?![\s\S]))",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]++)\s*+(?:=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++)))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "dropped", "chars", "link_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool):
        self.tag, self.parent, self.dropped = tag, parent, dropped
        self.children: list[Node | str] = []


def _is_dropped(tag: str, attrs: str, parent: Node) -> bool:
    if tag in DROPPED_TAGS:
        return True
    if tag == "header":
        while parent is not None and parent.tag not in HEADER_PARENTS:
            parent = parent.parent
        if parent is None:
            return True
    if not attrs or tag in ("html", "body") or tag in ARTICLE_TAGS:
        return False
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), "".join(values).strip())
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower() or found.get("role", "").lower() in DROPPED_ROLES:
        return True
    return tag not in WORDED_TAGS and any(_names_dropped(x) for x in f"{found.get('class', '')} {found.get('id', '')}".split())


def _names_dropped(name: str) -> bool:
    """Whether a class or id names something outside the article with all its words, as "comment-list" but not "comment-on-law"."""
    words = [w for w in _WORD.findall(_CAMEL.sub("-", name).lower()) if len(w) > 1]
    return not DROPPED_WORDS.isdisjoint(words) and all(w in DROPPED_WORDS or w in NEUTRAL_WORDS for w in words)


def parse(page: str) -> Node:
    """The element tree below a root; text is undecoded, comments and declarations are gone."""
    root = Node("#root", None, False)
    here, at, n = root, 0, len(page)
    while at < n:
        less = page.find("<", at)
        if less < 0:
            here.children.append(page[at:])
            break
        if less > at:
            here.children.append(page[at:less])
        m = _TOKEN.match(page, less)
        if m is None:
            here.children.append("&lt;")
            at = less + 1
            continue
        at = m.end()
        tag = m["name"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            here = _closed(here, tag)
            continue
        here = _opened(here, tag)
        node = Node(tag, here, _is_dropped(tag, m["attrs"], here))
        here.children.append(node)
        if tag in VOID or m["attrs"].endswith("/") and tag in ("svg", "path", "use"):
            continue
        if tag in RAW:
            end = re.compile(f"</{tag}\\b", re.I).search(page, at)
            stop = end.start() if end else n
            if tag == "textarea":
                node.children.append(page[at:stop])
            at = stop
            if end:
                close = page.find(">", stop)
                at = n if close < 0 else close + 1
            continue
        here = node
    return root


def _closed(here: Node, tag: str) -> Node:
    """Where reading goes on after an end tag; one without a start is ignored."""
    node = here
    while node is not None and node.tag != tag:
        if tag not in BLOCKS and node.tag in SCOPES:
            return here
        node = node.parent
    return here if node is None or node.parent is None else node.parent


def _opened(here: Node, tag: str) -> Node:
    """Where a start tag belongs: some elements end those before them."""
    ended = CLOSED_BY.get(tag)
    if tag in CLOSES_P:
        ended = (ended or frozenset()) | {"p"}
    if tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
        ended = ended | {"h1", "h2", "h3", "h4", "h5", "h6"}
    if not ended:
        return here
    node, found = here, None
    while node.parent is not None:
        if node.tag in ended:
            found = node
            if node.tag != "td" and node.tag != "th":
                break
        elif node.tag in SCOPES:
            break
        node = node.parent
    return found.parent if found is not None else here


def _ordered(root: Node) -> list[Node]:
    """Elements that are not dropped, parents first; without recursion, for trees of any depth."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        out.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    return out


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        node.chars = node.link_chars = node.tags = node.link_tags = 0
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(c.strip())
            elif not c.dropped:
                node.chars += c.chars
                node.link_chars += c.link_chars
                node.tags += c.tags + 1
                node.link_tags += c.link_tags + (c.tag == "a")
        if node.tag == "a":
            node.link_chars, node.link_tags = node.chars, node.tags
    body = nodes[0]
    ratio = body.link_chars / max(body.chars, 1)
    for node in reversed(nodes):
        chars, tags = node.chars, max(node.tags, 1)
        if not chars:
            node.density = node.total = 0.0
        else:
            other = max(chars - node.link_chars, 1)
            base = math.log(chars / other * node.link_chars + ratio * chars + math.e)
            value = chars / max(node.link_chars, 1) * tags / max(node.link_tags, 1)
            node.density = chars / tags * max(math.log(max(value, 1.0)), 0.0) / base
            node.total = sum(c.density for c in node.children if isinstance(c, Node) and not c.dropped)


def _contents(root: Node) -> list[Node]:
    """The subtrees to keep, in page order."""
    nodes = _ordered(root)
    _measure(nodes)
    if not root.chars:
        return []
    best = max(nodes, key=lambda x: x.total)
    if best.total == 0:
        return [root]
    threshold, node = best.density, best
    while node.parent is not None and node.parent.tag not in ("#root", "html", "body"):
        node = node.parent
        threshold = min(threshold, node.density)
    whole = _whole(best)
    if whole.tag in ARTICLE_TAGS:
        # The page says what its article is; other articles of the same density belong to the content too.
        return [x for x in nodes if x is whole or x.tag in ARTICLE_TAGS and x.density >= threshold and _whole(x) is x]
    # Beside the path from the body to the best subtree, what is dense enough stays, and headings and text blocks that are not links.
    path = {id(whole)}
    node = whole
    while node.parent is not None:
        node = node.parent
        path.add(id(node))
        for c in node.children:
            if isinstance(c, Node) and not c.dropped and id(c) not in path and min(c.density, c.total) < threshold and not (c.tag in TEXT_BLOCKS and 2 * c.link_chars < max(c.chars, 1)):
                c.dropped = c.tag in BLOCKS
    return [root]


def _whole(node: Node) -> Node:
    """A subtree inside an article stands for the whole article: its title and short blocks belong to it."""
    found, up = node, node
    while up is not None:
        if up.tag in ARTICLE_TAGS:
            found = up
        up = up.parent
    return found


def _blocks(nodes: list[Node]) -> Iterator[str]:
    """Decoded text of the blocks below the nodes, in page order."""
    parts: list[str] = []
    seen: set[int] = set()

    def flush() -> str:
        text = _SPACE.sub(" ", "".join(parts)).strip()
        parts.clear()
        return text

    for top in nodes:
        if id(top) in seen:
            continue
        stack: list[Node | str | None] = [None, top]
        while stack:
            x = stack.pop()
            if x is None:
                yield flush()
            elif isinstance(x, str):
                parts.append(html.unescape(x))
            elif not x.dropped and id(x) not in seen:
                seen.add(id(x))
                block = x.tag in BLOCKS
                if block:
                    yield flush()
                    stack.append(None)
                stack.extend(reversed(x.children))


def main_text(page: str | None) -> str:
    if not page:
        return ""
    return "\n".join(b for b in _blocks(_contents(parse(page))) if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 256):
            part = batch.slice(at, 256)
            texts = [main_text(x) for x in part.column(2).to_pylist()]
            yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
