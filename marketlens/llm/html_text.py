"""Main text of a web page by tree scoring.

The page becomes a tree of its block elements.  Each paragraph earns points for its length and commas, passes them to its
parent and half of them to its grandparent, and every container's sum is discounted by the share of its text inside links.  The
best container is kept, with those siblings that score well beside it; inside, parts that are not the article's own text
(menus, headers, footers, forms, notices, comments and so on) are dropped.  A page is handled on its own, inside the task that
reads it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: Siblings of the best container are kept from this share of its points on, and from this many points.
SIBLING_SHARE, SIBLING_LEAST = 0.2, 10.0

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.S)

_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_DROPPED = {
    "nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "svg", "object", "audio", "video",
    "canvas", "head", "map", "fieldset", "label", *_RAW,
}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
    "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
    "tr", "ul",
}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: What ends when one of these starts.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
_LIMITS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "option": {"select"}}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
#: Words in a class or id that tell what is not the article.
_ASIDE = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "banner", "banners", "sponsor", "sponsored", "promo",
    "promoted", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "rail", "widget", "widgets", "header",
    "masthead", "footer", "foot", "copyright", "comment", "comments", "commentlist", "respond", "replies", "disqus", "discussion",
    "reader", "notice", "notices", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "toolbar", "pagination", "pager",
    "skip", "search", "alert", "paywall",
}
#: Elements that may well carry such a word for the whole page or article.
_NEVER_ASIDE = {"html", "body", "article", "main"}


class _Node:
    __slots__ = ("tag", "parent", "aside", "items", "points", "chars", "linked")

    def __init__(self, tag: str, parent: _Node | None, aside: bool):
        self.tag, self.parent, self.aside = tag, parent, aside
        self.items: list = []  # text pieces, blocks and None for a break
        self.points, self.chars, self.linked = 0.0, 0, 0


def _is_aside(tag: str, attributes: str) -> bool:
    if tag in _DROPPED:
        return True
    if not attributes or tag in {"html", "body"}:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), unescape(value.strip("\"'")).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and value in _ROLES:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
        if name in {"class", "id"} and (tag not in _NEVER_ASIDE or "comment" in value) and any(w in _ASIDE for w in re.split(r"[^a-z]+", value)):
            return True
    return False


def _tree(html: str) -> _Node:
    root = at = _Node("html", None, False)
    links = 0
    pos, n = 0, len(html)
    skip_inline: list[str] = []  # inline elements that are being dropped, as a span of an advert

    def text(piece: str) -> None:
        if piece and not skip_inline:
            piece = unescape(piece)
            at.items.append(piece)
            size = len(piece.strip())
            at.chars += size
            at.linked += size if links else 0

    while pos < n:
        m = _MARKUP.search(html, pos)
        if m is None:
            text(html[pos:])
            break
        text(html[pos:m.start()])
        pos = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if skip_inline and tag == skip_inline[-1] and m[1]:
            skip_inline.pop()
            continue
        if skip_inline and tag == skip_inline[-1] and tag not in _VOID:
            skip_inline.append(tag)
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            elif tag in _BLOCKS:
                node = at
                while node is not None and node.tag != tag:
                    node = node.parent
                if node is not None and node.parent is not None:
                    at = node.parent
                    skip_inline.clear()
                    links = 0
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(html, pos)
            pos = end.end() if end else n
            continue
        if tag == "br":
            at.items.append(" ")
        elif tag == "hr":
            at.items.append(None)
        elif tag == "a":
            links += 1
        elif tag in _BLOCKS:
            if tag in {"html", "body"} and at.parent is None:
                continue
            if tag in _ENDS:
                node = at
                while node is not None and node.tag not in _LIMITS[tag]:
                    if node.tag in _ENDS[tag]:
                        at = node.parent
                        break
                    node = node.parent
            if tag not in {"html", "body"}:
                while at.tag == "p" or (at.tag in _HEADINGS and tag in _HEADINGS):
                    at = at.parent
            links = 0
            skip_inline.clear()
            child = _Node(tag, at, _is_aside(tag, m[3]))
            at.items.append(child)
            at = child
        elif tag not in _VOID and not m[3].rstrip().endswith("/") and _is_aside(tag, m[3]):
            skip_inline.append(tag)
    return root


def _words(items: list) -> str:
    return " ".join("".join(x for x in items if isinstance(x, str)).split())


def _walk(node: _Node) -> Iterator[_Node]:
    """Kept nodes, parents first; no recursion, as pages may nest deeply."""
    todo = [node]
    while todo:
        x = todo.pop()
        yield x
        todo += [c for c in reversed(x.items) if isinstance(c, _Node) and not c.aside]


def _score(root: _Node) -> list[_Node]:
    nodes = list(_walk(root))
    for x in nodes:
        own = _words(x.items)
        if not own:
            continue
        points = (1 + own.count(",") + min(len(own) / 100, 3)) * (1 - min(1.0, x.linked / max(1, x.chars)))
        target = x.parent if x.tag in {"p", "pre", "li", "td", "dd", "blockquote", *_HEADINGS} and x.parent is not None else x
        target.points += points
        if target.parent is not None:
            target.parent.points += points / 2
    for x in reversed(nodes):  # text of all below, for the link density
        if x.parent is not None:
            x.parent.chars += x.chars
            x.parent.linked += x.linked
    for x in nodes:
        x.points *= 1 - x.linked / max(1, x.chars)
    return nodes


def _blocks(node: _Node) -> list[str]:
    """Texts of the kept blocks in page order; text beside blocks is a block of its own."""
    out: list[str] = []
    todo: list = [node]
    run: list[str] = []

    def close() -> None:
        piece = " ".join("".join(run).split())
        if piece:
            out.append(piece)
        run.clear()

    end = object()
    while todo:
        x = todo.pop()
        if x is end or x is None:
            close()
        elif isinstance(x, str):
            run.append(x)
        elif x.aside:
            close()
        else:
            close()
            todo.append(end)
            todo += reversed(x.items)
    close()
    return out


def main_text(html: str | None) -> str:
    """The article's text, a line per block; empty if there is none."""
    if not html:
        return ""
    root = _tree(html)
    nodes = _score(root)
    best = max(nodes, key=lambda x: x.points)
    if best.points <= 0:
        return "\n".join(_blocks(root))
    # An article or main element around the best container is the container.
    node = best
    while node is not None:
        if node.tag in {"article", "main"}:
            best = node
            break
        node = node.parent
    if best.parent is None or best.tag in {"article", "main"}:
        chosen = [best]
    else:
        least = max(SIBLING_LEAST, SIBLING_SHARE * best.points)
        chosen = [
            x for x in best.parent.items
            if isinstance(x, _Node) and not x.aside and (x is best or x.points >= least or (
                x.tag in {"p", *_HEADINGS, "pre", "blockquote", "ul", "ol"} and x.chars > 0 and x.linked < 0.3 * x.chars))
        ]
    return "\n".join(line for x in chosen for line in _blocks(x))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``page_id, url, html``.

    A null or empty page has an empty text.  Null ids and urls are kept, repeated pages get a row each, other columns are not
    read, and an empty table gives no rows.  Very long pages are read whole.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1000):
                b = whole.slice(lo, 1000)
                texts = [main_text(x.as_py()) for x in b.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(read, "page_id long, url string, text string, n_chars long")
