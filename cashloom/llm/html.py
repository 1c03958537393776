"""Main text of web pages by composite text density.

Every element of a page's tree gets a density, its characters per tag corrected for links.
A container's density sum adds up its children's. The container with the largest sum holds
the article; the smallest density on the path from it up to the body is the threshold for
what else on that path belongs to it. Elements that are no article by their own account
(menus, forms, adverts, comments and so on) are left out before anything is measured, but
those that are so by a name, and forms, only if most of the text is elsewhere.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
CONTAINERS = frozenset("body div article section main td blockquote center".split())
HEADINGS = frozenset("h1 h2".split())
KEPT = frozenset("html body article main".split())
ARTICLES = frozenset("article main".split())

DROPPED = frozenset(
    "head script style noscript template iframe svg canvas object nav footer aside button select textarea dialog menu"
    " audio video math datalist".split()
)
"""Elements that never hold article text."""

NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu"
    " breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices popup modal newsletter"
    " subscribe signup login share sharing social related recommended comment comments disqus respond reply replies"
    " pagination pager toolbar topbar contentinfo complementary search dialog alert form widget".split()
)
"""Words of a class, id or role that mark an element as something else than article text, unless it holds most of that."""

COMMENTS = frozenset("comment comments disqus respond reply replies".split())
"""Of those, the words for what readers wrote, which may be longer than the article."""

PLAIN = frozenset(
    "list box left right top bottom block section area slot item items unit bar buttons links inner outer wrap wrapper container"
    " site page global main primary secondary".split()
)
"""Words that may stand beside those in a name without changing what it says."""

HEADERS = frozenset("header masthead".split())
"""Dropped outside an article; inside one they hold its title."""

CLOSED_BY = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
_SCOPE = frozenset("table ul ol dl body html article section main div td th".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*|[0-9]+")


def _named(names: list[str], words: frozenset[str]) -> bool:
    """Whether a whole name says one of ``words``: has-sidebar and social-science do not say sidebar or social."""
    for name in names:
        said = {w.lower() for w in _WORDS.findall(name) if not w.isdigit()}
        if not said.isdisjoint(words) and said <= words | NAMES | PLAIN:
            return True
    return False


class _Tree(HTMLParser):
    """Elements in page order, with the text that lies directly in each."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.ends = ["#root"], [-1], [0]
        self.doubtful: list[int] = []  # no article by a name, or a form
        self.comments: set[int] = set()  # those that readers wrote
        self.pieces: list[tuple[int, str]] = []
        self.open: list[tuple[str, int]] = [("#root", 0)]  # -1 in an element left out
        self.articles = 0

    def _push(self, tag: str, dropped: bool, doubtful: bool, comments: bool = False) -> None:
        above = self.open[-1][1]
        node = -1
        if above >= 0 and not dropped:
            node = len(self.tags)
            self.tags.append(tag)
            self.parents.append(above)
            self.ends.append(node + 1)
            if doubtful:
                self.doubtful.append(node)
                if comments:
                    self.comments.add(node)
            self.articles += tag in ARTICLES
        self.open.append((tag, node))

    def _pop(self) -> None:
        tag, node = self.open.pop()
        if node >= 0:
            self.ends[node] = len(self.tags)
            self.articles -= tag in ARTICLES

    def _break(self) -> None:
        if self.open[-1][1] >= 0:
            self.pieces.append((self.open[-1][1], " "))

    def _close(self, tags: tuple[str, ...], barrier: frozenset[str]) -> None:
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in tags:
                while len(self.open) > at:
                    self._pop()
                return
            if self.open[at][0] in barrier:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in INLINE:
            self._close(("p",), _SCOPE)
            if tag in CLOSED_BY:
                self._close(CLOSED_BY[tag], frozenset(("table", "ul", "ol", "dl", "select")) - {tag})
            self._break()
        dropped, doubtful, comments = tag in DROPPED, False, False
        if not dropped and tag not in KEPT:
            names = [w for k, v in attrs if k in ("class", "id", "role") and v for w in v.split()]
            comments = _named(names, COMMENTS)
            doubtful = tag == "form" or _named(names, NAMES) or (not self.articles and (tag == "header" or _named(names, HEADERS)))
            dropped = any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and re.search(r"display\s*:\s*none", v)) for k, v in attrs)
        self._push(tag, dropped, doubtful, comments)
        if tag in VOID:
            self._pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash ends void elements only

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self._close((tag,), frozenset() if tag in CONTAINERS or tag not in INLINE else _SCOPE)
        if tag not in INLINE:
            self._break()

    def handle_data(self, data: str) -> None:
        if self.open[-1][1] >= 0:
            self.pieces.append((self.open[-1][1], data))


def composite_density(c: int, t: int, lc: int, lt: int, body_lc: int, body_c: int) -> float:
    """Characters per tag, lowered by the share of characters and tags inside links."""
    if c == 0:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + max(body_lc, 0) / max(body_c, 1) * c + math.e)
    ratio = c / max(lc, 1) * max(t, 1) / max(lt, 1)
    # ratios below one would turn the sign; a text that is all links keeps a small density
    return c / max(t, 1) * math.log(max(ratio, 1.0001)) / max(math.log(base + 1e-9), 0.05) if base > 1 else c / max(t, 1) * math.log(max(ratio, 1.0001)) / 0.05


def _inside(tree: _Tree, nodes: list[int]) -> bytearray:
    """Which nodes lie in the subtrees of the given ones."""
    inside = bytearray(len(tree.tags))
    for k in nodes:
        inside[k : tree.ends[k]] = b"\1" * (tree.ends[k] - k)
    return inside


def _within(tree: _Tree) -> list[int]:
    """The innermost article or main element around each node, 0 where there is none."""
    within = [0] * len(tree.tags)
    for k in range(1, len(within)):
        within[k] = k if tree.tags[k] in ARTICLES else within[tree.parents[k]]
    return within


def _left_out(tree: _Tree, in_link: list[bool]) -> bytearray:
    """Which nodes lie in a doubtful element that does not hold most of the page's article text.

    That is the text outside links in the innermost article and main elements, or on a page
    without such text all text outside links. Readers' comments and, as comments and teasers often
    are articles themselves, doubtful elements with articles in them are never article text
    while an article or main element has text outside all doubtful elements.
    """
    n, within = len(tree.tags), _within(tree)
    doubted = _inside(tree, tree.doubtful)
    gone = bytearray(n)
    if any(within[k] and not doubted[k] and not in_link[k] and not piece.isspace() for k, piece in tree.pieces):
        gone = _inside(tree, [k for k in tree.doubtful if k in tree.comments or any(t in ARTICLES for t in tree.tags[k : tree.ends[k]])])
    text, marked, inner = [0] * n, [False] * n, [0] * n
    for k, piece in tree.pieces:
        if not in_link[k] and not gone[k]:
            text[k] += len(" ".join(piece.split()))
    for k in range(n - 1, 0, -1):
        up = tree.parents[k]
        if tree.tags[k] in ARTICLES and not marked[k] and not gone[k]:
            marked[k], inner[k] = True, text[k]
        text[up] += text[k]
        inner[up] += inner[k]
        marked[up] |= marked[k]
    for k in tree.doubtful:
        around = within[k] if inner[0] and inner[within[k]] == text[within[k]] else 0
        held = text[k] if around or not inner[0] else inner[k]
        if held * 2 <= (inner[0] or text[0]):
            gone[k : tree.ends[k]] = b"\1" * (tree.ends[k] - k)
    return gone


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one space; empty where there is none."""
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    while len(tree.open) > 1:
        tree._pop()
    n = len(tree.tags)
    tree.ends[0] = n
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = in_link[tree.parents[k]] or tree.tags[k] == "a"
    if tree.doubtful:
        gone = _left_out(tree, in_link)
        tree.pieces = [x for x in tree.pieces if not gone[x[0]]]
    else:
        gone = bytearray(n)
    for k, text in tree.pieces:
        size = len(" ".join(text.split()))
        chars[k] += size
        link_chars[k] += size * in_link[k]
    for k in range(n - 1, 0, -1):
        if gone[k]:
            continue
        up = tree.parents[k]
        chars[up] += chars[k]
        tags[up] += tags[k] + 1
        link_chars[up] += link_chars[k]
        link_tags[up] += link_tags[k] + (tree.tags[k] == "a")
    density = [composite_density(chars[k], tags[k], link_chars[k], link_tags[k], link_chars[0], chars[0]) for k in range(n)]
    sums = [0.0] * n
    for k in range(1, n):
        sums[tree.parents[k]] += density[k]
    # text that lies directly in a container counts like a child of its own
    for k, text in tree.pieces:
        if text != " " and tree.tags[k] in CONTAINERS and not in_link[k]:
            sums[k] += len(" ".join(text.split()))
    best = max((k for k in range(n) if tree.tags[k] in CONTAINERS and chars[k]), key=lambda k: (sums[k], -k), default=0)

    path = [best]
    while path[-1] > 0:
        path.append(tree.parents[path[-1]])
    # the innermost article element around the densest container is the article; a main element bounds the path like a body
    article = next((k for k in path if tree.tags[k] == "article"), None)
    upto = next((i for i, k in enumerate(path) if tree.tags[k] in ("body", "main")), len(path) - 1)
    if article is not None:
        chosen = [(article, tree.ends[article])]
    else:
        threshold = min(density[k] for k in path[: upto + 1])
        if tree.tags[path[upto]] == "main":
            path = path[: upto + 1]
        on_path = set(path)
        chosen = [(best, tree.ends[best])]
        for k in range(1, n):
            if k not in on_path and tree.parents[k] in on_path and not best <= k < tree.ends[best]:
                if (tree.tags[k] in HEADINGS or density[k] >= threshold) and link_chars[k] * 2 < max(chars[k], 1):
                    chosen.append((k, tree.ends[k]))
    keep = bytearray(n)
    for low, high in chosen:
        keep[low:high] = b"\1" * (high - low)
    if article is None:
        for k in path if path[-1] else path[:-1]:
            # text that lies directly in the ancestors goes with the article
            keep[k] = 1
        keep[0] |= best == 0 or path[-1] == 0 and all(tree.tags[k] != "body" for k in path)
        for k in range(1, n):
            # a cell of links alone is the menu of a page laid out as a table
            if tree.tags[k] in ("td", "th") and link_tags[k] > 1 and link_chars[k] == chars[k]:
                keep[k : tree.ends[k]] = bytes(tree.ends[k] - k)
    # an element break is a space, so blocks come apart whatever the page's own spacing
    return " ".join("".join(text for k, text in tree.pieces if keep[k]).split())


def extract_main_text(pages: DataFrame, *, html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without the html and with its main text and that text's number of code points.

    NULL and empty pages give an empty text, repeated rows repeat. A column of ``pages`` that
    has the name of a new one is replaced.
    """
    kept = [c for c in pages.columns if c not in (html, text, n_chars)]
    source = pages.select(*kept, F.col(html).alias("__html"))
    schema = source.select(*kept).schema.add(text, "string").add(n_chars, "long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(x.as_py()) for x in batch.column("__html")]
            columns = [batch.column(c) for c in kept]
            sizes = pa.array([len(x) for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), sizes], names=[*kept, text, n_chars])

    return source.mapInArrow(rows, schema)
