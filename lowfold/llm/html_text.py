"""Main text of web pages by composite text density.

A page becomes a tree. Parts whose element or whole name says what they are
(menus, adverts, comments and the like) go; a name that only holds such a word
is a hint, which the part's links, fields or thin text must confirm. Every node
left has a density: its characters per tag, adjusted for how many of them stand
in links. The densities of a node's children are summed, and the node with the
largest sum holds the article. On its path to the body, neighbours at least as
dense as the thinnest node of the path belong to it as well, and so does a
heading right before a part that does. The path ends at an ``<article>``, which
is whole but for parts that are thinner than the path and mostly links.
"""

from __future__ import annotations

import html
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import small_batches

# Elements of HTML by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noframes xmp".split())
DROPPED = frozenset("head script style noscript template iframe object embed svg math canvas audio video map nav footer aside button select option input textarea label fieldset menu dialog title noframes xmp datalist".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROOTS = ("article", "main")
#: With two links or more and four fifths of their characters in links, these are menus if their links are short.
LISTS = frozenset(("ul", "ol", "div", "p", "table", "section", "dl"))
#: Characters of a link, on average, from which a list of links is one of titles; a paragraph of links is a menu from three on.
TITLE = 20
CONTAINERS = frozenset(("article", "main", "section", "div", "body", "html", "td", "center", "blockquote", "details"))
#: A start tag ends an open element of these, up to the nearest of the second set.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select"])), "tbody": (frozenset(["tbody", "thead", "tfoot"]), frozenset(["table"])),
}
#: A paragraph ends where one of these begins, and does not reach beyond one of the second set.
ENDS_P = BLOCKS - frozenset(("body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"))
P_SCOPE = frozenset(("td", "th", "table", "button", "caption", "object", "html"))
# Words of class, id and role that name a part to drop, those that do so on an article and a heading
# too, and words that may stand beside them in a name.
NOT_TEXT = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice notices alert toast sidebar sidebars rail "
    "menu menus nav navbar navigation navigational breadcrumb breadcrumbs toc footer masthead toolbar pagination pager share sharing social related recommended recommendations popup modal overlay "
    "newsletter subscribe subscription signup login search widget skip complementary contentinfo".split()
)
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
HINTS = frozenset(("discussion",))
HEADER = frozenset(("header", "topbar", "sitehead"))
BESIDE = frozenset(
    "site page main primary secondary global top bottom left right upper lower mobile desktop sticky fixed inline footer header box boxes wrap wrapper container list lists block blocks bar area zone slot unit "
    "item items link links button buttons icon icons inner outer panel form policy posts articles stories news section region group column col row title heading the by user users reader readers post to us out "
    "media bottom google thread threads count message messages text sponsor label s".split()
)
BESIDE_COMMENTS = BESIDE | frozenset("content body author meta date avatar tree node entry card".split())
FIELDS = frozenset(("input", "textarea", "select", "button"))
#: A hint outside an article is confirmed by fewer characters a tag than this, on less than a quarter of the page.
THIN = 60

#: Quotes matter after an equals sign only; a value that never ends is read as plain characters. A closing quote is
#: looked for in vain at most once a page and kind, since no such quote follows, so values of any length take linear time.
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""(?i)(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_HIDDEN = re.compile(r"(?i)display\s*:\s*none|visibility\s*:\s*hidden")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")


class Page:
    """The tree of one page in document order; a node's parent comes before it."""

    def __init__(self, source: str):
        self.tag: list[str] = ["html"]
        self.parent: list[int] = [-1]
        self.gone: list[bool] = [False]
        self.first: list[int] = [0]  # of the node's events
        self.last: list[int] = [0]
        self.events: list[tuple[int, str | None]] = []  # a node and its text, None for the edge of a block
        self.inside: list[bool] = [False]  # an article
        self.fields: list[int] = [0]  # of a form, right in the node
        self.hinted: list[int] = []
        self.open: list[int] = [0]
        self.paragraphs = 0
        self._read(source)
        while self.open:
            self._pop()

    def _pop(self) -> None:
        node = self.open.pop()
        self.paragraphs -= self.tag[node] == "p"
        if self.tag[node] in BLOCKS:
            self.events.append((node, None))
        self.last[node] = len(self.events)

    def _text(self, text: str) -> None:
        node = self.open[-1]
        if text and not self.gone[node]:
            self.events.append((node, decode(text) if "&" in text else text))

    def _close(self, tags: frozenset[str], scope: frozenset[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in tags:
                while len(self.open) > depth:
                    self._pop()
                return
            if tag in scope:
                return

    def _unwanted(self, tag: str, attributes: str, inside: bool) -> bool | None:
        """Whether a part goes; None where its name is but a hint."""
        if tag in DROPPED:
            return True
        if tag == "header":
            return not inside
        if not attributes or tag in ("html", "body"):
            return False
        hint = False
        for name, *values in _ATTRIBUTE.findall(attributes):
            value = values[0] or values[1] or values[2]
            name = name.lower()
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
                return True
            if name not in ("class", "id", "role"):
                continue
            for token in value.split():
                words = {w.lower() for w in _CAMEL.split(token) if w}
                if words & COMMENTS:
                    if words <= COMMENTS | BESIDE_COMMENTS:
                        return True
                    hint = True
                if tag in ROOTS or tag in HEADINGS:
                    continue
                named = words & NOT_TEXT or (not inside and words & HEADER)
                if named and words <= NOT_TEXT | HEADER | BESIDE and not (name == "id" and inside):
                    return True
                hint = hint or bool(named or words & HINTS)
        return None if hint and tag not in HEADINGS and tag not in ROOTS else False

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._text(" ")
            return
        self.fields[self.open[-1]] += tag in FIELDS and "hidden" not in attributes
        if tag in VOID:
            if tag == "hr":
                self.events.append((self.open[-1], None))
            return
        if tag == "html":
            return
        if tag == "body" or (tag == "head" and "body" in self.tag):
            if "body" in self.tag:
                return
            while len(self.open) > 1:
                self._pop()
        if self.paragraphs and tag in ENDS_P:
            self._close(frozenset(["p"]), P_SCOPE)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
            self._pop()
        up = self.open[-1]
        self.tag.append(tag)
        self.parent.append(up)
        unwanted = self._unwanted(tag, attributes, self.inside[up])
        self.gone.append(self.gone[up] or bool(unwanted))
        self.fields.append(0)
        if unwanted is None or tag == "form":
            self.hinted.append(len(self.tag) - 1)
        self.inside.append(self.inside[up] or tag in ROOTS)
        self.paragraphs += tag == "p"
        self.first.append(len(self.events))
        self.last.append(len(self.events))
        self.open.append(len(self.tag) - 1)
        if tag in BLOCKS:
            self.events.append((len(self.tag) - 1, None))

    def _end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            self._text(" ")
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[depth]] == tag or (tag in HEADINGS and self.tag[self.open[depth]] in HEADINGS):
                while len(self.open) > depth:
                    self._pop()
                return
            # An inline end tag does not reach out of the block it stands in.
            if tag not in BLOCKS and tag not in DROPPED and self.tag[self.open[depth]] in BLOCKS:
                return

    def _read(self, source: str) -> None:
        at, lower, end_of_tags = 0, None, source.rfind(">") + 1
        while True:
            found = _TOKEN.search(source, at, max(at, end_of_tags))
            if not found:
                self._text(source[at:])
                return
            self._text(source[at : found.start()])
            at = found.end()
            end, tag, attributes = found.groups()
            if not tag:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
                continue
            self._start(tag, attributes)
            if tag in RAW and not attributes.endswith("/"):
                if lower is None:
                    lower = source.translate(_LOWER)
                stop = lower.find(f"</{tag}", at)
                at = len(source) if stop < 0 else stop


_LOWER = {c: c + 32 for c in range(65, 91)}
_COMMON = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def decode(text: str) -> str:
    """Character references as characters; texts with only the commonest ones go by replacement."""
    if sum(text.count(r) for r, _ in _COMMON) == text.count("&"):
        for reference, character in _COMMON:
            text = text.replace(reference, character)
        return text
    return html.unescape(text)


def _count(page: Page) -> tuple[list[int], list[int], list[int], list[int]]:
    """Characters, those in links, tags and links below each node that is not gone."""
    n = len(page.tag)
    chars, links, tags, anchors = [0] * n, [0] * n, [0] * n, [0] * n
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[page.parent[i]] or page.tag[i] == "a"
    for node, text in page.events:
        if text and not page.gone[node] and not text.isspace():
            size = len(text) - text.count(" ")
            chars[node] += size
            links[node] += size if linked[node] else 0
    for i in range(n - 1, 0, -1):
        if not page.gone[i]:
            up = page.parent[i]
            chars[up] += chars[i]
            links[up] += links[i]
            tags[up] += tags[i] + 1
            anchors[up] += anchors[i] + (page.tag[i] == "a")
    return chars, links, tags, anchors


def _drop(page: Page, nodes: list[int]) -> None:
    for i in nodes:
        page.gone[i] = True
    for i in range(1, len(page.tag) if nodes else 0):
        page.gone[i] = page.gone[i] or page.gone[page.parent[i]]


def _confirmed(page: Page) -> list[int]:
    """Forms that are not the page's text, and parts whose names are hints that they confirm."""
    if not page.hinted:
        return []
    chars, links, tags, _ = _count(page)
    n = len(page.tag)
    fields, paragraphs, heads = list(page.fields), [0] * n, [False] * n
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        fields[up] += fields[i]
        paragraphs[up] += paragraphs[i] + (page.tag[i] == "p")
        heads[up] = heads[up] or heads[i] or page.tag[i] in ("h1", *ROOTS)
    found = []
    for i in page.hinted:
        if page.tag[i] == "form" and not (heads[i] or (2 * chars[i] > chars[0] and paragraphs[i] > 1)):
            found.append(i)
        elif page.tag[i] != "form" and not heads[i]:
            few = 4 * chars[i] < chars[0]
            if 2 * chars[i] < chars[0] and (3 * links[i] >= chars[i] or fields[i]) or (few and not page.inside[i] and chars[i] < THIN * max(1, tags[i])):
                found.append(i)
    return found


def _menus(page: Page) -> list[int]:
    chars, links, _, anchors = _count(page)
    found = []
    for i in range(1, len(page.tag)):
        if page.tag[i] in LISTS and anchors[i] > 1 and not page.gone[i] and 5 * links[i] >= 4 * chars[i]:
            if links[i] < TITLE * anchors[i] and (page.tag[i] != "p" or (anchors[i] > 2 and not page.inside[i])):
                found.append(i)
    return found


def _densities(page: Page) -> tuple[list[float], list[float], list[int], list[int], list[int]]:
    """Density and sum of the children's densities of each node, its characters, also those in links, and its links."""
    n = len(page.tag)
    chars, links, tags, anchors = _count(page)
    body = next((i for i, tag in enumerate(page.tag) if tag == "body"), 0)
    share = links[body] / max(1, chars[body])
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if chars[i] and not page.gone[i]:
            c, lc, t, lt = chars[i], links[i], max(1, tags[i]), max(1, anchors[i])
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            inner = c / max(1, lc) * t / lt
            density[i] = c / t * (math.log(inner) / math.log(base) if base > 1.0000001 else math.log(inner + 1.0)) if inner > 0 else 0.0
        if i and not page.gone[i]:
            total[page.parent[i]] += density[i]
    return density, total, chars, links, anchors


def _chosen(page: Page) -> list[tuple[int, int]]:
    """Stretches of events that hold the article."""
    _drop(page, _confirmed(page))
    _drop(page, _menus(page))
    density, total, chars, links, anchors = _densities(page)
    best = max(range(len(page.tag)), key=lambda i: (total[i], chars[i], -i))
    if not chars[best]:
        best = max(range(len(page.tag)), key=lambda i: (chars[i], i))
    if not chars[best]:
        return []
    while page.tag[best] not in CONTAINERS and page.parent[best] >= 0:
        best = page.parent[best]
    path = [best]
    while page.parent[path[-1]] >= 0:
        path.append(page.parent[path[-1]])
    body = next((k for k, i in enumerate(path) if page.tag[i] == "body"), len(path) - 1)
    least = min(density[i] for i in path[: body + 1])
    article = next((k for k, i in enumerate(path) if page.tag[i] == "article"), None)
    on_path = set(path)
    if article is not None:
        best = path[article]
        beside = [i for i in range(best + 1, len(page.tag)) if page.parent[i] in on_path and page.parent[i] >= best and i not in on_path]
        _drop(page, [i for i in beside if page.tag[i] in LISTS and page.tag[i] != "p" and density[i] < least and 2 * links[i] >= chars[i] and 0 < links[i] < TITLE * anchors[i]])
        return [(page.first[best], page.last[best])]
    taken = {best}
    after: dict[int, int] = {}  # the next node with text beside one of the path's, from the last one back
    for i in range(len(page.tag) - 1, 0, -1):
        up = page.parent[i]
        if up not in on_path or up == best or not chars[i] or page.gone[i]:
            continue
        if i not in on_path and ((density[i] >= least and 2 * links[i] < chars[i]) or (page.tag[i] in HEADINGS and after.get(up) in taken | on_path)):
            taken.add(i)
        after[up] = i
    return sorted((page.first[i], page.last[i]) for i in taken)


def extract(source: str | None) -> str:
    """The article of one page, blocks parted by an empty line; empty for a page without text."""
    if not source:
        return ""
    page = Page(source)
    blocks: list[str] = []
    for first, last in _chosen(page):
        pieces: list[str] = []
        for node, text in [*page.events[first:last], (0, None)]:
            if text is not None:
                if not page.gone[node]:
                    pieces.append(text)
            elif pieces:
                blocks.append(" ".join("".join(pieces).split()))
                pieces = []
    return "\n\n".join(b for b in blocks if b)


def main_text(source: Column) -> Column:
    """``extract`` as a column; a null page has the empty text. Rows are independent."""
    return F.pandas_udf(lambda pages: pages.map(extract), "string")(source)


def texts(pages: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html_col``; other columns pass through, an empty table stays empty."""
    small_batches(pages.sparkSession)
    return pages.withColumn(name, main_text(F.col(html_col)))


def query(spark, sf: str) -> DataFrame:
    out = texts(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html"), name="text")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
