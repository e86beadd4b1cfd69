"""Main text of web pages by tag-path ratios.

A page becomes a row of text nodes, each with its path of tags from the root. Text and punctuation are added up for
every path: a path that carries much punctuated text per node is content wherever it occurs, however short one of its
nodes is. A node's weight fuses both ratios of its path; weights are smoothed over the row, so that a heading or a short
line among paragraphs rises with them, and those over a threshold are content nodes. The smallest element that holds
nearly all weight of the content nodes, and beside which no text blocks stand, is the article; what stands in it is
returned whole, but for the elements that are boilerplate by their kind (menus, forms, comments of readers, adverts and
the like). An element is not boilerplate by its name alone: one that has half of the text around it stays.
"""

from __future__ import annotations

import html as characters
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import blocks, packed

#: Part of the content nodes' text that the article must hold; the smallest such element is where it is sought.
HOLD = 0.9
#: How far smoothing reaches, in nodes to each side.
REACH = 2
# Kinds of elements.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
DROPPED = {"head", "script", "style", "noscript", "template", "nav", "aside", "form", "button", "select", "textarea", "input", "iframe", "svg",
           "canvas", "object", "menu", "dialog", "footer", "title", "xmp", "noembed", "noframes", "datalist"}
#: An open element of the first kind ends before a tag of the second.
ENDS = {
    "p": {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "head": {"body"},
}
ENDERS = {tag for tags in ENDS.values() for tag in tags}
HEAD = {"meta", "link", "title", "style", "script", "base", "noscript", "template", "head", "html"}
#: Blocks that are parts of a text and never all of an article.
FLOW = {"p", "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "figure", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6"}
# Names of boilerplate in class, id or role.
READERS = {"comment", "comments", "commentlist", "disqus", "replies", "respond"}
NAMES = READERS | {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertisements", "advertising", "adsense", "banner", "sponsor", "sponsored", "sponsors",
    "promo", "promos", "promotion", "sidebar", "widget", "widgets", "menu", "navbar", "navigation", "nav", "breadcrumb", "breadcrumbs", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "share",
    "sharing", "social", "related", "recommended", "trending", "popular", "footer", "masthead", "topbar", "toolbar", "pagination", "pager", "disclaimer",
    "copyright", "complementary", "contentinfo", "hidden"}
# What is named after boilerplate and is nothing else.
HOLDERS = {"area", "bar", "block", "box", "button", "buttons", "container", "form", "holder", "icons", "inner", "items", "link", "links", "list", "message",
           "panel", "section", "strip", "text", "thread", "wrap", "wrapper"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？؟]")
TAG = re.compile(r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/?([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)


def boilerplate(words: str) -> str | None:
    """"comments" or "other" if a word of class, id or role names boilerplate: the word is a name (`sidebar`, `side-bar`), ends with
    one (`site-footer`) or is a holder of one (`share-buttons`). A state or a topic (`comments-open`, `related-work`) names none."""
    found = None
    for word in words.split():
        parts = [x for x in re.split(r"[-_]+", word) if x]
        while len(parts) > 1 and (parts[-1] in HOLDERS or parts[-1].isdigit()) and "".join(parts) not in NAMES:
            parts.pop()
        last = "".join(parts) if "".join(parts) in NAMES else parts[-1] if parts else ""
        if last in READERS:
            return "comments"
        if last in NAMES:
            found = "other"
    return found


class Node:
    """An element: its path of tags as a number, and what is summed over it."""

    __slots__ = ("parent", "tag", "path", "dropped", "marked", "article", "inside", "size", "weight")

    def __init__(self, parent: Node | None, tag: str, path: int):
        self.parent, self.tag, self.path, self.size, self.weight = parent, tag, path, 0, 0
        self.article = bool(parent) and (parent.article or tag in ("article", "main"))
        self.dropped, self.marked, self.inside = bool(parent) and parent.dropped, None, False


def said(attributes: str) -> tuple[str, bool]:
    """What class, id and role say, and whether the element is hidden."""
    words, hidden = [], False
    for m in ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            hidden = True
        elif kind != "aria-hidden":
            words += [w for w in value.split() if not w.startswith(("has-", "no-", "with-", "without-"))]
    return " ".join(words), hidden


class Page:
    """Elements in order of their begin, and text nodes as (element, text, block); a block ends at any block tag."""

    def __init__(self, page: str):
        self.paths: dict[tuple[int, str], int] = {}
        self.nodes = [Node(None, "", 0)]
        self.texts: list[tuple[Node, str, int]] = []
        self.stack, self.open, self.block = [self.nodes[0]], Counter(), 0
        at = 0
        while at < len(page):
            sign = page.find("<", at)
            if sign != at:
                self.texts.append((self.stack[-1], page[at:sign if sign >= 0 else len(page)], self.block))
                if sign < 0:
                    break
            m = TAG.match(page, sign)
            if not m:  # the sign itself is text
                self.texts.append((self.stack[-1], "<", self.block))
                at = sign + 1
                continue
            at = m.end()
            if m[1]:
                tag = m[1].lower()
                self.block += tag not in INLINE
                if page[sign + 1] == "/":
                    self.close(tag)
                elif tag not in VOID:
                    self.begin(tag, m[2])
                    if tag in RAW:
                        end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                        at = end.end() if end else len(page)
                        self.cut(len(self.stack) - 1)

    def cut(self, depth: int) -> None:
        self.open.subtract(n.tag for n in self.stack[depth:])
        del self.stack[depth:]

    def close(self, tag: str) -> None:
        if self.open[tag] > 0:
            depth = len(self.stack) - 1
            while self.stack[depth].tag != tag:
                depth -= 1
            self.cut(depth)

    def begin(self, tag: str, attributes: str) -> None:
        if self.open["head"] > 0 and tag not in HEAD:
            self.close("head")
        depth = len(self.stack) - 1 if tag in ENDERS else 0
        while depth > 0:
            if tag in ENDS.get(self.stack[depth].tag, ()):
                self.cut(depth)
            elif self.stack[depth].tag not in INLINE:
                break
            depth -= 1
        parent = self.stack[-1]
        words, hidden = said(attributes) if attributes else ("", False)
        name = f"{tag}.{words.split()[0]}" if words else tag
        node = Node(parent, tag, self.paths.setdefault((parent.path, name), len(self.paths) + 1))
        node.dropped |= tag in DROPPED or hidden or tag == "header" and not node.article
        if words and tag not in ("article", "main", "body", "html"):
            node.marked = boilerplate(words)
        self.nodes.append(node)
        self.stack.append(node)
        self.open[tag] += 1


def upwards(nodes: list[Node], name: str) -> None:
    """Adds what every element has to its parent; children come after their parents."""
    for node in reversed(nodes):
        if node.parent:
            setattr(node.parent, name, getattr(node.parent, name) + getattr(node, name))


def drop_marked(page: Page) -> None:
    """Settles which marked elements are boilerplate, and drops all that stands in dropped ones."""
    for node, text, _ in page.texts:
        node.size += 0 if node.dropped else len(text.strip())
    upwards(page.nodes, "size")
    holds = set()
    for node in page.nodes:
        if node.tag in ("article", "main") and not node.dropped and node.size:
            above = node.parent
            while above and above not in holds:
                holds.add(above)
                above = above.parent
    for node in page.nodes:
        if node.marked and node not in holds:
            scope = node.parent
            while scope.parent and scope.tag not in ("article", "main"):
                scope = scope.parent
            inside = bool(scope.parent) or not holds  # of an article, or a page without any
            node.dropped |= 2 * node.size < scope.size or not inside or node.marked == "comments" and node.size < scope.size
        node.dropped |= bool(node.parent) and node.parent.dropped


def content_nodes(kept: list[tuple[Node, str, int]]) -> list[bool]:
    """Tag-path ratios: the mean text of a path's nodes times a factor for its punctuation, smoothed over the row."""
    length, marks, count = Counter(), Counter(), Counter()
    for node, text, _ in kept:
        length[node.path] += len(" ".join(text.split()))
        marks[node.path] += len(PUNCTUATION.findall(text))
        count[node.path] += 1
    fused = {p: length[p] / n * math.log2(2 + marks[p] / n) for p, n in count.items()}
    weights = [fused[n.path] for n, _, _ in kept]
    smooth = []
    for i in range(len(weights)):
        near = weights[max(0, i - REACH):i + REACH + 1]
        smooth.append(sum(near) / len(near))
    mean = sum(smooth) / len(smooth)
    threshold = min(mean, math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth)))
    return [max(w, s) >= threshold for w, s in zip(weights, smooth, strict=True)]


def climbed(article: Node, kept: list[tuple[Node, str, int]]) -> Node:
    """The element that the article is a part of: as long as text blocks stand beside it in its parent. Beside an element of
    the body only headings count, since a page's own lines stand there too."""
    beside: dict[Node, set[str]] = {}
    for node, _, _ in kept:
        while node.parent and node.tag in INLINE | FLOW:
            if node.tag in FLOW:
                beside.setdefault(node.parent, set()).add(node.tag)
            node = node.parent
    while article.parent and article.tag not in ("body", "html"):
        blocks_beside = beside.get(article.parent, set())
        if not {t for t in blocks_beside if t[0] == "h" or article.parent.tag not in ("", "body", "html")}:
            break
        article = article.parent
    return article


def main_text(source: str | None) -> str:
    page = Page(source or "")
    drop_marked(page)
    texts = [(n, characters.unescape(t), b) for n, t, b in page.texts if not n.dropped]
    kept = [x for x in texts if x[1].strip()]
    if not kept:
        return ""
    for (node, text, _), content in zip(kept, content_nodes(kept), strict=True):
        node.weight += len(text.strip()) if content else 0
    upwards(page.nodes, "weight")
    total = page.nodes[0].weight
    article = [n for n in page.nodes if n.weight >= HOLD * total and n.tag not in INLINE and n.tag not in FLOW][-1]
    while article.article and article.tag not in ("article", "main"):
        article = article.parent
    if not article.article:
        article = climbed(article, kept)
    for node in page.nodes:
        node.inside = node is article or bool(node.parent) and node.parent.inside
    out: list[str] = []
    last = None
    for node, text, block in texts:
        if node.inside:
            if block == last:
                out[-1] += text
            else:
                out.append(text)
                last = block
    return " ".join(x for x in (" ".join(b.split()) for b in out) if x)


def page_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in blocks(batches, "html"):
        columns = [batch.column(i).to_pylist() for i in range(3)]
        for page_id, url, page in zip(*columns, strict=True):
            text = main_text(page)
            yield page_id, url, text, len(text)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text (empty if there is none), n_chars (code points) of every row.

    A null page has an empty text; rows stay apart; columns other than the three named are not read. Markup that is cut
    off or wrongly nested is read as far as it goes."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"))
    schema = pa.schema({"page_id": pa.int64(), "url": pa.string(), "text": pa.string(), "n_chars": pa.int64()})
    return rows.mapInArrow(lambda batches: packed(page_rows(batches), schema), "page_id long, url string, text string, n_chars long")
