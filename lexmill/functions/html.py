"""Article text: block choice, markup removal, Unicode normal form."""

from __future__ import annotations

import html.parser
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Entities that the built-in variant decodes.
ENTITIES = [
    ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"), ("&middot;", "·"), ("&bull;", "•"), ("&hellip;", "…"),
    ("&ndash;", "–"), ("&mdash;", "—"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"),
    ("&laquo;", "«"), ("&raquo;", "»"), ("&euro;", "€"), ("&pound;", "£"), ("&lt;", "<"), ("&gt;", ">"),
    ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
]

TAG_MARK = "\x01"
# What the built-in variant reads: whole tags without signs in their values, a declaration, a comment without other
# markup in it, a title without markup. Each pattern stops at the next sign, so no text is looked at twice.
_INSIDE = r"""(?:[\s/][^<>"'&]*+(?:"[^"<>&]*+"[^<>"'&]*+)*+)?+>"""
TAG = r"</?[A-Za-z][A-Za-z0-9]*+" + _INSIDE
COMMENT = r"<!--[^<>-][^<>]*+(?<=[^<>-]--)>"
DECLARATION = r"(?i)<!doctype[^<>]*+>"
# Elements whose content the parser reads in another way; as text they must be empty of signs.
RAW = ("script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "plaintext")
RAW_OPEN = r"(?i)<(?:" + "|".join(RAW) + r")(?![a-z0-9])"


def select_blocks(contents: Column, kind: str = "sanitized_html") -> Column:
    """Contents of the blocks of one type; a missing list, null block or block without a type or
    content gives nothing, and the row stays."""
    chosen = F.filter(contents, lambda b: F.coalesce((b.type == kind) & b.content.isNotNull(), F.lit(False)))
    return F.coalesce(F.transform(chosen, lambda b: b.content), F.array().cast("array<string>"))


def _without_element(markup: Column, tag: str) -> Column:
    """Every `<tag ...> ... </tag>` replaced by a mark: the text is cut at the end tags, and each piece at its first
    start tag, which takes one pass however the tags stand. A piece without a start tag only loses its end tag."""
    pieces = F.split(markup, f"</{tag}>")
    cut = F.transform(pieces, lambda p, i: F.when(i < F.size(pieces) - 1, F.substring_index(p, f"<{tag}", 1)).otherwise(p))
    return F.array_join(cut, TAG_MARK)


def _decoded(text: Column) -> Column:
    """With its entities decoded, in a text whose every `&` begins one: cut there, each piece begins with a name."""
    chars = F.create_map(*[F.lit(x) for name, char in ENTITIES for x in (name[1:-1], char)])
    pieces = F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(
        F.concat(F.try_element_at(chars, F.substring_index(p, ";", 1)), F.substring(p, F.instr(p, ";") + 1, F.length(p)))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def html_to_text(markup: Column, drop_tags: tuple[str, ...] = ()) -> Column:
    """Text nodes joined by one space, the same as `html_to_text_exact`.

    Rows of plain markup and common entities are read with built-in functions. A row that still has a `<` or `&` after
    that (unclosed or nested comments, signs in attributes, other entities, scripts kept as text) goes through the
    parser: by its content, and with the same result."""
    dropped, other = markup, F.contains(markup, F.lit(TAG_MARK))
    for tag in drop_tags:
        dropped = F.when(F.contains(markup, F.lit(f"<{tag}")), _without_element(dropped, tag)).otherwise(dropped)
        other = other | markup.rlike(rf"(?i)<{tag}[^\s/>]")
    raw = "|".join(t for t in RAW if t not in drop_tags)
    other = other | F.regexp_replace(dropped, rf"(?i)<({raw}){_INSIDE}[^<&]*+</\1>", "").rlike(RAW_OPEN)
    marked = dropped
    for pattern in (COMMENT, DECLARATION, TAG):
        marked = F.regexp_replace(marked, pattern, TAG_MARK)
    other = other | marked.rlike("<|&(?!(?:" + "|".join(name[1:] for name, _ in ENTITIES) + "))")
    native = _decoded(F.replace(F.regexp_replace(F.trim(marked, F.lit(TAG_MARK)), r"\x01\x01++", TAG_MARK), F.lit(TAG_MARK), F.lit(" ")))
    return F.coalesce(html_to_text_exact(F.when(other, markup), drop_tags), native)


def html_to_text_exact(markup: Column, drop_tags: tuple[str, ...] = ()) -> Column:
    """As the standard library's event parser sees it: all entities, scripts as text, an unfinished
    entity at the very end lost. Arrow batches through Python, so only where the markup needs it."""
    # Defined here, so that the workers get it by value and need no copy of this package.
    class TextNodes(html.parser.HTMLParser):
        def __init__(self):
            super().__init__()
            self.open_dropped, self.nodes = 0, []

        def handle_starttag(self, tag, attrs):
            self.open_dropped += tag in drop_tags

        def handle_endtag(self, tag):
            if tag in drop_tags and self.open_dropped:
                self.open_dropped -= 1

        def handle_data(self, data):
            if not self.open_dropped:
                self.nodes.append(data)

    def one(text):
        if text is None:
            return None
        parser = TextNodes()
        parser.feed(text)
        return " ".join(parser.nodes)

    def parse(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return F.pandas_udf(parse, StringType())(markup)


def normalize_nfkd(text: Column) -> Column:
    """Unicode NFKD. ASCII text is its own normal form, so only other text is sent to Python."""
    def nfkd(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t))

    other = F.when(text.rlike(r"[^\x00-\x7f]"), text)
    return F.coalesce(F.pandas_udf(nfkd, StringType())(other), text)


def drop_newlines(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(""))


def article_text(contents: Column, exact: bool = False, nfkd: bool = True, drop_tags: tuple[str, ...] = ()) -> Column:
    """One line of plain text per article. The blocks are one document to the parser, so an entity
    split over two blocks is joined."""
    markup = F.array_join(select_blocks(contents), "")
    text = (html_to_text_exact if exact else html_to_text)(markup, drop_tags)
    return drop_newlines(normalize_nfkd(text) if nfkd else text)
