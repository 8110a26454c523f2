"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. The first pass decides a block by itself: by the
density of stop words, its length and the share of its characters that stand in links; blocks in
elements that hold no article (menus, footers, sidebars, forms, reader comments, adverts; told by
tag, role and by the words of class and id) are boilerplate. What is left undecided, mostly short
blocks, inherits in the second pass the label of the nearest decided neighbours: among the blocks of
the same parent element first, then of the page. Neighbours that are as near and differ make it
boilerplate; a heading takes the label of what follows it. Where a page has an article (``article``,
``main`` or such a role) blocks outside it are boilerplate, and undecided ones inside are its text, since
all the neighbours they have there are; articles without a decided text block don't count if there is one elsewhere.

Pages are read in Arrow batches, one at a time; there is no shuffle.

Defined results: null and empty html give an empty text; broken html is read as browsers do: open
elements end with their parent, elements more than 512 deep are not nested deeper, a comment or
script without an end takes the rest; tags inside scripts, styles and comments are no tags; character
references are decoded once, after the tags are told; text in no block element is a block too; rows
are read each, repeated ones included. The stop words are English, German, French and Spanish: long
blocks of other languages are undecided.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages put out at once.
ROWS_AT_ONCE = 256

# Frequent function words (common public lists).
STOP_WORDS = frozenset((
    # English
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "this",
    "are", "at", "from", "or", "an", "not", "have", "has", "had", "but", "which", "we", "you", "they", "he", "she",
    "his", "her", "their", "its", "were", "will", "would", "there", "been", "one", "all", "who", "what", "when",
    # German
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "dem",
    "ein", "eine", "einer", "als", "auch", "es", "an", "werden", "aus", "er", "hat", "dass", "sie", "nach", "bei",
    "um", "am", "sind", "noch", "wie", "einem", "über", "war", "nur", "oder", "aber", "vor", "zur", "bis",
    # French
    "de", "la", "le", "et", "les", "en", "un", "du", "une", "que", "pour", "est", "par", "dans", "qui", "avec",
    "sur", "pas", "au", "ce", "il", "plus", "ne", "se", "sont", "ou", "mais", "aux", "cette", "ses", "elle", "être",
    # Spanish
    "el", "y", "los", "del", "las", "por", "con", "no", "su", "una", "para", "al", "lo", "como", "más", "o", "pero",
    "sus", "ha", "este", "sí", "porque", "esta", "son", "entre", "está", "cuando", "muy", "sin", "sobre",
))

# Elements of HTML.
#: Elements that begin and end a block.
BLOCKS = frozenset((
    "address", "article", "aside", "blockquote", "body", "button", "canvas", "caption", "center", "dd", "details", "dialog", "dir", "div",
    "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "frameset", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre",
    "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"))
#: Elements without content or an end tag.
VOID = frozenset(("area", "base", "basefont", "br", "col", "embed", "frame", "hr", "img", "input", "link", "meta", "param", "source",
                  "track", "wbr"))
#: Elements whose content is no markup, up to their own end tag, and no text of the page.
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "svg", "math", "xmp",
                 "object", "audio", "video"))
#: Elements that hold no article text.
OUTSIDE = frozenset(("nav", "footer", "aside", "form", "head", "button", "select", "option", "optgroup", "menu", "dialog",
                     "fieldset", "legend", "label", "search"))
#: Roles that hold no article text.
OUTSIDE_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog",
                           "alertdialog", "alert", "toolbar", "note", "status"))
#: Words of class and id that tell of menus, notices, adverts, comments and such.
OUTSIDE_NAMES = frozenset((
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adbox", "adslot", "banner", "sponsor", "sponsored", "promo",
    "promotion", "nav", "navbar", "navigation", "menu", "topbar", "breadcrumb", "breadcrumbs", "sidebar", "aside", "widget", "footer",
    "header", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe",
    "subscription", "signup", "login", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "share", "sharing",
    "social", "related", "recommended", "pagination", "pager", "copyright", "legal", "disclaimer", "toolbar", "search", "form"))
#: First words of names that tell how an element looks or what stands beside it (``has-sidebar``), not what it holds.
BESIDE = frozenset(("has", "with", "without", "no", "not", "is"))
#: Elements that a start tag of the same kind ends, unless one of the others has begun between them.
ENDS_ITSELF = {"a": (), "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), "tr": ("table",),
               "td": ("tr", "table"), "th": ("tr", "table")}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
IN_HEAD = frozenset(("base", "link", "meta", "title", "style", "script", "noscript", "template"))
DEEPEST = 512

#: Blocks of at least so many characters with so many stop words a word are text, if their links hold little.
GOOD_LENGTH, GOOD_STOP_WORDS = 70, 0.2
#: Blocks with a larger share of characters in links are boilerplate; in an article that share is larger.
LINKS, ARTICLE_LINKS = 0.3, 0.7

BAD, UNDECIDED, GOOD = 0, 1, 2
_tag = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
                      |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^>"'])*+|[^>]*)(?:>|\Z)""", re.S | re.X)
_attribute = re.compile(r"""(?<![\w-])(class|id|role|hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?=[\s/]|\Z))""", re.I)
_name_words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_word = re.compile(r"[^\W\d_]+")
_hiding = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass(slots=True)
class Element:
    """An open element: whether it holds no article, the number of its article (0: none), its place in the page."""

    name: str
    outside: bool = False
    article: int = 0
    number: int = 0
    parent: int = 0


@dataclass(slots=True)
class Block:
    """A run of text between two block-level tags."""

    outside: bool
    article: int
    parent: int
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def holds_no_article(name: str, attributes: str, article: int = 0) -> bool:
    """Whether an element is boilerplate by its tag, role, class or id, or is hidden."""
    if name in OUTSIDE or name == "header" and not article:
        return True
    if not attributes or name in ("body", "html"):
        return False
    for kind, *values in _attribute.findall(attributes):
        kind, value = kind.lower(), "".join(values)
        if kind == "hidden" or kind == "style" and _hiding.search(value):
            return True
        if kind == "role" and value.strip().lower() in OUTSIDE_ROLES:
            return True
        for one in value.split() if kind in ("class", "id") else ():
            words = [w.lower() for w in _name_words.findall(one)]
            if words and words[0] not in BESIDE and any(w in OUTSIDE_NAMES and not (article and w == "header") for w in words):
                return True
    return False


def is_article(name: str, attributes: str) -> bool:
    return name in ("article", "main") or any(
        kind.lower() == "role" and "".join(value).strip().lower() in ("main", "article") for kind, *value in _attribute.findall(attributes))


class Reader:
    """Cuts a page into blocks."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack = [Element("")]
        self.block: Block | None = None
        self.links = self.numbers = self.articles = 0

    def put(self, text: str) -> None:
        if self.block is None:
            if not text.strip():
                return
            top = self.stack[-1]
            holder = next((e for e in reversed(self.stack) if e.name in BLOCKS), self.stack[0])
            self.block = Block(top.outside, top.article, holder.parent, holder.name in HEADINGS)
            self.blocks.append(self.block)
        self.block.parts.append(text)
        if self.links:
            self.block.linked += len("".join(unescape(text).split()))

    def close(self, depth: int) -> None:
        """End all elements from ``depth`` on."""
        for element in self.stack[depth:]:
            self.links -= element.name == "a"
            if element.name in BLOCKS:
                self.block = None
        del self.stack[depth:]

    def open_at(self, name: str, *barriers: str) -> int | None:
        """Where in the stack the innermost open ``name`` is, unless a barrier stands above it."""
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].name == name:
                return depth
            if self.stack[depth].name in barriers:
                return None
        return None

    def end(self, name: str) -> None:
        depth = self.open_at(name)
        if depth is not None and (name in BLOCKS or not any(e.name in BLOCKS for e in self.stack[depth + 1:])):
            self.close(depth)
        elif depth is not None:  # an inline element that ends behind the block it began in
            self.links -= name == "a"
            self.stack[depth].name = ""
        if name in BLOCKS:
            self.block = None

    def start(self, name: str, attributes: str) -> None:
        if self.stack[-1].name == "head" and name not in IN_HEAD:
            self.close(len(self.stack) - 1)
        if name in BLOCKS:
            self.block = None
            depth = self.open_at("p", "td", "th", "button")
            if depth is not None:
                self.close(depth)
        elif name == "br":
            self.put(" ")
        if name in ENDS_ITSELF:
            depth = self.open_at(name, *ENDS_ITSELF[name])
            if depth is not None:
                self.close(depth) if name in BLOCKS else self.end(name)
        if name in VOID or len(self.stack) > DEEPEST:
            return
        above = self.stack[-1]
        self.numbers += 1
        element = Element(name, above.outside, above.article, self.numbers, above.number)
        if is_article(name, attributes) and not above.outside and not above.article:
            self.articles += 1
            element.article = self.articles
        element.outside = above.outside or holds_no_article(name, attributes, element.article)
        self.stack.append(element)
        self.links += name == "a"

    def read(self, html: str) -> list[Block]:
        at = 0
        while at < len(html):
            found = _tag.search(html, at)
            stop = found.start() if found else len(html)
            if stop > at:
                self.put(html[at:stop])
            at = found.end() if found else stop
            name = found and found["name"] and found["name"].lower()
            if not name:
                continue
            if found["end"]:
                self.end(name)
            elif name in RAW and not (name in ("svg", "math") and found["rest"].rstrip().endswith("/")):
                after = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = after.end() if after else len(html)
            else:
                self.start(name, found["rest"])
        for block in self.blocks:
            block.text = " ".join(unescape("".join(block.parts)).split())
        return [b for b in self.blocks if b.text]


def decide(block: Block) -> int:
    """First pass: the label of a block by itself."""
    dense = len("".join(block.text.split()))
    if block.outside or block.linked > (ARTICLE_LINKS if block.article else LINKS) * dense:
        return BAD
    words = _word.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words)
    return GOOD if len(block.text) >= GOOD_LENGTH and words and stops >= GOOD_STOP_WORDS * len(words) else UNDECIDED


def inherit(labels: list[int], headings: list[bool]) -> list[int]:
    """Second pass: undecided labels after the nearest decided neighbours'; undecided still if there are none."""
    def nearest(order: range) -> list[int | None]:
        found, last = [None] * len(labels), None
        for k in order:
            last = k if labels[k] != UNDECIDED else last
            found[k] = last
        return found

    before, after, out = nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1)), []
    for k, (label, b, a) in enumerate(zip(labels, before, after)):
        if label != UNDECIDED or a is None and b is None:
            out.append(label)
        elif b is None or a is not None and (headings[k] or labels[a] == labels[b] or a - k < k - b):
            out.append(labels[a])
        else:
            out.append(labels[b] if a is None or k - b < a - k else BAD)
    return out


def labels_of(blocks: list[Block]) -> list[int]:
    """Both passes over the blocks of a page."""
    labels = [decide(b) for b in blocks]
    good = {bool(b.article) for b, label in zip(blocks, labels) if label == GOOD}
    if any(b.article for b in blocks) and good != {False}:
        return [BAD if not b.article or label == BAD else GOOD for b, label in zip(blocks, labels)]
    siblings: dict[int, list[int]] = {}
    for k, b in enumerate(blocks):
        siblings.setdefault(b.parent, []).append(k)
    for places in siblings.values():
        for k, label in zip(places, inherit([labels[k] for k in places], [blocks[k].heading for k in places])):
            labels[k] = label
    return inherit(labels, [b.heading for b in blocks])


def main_text(html: str | None) -> str:
    """The article of a page: its text blocks in order, joined by a blank."""
    blocks = Reader().read(html or "")
    return " ".join(b.text for b, label in zip(blocks, labels_of(blocks)) if label == GOOD)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text (empty if there is none), n_chars (its code points)."""
    rows = pages.select(id_col, url_col, F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                texts = [main_text(x.as_py()) for x in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    [id_col, url_col, "text", "n_chars"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (id_col, url_col))
    return rows.mapInArrow(run, f"{kinds}, text string, n_chars bigint")
