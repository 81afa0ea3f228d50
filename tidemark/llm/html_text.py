"""Main text of web pages by tag-path ratios.

The text nodes of a page are grouped by their path of tags from the root. Per path, the mean length
of its nodes and their mean number of punctuation marks are taken, both are smoothed along the order
in which paths first appear, and multiplied; paths in an article or main element get a bonus. Paths
above a threshold hold the content. Most of it decides which element is the article: its blocks are
the text, titles and short lines included.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Elements by what they are to a reader.
SILENT = {"head", "script", "style", "noscript", "template", "iframe", "object", "svg", "math", "canvas", "audio", "video", "map", "datalist"}
RAW = {"script", "style", "textarea", "title", "iframe", "noframes", "xmp"}
BESIDE = {"nav", "footer", "aside", "form", "button", "select", "textarea", "input", "fieldset", "menu", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "form"}
# Names in class and id of what is not the article: alone, at the end of a compound without a word of
# the third list, or in one with names of the second list only. Other compounds, as no-sidebar or
# related-work, say nothing.
NAMES = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "masthead", "topbar", "toolbar",
    "comment", "comments", "disqus", "replies", "respond", "discussion", "share", "sharing", "social", "related", "recommended",
    "newsletter", "subscribe", "signup", "login", "search", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup",
    "modal", "overlay", "pagination", "pager", "widget", "copyright", "hidden",
}
PARTS = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form", "global", "group", "header",
    "heading", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "media", "page", "panel", "post", "posts", "primary",
    "right", "row", "section", "secondary", "site", "slot", "text", "title", "top", "unit", "wrap", "wrapper",
}
LAYOUT = {"no", "not", "non", "has", "have", "with", "without", "hide", "show", "is", "one", "two"}
# An opening tag of the first kind ends an open element of the second.
CLOSES = {
    **dict.fromkeys(
        ["address", "article", "aside", "blockquote", "details", "dialog", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4",
         "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"],
        {"p"},
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "tbody", "tfoot"}, "tbody": {"tr", "thead", "tfoot"}, "tfoot": {"tr", "thead", "tbody"}, "body": {"head"},
}
# Elements over which an end tag, or such an opening tag, does not reach.
FENCES = {"html", "body", "table", "article", "section", "div", "ul", "ol", "dl", "td", "th", "main", "aside", "nav", "form", "footer", "header"}

#: Shares of the fused value that a path gets from itself and its neighbours in page order.
SMOOTHING = (0.5, 0.25)
#: What the value of a path in an article or main element is multiplied by.
BONUS = 1.5
#: A path holds content from this part of the page's weighted mean value on.
THRESHOLD = 0.35
#: Share of the chosen text that makes an element of the body the one around it.
MOST = 0.8
ROOTS = ("", "html", "body")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z]+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？।؟«»“”\"()]")
_SPACE = re.compile(r"\s+")


class Path:
    """Tags from the root to an element. One object per path of a page, so paths compare by identity."""

    def __init__(self, parent: Path | None = None, tag: str = ""):
        self.parent, self.tag = parent, tag
        self.depth: int = parent.depth + 1 if parent else 0
        self.article: bool = tag == "article" or bool(parent and parent.article)
        self.main: bool = tag == "main" or bool(parent and parent.main)
        self.below: dict[str, Path] = {}

    def upto(self, depth: int) -> Path:
        """The path itself or the beginning of it of that depth."""
        path = self
        while path.depth > depth:
            path = path.parent
        return path

    def child(self, tag: str) -> Path:
        if tag not in self.below:
            self.below[tag] = Path(self, tag)
        return self.below[tag]


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    dropped: bool
    path: Path


class Block:
    """Text without a block boundary in it, and the path it stands at."""

    def __init__(self, path: Path):
        self.path, self.parts, self.text = path, [], ""

    def close(self) -> bool:
        self.text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
        return bool(self.text)


def _beside(tag: str, attributes: str, within: Element) -> bool:
    if tag in SILENT or tag in BESIDE:
        return True
    if tag == "header" and not (within.path.article or within.path.main):
        return True
    if not attributes or tag in ("html", "body", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in ROLES or name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id") and any(map(_names_other, value.split())):
            return True
    return False


def _names_other(name: str) -> bool:
    """Whether a name of class or id means something that is not the article."""
    parts = _NAME.findall(name)
    return not NAMES.isdisjoint(parts) and (NAMES | PARTS).issuperset(parts) or bool(parts) and parts[-1] in NAMES and LAYOUT.isdisjoint(parts)


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, without what is never the article."""
    root = Element("", None, False, Path())
    at, found, current, i = root, [], None, 0
    still_open: Counter[str] = Counter()

    def leave(last: Element) -> None:
        """End ``last`` and what is open in it."""
        nonlocal at
        while at is not last:
            still_open[at.tag] -= 1
            at = at.parent
        still_open[last.tag] -= 1
        at = last.parent

    def text(raw: str) -> None:
        nonlocal current
        if raw and not at.dropped:
            if current is None:
                current = Block(at.path)
                found.append(current)
            current.parts.append(raw)

    for m in _TOKEN.finditer(page):
        if m.start() < i:
            continue
        text(page[i : m.start()])
        i = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if tag not in INLINE and tag != "br":
            current = None
        if m[1]:
            up = at
            while still_open[tag] and up.tag != tag and (up.tag not in FENCES or tag in FENCES):
                up = up.parent
            if still_open[tag] and up.tag == tag:
                leave(up)
            continue
        if tag == "br":
            text(" ")
            continue
        closes = CLOSES.get(tag)
        if closes and any(still_open[t] for t in closes):
            up = at
            while up.tag not in closes and up.tag not in FENCES:
                up = up.parent
            if up.tag in closes:
                leave(up)
        if tag in VOID:
            continue
        element = Element(tag, at, at.dropped or _beside(tag, m[3], at), at.path.child(tag))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(page, i)
            i = end.end() if end else len(page)
            continue
        if not m[3].endswith("/") or tag not in ("svg", "math"):
            at = element
            still_open[tag] += 1
    text(page[i:])
    return [b for b in found if b.close()]


def _values(found: list[Block]) -> tuple[dict[Path, float], dict[Path, int]]:
    """The fused value of each path, and the length of its text."""
    sums: dict[Path, list[int]] = {}
    for b in found:
        total = sums.setdefault(b.path, [0, 0, 0])
        total[0] += 1
        total[1] += len(b.text)
        total[2] += len(_MARKS.findall(b.text))
    ratios = [(length / n, (1 + marks) / n) for n, length, marks in sums.values()]
    own, beside = SMOOTHING
    values = {}
    for i, path in enumerate(sums):
        near = [ratios[j] for j in (i - 1, i + 1) if 0 <= j < len(ratios)]
        smooth = [(own * ratios[i][k] + sum(beside * r[k] for r in near)) / (own + beside * len(near)) for k in (0, 1)]
        values[path] = math.sqrt(smooth[0] * smooth[1])
    return values, {path: total[1] for path, total in sums.items()}


def main_text(page: str | None) -> str:
    """The article of one page; empty where there is none."""
    found = blocks(page or "")
    if not found:
        return ""
    values, lengths = _values(found)
    values = {p: v * BONUS if p.article or p.main else v for p, v in values.items()}
    mean = sum(values[p] * n for p, n in lengths.items()) / sum(lengths.values())
    content = {p for p, v in values.items() if v >= THRESHOLD * mean}
    mass = sum(lengths[p] for p in content)
    for named in (lambda p: p.article, lambda p: p.main):
        if 2 * sum(lengths[p] for p in content if named(p)) >= mass:
            return " ".join(b.text for b in found if named(b.path))
    # The element around the chosen text; not the whole body, where other things stand as well.
    around = reduce(_common, content)
    while around.tag in INLINE | {"p", "li"}:
        around = around.parent
    while around.tag in ROOTS:  # what is chosen beside the bulk of it is left out
        below = Counter()
        for p in content:
            below[p.upto(around.depth + 1)] += lengths[p]
        child, held = below.most_common(1)[0]
        if held < MOST * mass or child is around or child.tag in INLINE | {"p", "li"}:
            break
        around = child
    if around.tag not in ROOTS:
        content = {p for p in values if _common(p, around) is around}
    return " ".join(b.text for b in found if b.path in content)


def _common(a: Path, b: Path) -> Path:
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return a


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points), one row per row of ``pages``.

    * NULL or empty html, and pages of which nothing is the article, have the empty text.
    * Where half of the chosen text or more stands in article elements, their text is the article, else
      the same of main elements, else that of the innermost element around the chosen text.
    * Broken markup: an element ends where one that cannot stand in it begins; tags left open end with
      the page, and an end tag without a beginning is passed over.
    * A line break is white space. Any length; nothing but the named parts is left out.
    * Repeated rows give repeated rows, an empty table none; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
