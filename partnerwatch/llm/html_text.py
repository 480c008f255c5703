"""HTML extraction by composite text density.

A page becomes a tree of elements. What never is main text (scripts, styles,
menus, page headers and footers, sidebars, notices, adverts, forms, reader
comments, by element, role or name) is cut. A class or id names such a thing if it
is listed or its first part is. Inside an article (or the main element of a page
without one) names are mostly slugs: there a class must be listed whole, or be made
of listed and structural parts only (``comment-list``, ``ad-slot``, but not
``ad-hoc``), an id must so too and stand on a container, and on a section it must
name comments. Ids of headings, paragraphs and spans never cut. Headers stay inside
articles; articles named as comments go where another is left. For every
element left, its
composite text density is its characters per tag, adjusted for links:

    C/T * log_b(C/LC * T/LT),  b = ln(C/NC * LC + LCbody/Cbody * C + e)

with characters C, tags T, link characters LC, link tags LT, other characters
NC of its subtree (0 counts as 1 below a line). The element whose children's
densities have the largest sum is the main one; the smallest density on its
path up to the body is the threshold below which its link-dominated blocks (in
lists, tables and divisions) are left out; inside an article or main element
only those whose class names a menu, so lists of sources stay. If it lies in an
article, else in a main element, that is taken whole; if it holds articles, the one
with the most text, if that has half of its text or more. Of equal sums the first
element in the page counts. Text comes out block by block, with character
references decoded and white space turned into single spaces.

Defined results: null and empty pages, and pages without text, give an empty
text; unclosed or crossed tags never fail; pages of any length or depth are
walked without recursion; repeated rows give equal texts, an empty table an
empty result. Input columns named ``text`` or ``n_chars`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import small_batches

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)",
    re.S,
)
_ARTICLE = re.compile(r"<article(?=[\s/>])([^>]*)", re.I)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "xmp"))
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
CUT = frozenset(
    "head script style noscript template iframe object svg math canvas audio video map nav aside footer form button select"
    " textarea input datalist dialog menu".split()
)
CUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
CUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent"
    " cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices notification pager"
    " pagination popup promo promoted promotion related replies respond share sharing sidebar social sponsor sponsored subscribe"
    " toolbar topbar widget".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies respond".split())
#: Parts of compound names that say what a thing is made as, not what it holds.
STRUCTURE = frozenset("list area slot box bar banner wrapper wrap container section thread buttons posts".split())
LINKED = frozenset("ul ol dl table div section".split())
#: Elements whose ids cut inside an article, and those whose ids never cut.
CONTAINERS = LINKED | {"ins", "article"}
NAMED_FREELY = frozenset("h1 h2 h3 h4 h5 h6 p span".split())
#: First parts of class names of link lists that are left out inside an article or main element.
MENU_NAMES = frozenset("breadcrumb breadcrumbs menu menubar nav navbar navigation pager pagination share sharing social toolbar topbar".split())
#: An element that ends what it cannot be inside of, up to the elements where the search stops.
_ITEM_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_STOPS = frozenset("ul ol dl table select body html article section div td th".split())


def _first_parts(value: str) -> list[str]:
    return [re.split("[-_]", x)[0] for x in value.split()]


def _listed(value: str, names: frozenset, strict: bool) -> bool:
    """Whether one of the names in ``value`` is in ``names``: whole, by its first part,
    or (strict) by all parts, structural ones aside."""
    for name in value.split():
        parts = re.split("[-_]+", name)
        if name in names or not strict and parts[0] in names:
            return True
        if strict and not names.isdisjoint(parts) and all(p in names or p in STRUCTURE for p in parts):
            return True
    return False


def _cut(tag: str, attrs: str, inside: bool = False) -> bool:
    """Whether an element, ``inside`` an article or not, never is main text."""
    if tag in CUT:
        return True
    if not attrs or tag in ("html", "body", "main", "article"):
        return False
    for name, value in _ATTRIBUTE.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role" and value in CUT_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "class" and _listed(value, CUT_NAMES, inside):
            return True
        if name == "id" and tag not in NAMED_FREELY and (not inside or tag in CONTAINERS):
            if _listed(value, COMMENT_NAMES if inside and tag == "section" else CUT_NAMES, inside):
                return True
    return False


def _comment(attrs: str) -> bool:
    """Whether an article is named as a reader's comment."""
    return any(name.lower() in ("class", "id") and _listed(value.strip("\"'").lower(), COMMENT_NAMES, False) for name, value in _ATTRIBUTE.findall(attrs))


def _menu(attrs: str) -> bool:
    return any(name.lower() == "class" and not MENU_NAMES.isdisjoint(_first_parts(value.strip("\"'").lower())) for name, value in _ATTRIBUTE.findall(attrs))


class Page:
    """Elements in page order (parents before children) and what happens in
    the page: texts of elements, and None where a block starts or ends."""

    def __init__(self, html: str) -> None:
        self.tags, self.parents, self.cut = ["#root"], [-1], [False]
        self.inside, self.menu = [False], [False]  # an article or main element; whether named as a menu
        self.in_article = [False]
        self.own = [False]  # inside what holds the article: names are slugs
        self.has_article = any(not _comment(m[1]) for m in _ARTICLE.finditer(html))
        self.events: list[tuple[int, str | None]] = []
        self._stack, self._open = [0], {}
        self._read(html)

    def _text(self, text: str) -> None:
        if text:
            self.events.append((self._stack[-1], unescape(text)))

    def _push(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS:
            if self._open.get("p"):
                self._pop("p", "table")
            for item in _ITEM_ENDS.get(tag, ()):
                if self._open.get(item):
                    self._pop(item, *(_STOPS - {item, *(("td", "th") if tag == "tr" else ())}))
            self.events.append((self._stack[-1], None))
        parent = self._stack[-1]
        inside = self.inside[parent] or self.tags[parent] in ("article", "main")
        self.tags.append(tag)
        self.parents.append(parent)
        self.inside.append(inside)
        self.menu.append(inside and tag in LINKED and _menu(attrs))
        own = self.own[parent] or self.tags[parent] == "article" or (self.tags[parent] == "main" and not self.has_article)
        self.own.append(own)
        in_article = self.in_article[parent] or self.tags[parent] == "article"
        self.in_article.append(in_article)
        comment = tag == "article" and self.has_article and _comment(attrs)
        self.cut.append(self.cut[parent] or comment or (tag == "header" and not in_article) or _cut(tag, attrs, own))
        if tag not in VOID:
            self._stack.append(len(self.tags) - 1)
            self._open[tag] = self._open.get(tag, 0) + 1
        elif tag == "br":
            self.events.append((parent, " "))

    def _pop(self, tag: str, *stops: str) -> None:
        """Close the innermost ``tag``, unless a stop lies above it."""
        for k in range(len(self._stack) - 1, 0, -1):
            name = self.tags[self._stack[k]]
            if name == tag:
                for i in self._stack[k:]:
                    self._open[self.tags[i]] -= 1
                    if self.tags[i] in BLOCKS:
                        self.events.append((self.parents[i], None))
                del self._stack[k:]
                return
            if name in stops:
                return

    def _read(self, html: str) -> None:
        at = 0
        while token := _TOKEN.search(html, at):
            self._text(html[at : token.start()])
            at = token.end()
            tag = token["tag"] or token["tag2"]
            if not tag:
                if token[0].startswith("<![CDATA["):
                    self._text(token[0][9:].removesuffix("]]>"))
                continue
            tag = tag.lower()
            if token["end"] or token["end2"]:
                if self._open.get(tag):
                    self._pop(tag)
                elif tag == "br":
                    self.events.append((self._stack[-1], " "))
                continue
            attrs = token["attrs"] or ""
            self._push(tag, attrs)
            if tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(html, at)
                if tag in ("textarea", "title", "xmp"):
                    self._text(html[at : close.start() if close else len(html)])
                at = close.start() if close else len(html)
                if not close:
                    break
        self._text(html[at:])

    def densities(self) -> list[float]:
        """Composite text density of each element."""
        n = len(self.tags)
        chars, links, tags, link_tags, in_link = [0] * n, [0] * n, [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parents[i]] or self.tags[i] == "a"
        for i, text in self.events:
            if text and not self.cut[i]:
                k = len("".join(text.split()))
                chars[i] += k
                links[i] += k if in_link[i] else 0
        for i in range(n - 1, 0, -1):
            if not self.cut[i]:
                p = self.parents[i]
                chars[p] += chars[i]
                links[p] += links[i]
                tags[p] += tags[i] + 1
                link_tags[p] += link_tags[i] + (self.tags[i] == "a")
        share = links[0] / max(chars[0], 1)
        out = []
        for c, lc, t, lt in zip(chars, links, tags, link_tags):
            if not c:
                out.append(0.0)
                continue
            t = max(t, 1)
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            ratio = c / max(lc, 1) * t / max(lt, 1)
            out.append(c / t * math.log(max(ratio, 1.0)) / max(math.log(base), 1e-3) if base > 1.001 else c / t * math.log(max(ratio, 1.0)))
        self.chars, self.links = chars, links
        return out

    def main(self) -> tuple[int, float, list[float]]:
        """The main element, its threshold and all densities."""
        density = self.densities()
        sums = [0.0] * len(density)
        for i in range(1, len(density)):
            if not self.cut[i] and self.tags[i] in BLOCKS:
                sums[self.parents[i]] += density[i]
        best = max(range(len(sums)), key=lambda i: (sums[i], -i))
        threshold, i = density[best], best
        while i >= 0 and self.tags[i] not in ("body", "#root"):
            i = self.parents[i]
            threshold = min(threshold, density[i]) if i > 0 else threshold
        return best, threshold, density

    def _whole(self, best: int) -> int:
        """The outermost article around ``best``, else the main element around it,
        else the article inside it that has half of its text or more; else itself."""
        around, i = {}, best
        while i > 0:
            around[self.tags[i]] = i
            i = self.parents[i]
        if "article" in around:
            return around["article"]
        best = around.get("main", best)
        within = [False] * len(self.tags)
        largest = -1
        for i in range(len(self.tags)):
            within[i] = i == best or (i > 0 and within[self.parents[i]])
            if within[i] and self.tags[i] == "article" and not self.cut[i] and (largest < 0 or self.chars[i] > self.chars[largest]):
                largest = i
        return largest if largest >= 0 and 2 * self.chars[largest] >= self.chars[best] > 0 else best

    def text(self) -> str:
        best, threshold, density = self.main()
        chosen = {self._whole(best)}
        if chosen == {best} and best > 0 and self.tags[best] not in ("article", "main", "body", "html"):
            chosen |= {i for i, p in enumerate(self.parents) if p == self.parents[best] and self.tags[i] in BLOCKS and density[i] >= threshold}
        kept = [False] * len(self.tags)
        for i in range(len(self.tags)):
            mine = i in chosen or (i > 0 and kept[self.parents[i]])
            linked = i != best and self.tags[i] in LINKED and (self.menu[i] or not self.inside[i]) and density[i] < threshold and 2 * self.links[i] > self.chars[i]
            kept[i] = mine and not self.cut[i] and not linked
        blocks, block = [], []
        for i, text in [*self.events, (0, None)]:
            if text is not None:
                if kept[i]:
                    block.append(text)
            elif block:
                if joined := _SPACE.sub(" ", "".join(block)).strip():
                    blocks.append(joined)
                block = []
        return "\n".join(blocks)


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def extract_main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars (code points)."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    out = pages.withColumn("text", extract(F.col(html)))
    return out.withColumn("n_chars", F.length("text").cast("long"))
