"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams a page as events. They are cut into
lines, one per block of text, each with its number of tags, its linked
characters and its open elements. The ratio of text to tags per line is
smoothed with a Gaussian along the page, and a threshold between two clusters
of the smoothed (logarithmic) ratios marks the content lines. The core is the
deepest element that holds nearly all marked text, an article or main element
if one does. The content region is the smallest element around it that also
holds every marked line outside the core that is not mostly links, and the
h1 heading before the core if that has none. Its lines are the main text, without what the
markup names as something else: menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments.

Element names and roles decide at once. Class and id words and forms only
name a candidate: html, body, main, headings and an article outside another
one are never taken by a word, a name of the content ("article-body") wins
over one of something else, a state ("has-comments") names nothing, and ids of
sections and text elements are targets of links. A candidate that holds most
of the page's text, with no article beside it, is a wrapper of the page or a
page-wide form and is left to the clustering.

An article or main element is kept with every line in it, lists of links too.
Elsewhere a line goes if it is not marked and half of it or more is linked,
or if it stands before or after all marked lines and has no marked line
beside it in the same element: nothing in the markup tells it from a menu.

Text: character references decoded, white space inside a block turned into
one space, trimmed, blocks joined in page order by an empty line. Nothing
else is dropped and nothing is capped.

Defined cases: a null or empty page, or one without content, gives an empty
text; an end tag without its start is ignored; an unfinished tag at the end
of a page is no text; repeated rows give repeated rows; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quayside.llm.common import slices

CHUNK = 1 << 16
SIGMA = 1.0  # of the Gaussian, in lines
REGION_SHARE = 0.8  # of the marked text that the region must hold
WRAPPED_REST = 20  # per cent of the text: reader comments with as much beside them are not the page

# Element names of HTML by what they are here.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th
    thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("""script style head title noscript template svg math iframe object audio video canvas select option textarea button
    datalist""".split())
ASIDE = frozenset("nav aside footer dialog menu".split())
PARAGRAPH_ENDS = BLOCKS - {"body", "html", "caption", "tbody", "thead", "tfoot", "tr", "td", "th", "option", "legend", "title"}
SIBLING_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
                "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody")}
SIBLING_WITHIN = frozenset("ul ol menu dl table select".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar note".split())
# names of something else wherever they stand in a class of a container ...
ASIDE_WORDS = frozenset("""nav navbar menubar breadcrumb breadcrumbs footer sidebar widget ad ads adv advert adverts advertisement
    advertising adsense sponsored gdpr popup modal overlay newsletter signup disqus pagination pager toolbar login masthead""".split())
# ... and, since they are topics as well, names only as the last word but for words of layout
TOPIC_WORDS = frozenset("""navigation menu aside sponsor promo promotion banner cookie cookies consent notice notices alert subscribe
    subscription share sharing social related recommended recommendations search skip""".split())
COMMENT_WORDS = frozenset("comment comments reply replies respond responses discussion disqus".split())
LAYOUT_WORDS = frozenset("""wrap wrapper container holder outer inner block box area region section panel pane bar strip list item items row
    col column group unit slot zone frame card cards link links button buttons btn icon icons title heading header head label top bottom
    left right middle center above below main primary secondary small large full desktop mobile inline fixed sticky default info warning
    danger success error message form field count toggle content body text post posts article articles story stories entry entries page
    pages news thread media meta author date law policy widgets trail""".split())
STATE_WORDS = frozenset("""has have with without no not is show hide enable enabled disable disabled on off open opened closed active
    visible collapsed expanded""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# elements with text of their own: a class names them by its last word, and an id is the target of a link
TEXT_ELEMENTS = frozenset("article p li dt dd td th pre blockquote figure figcaption caption details summary address".split())
CONTENT_WORDS = frozenset("article content post entry story main body text".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
UNFINISHED = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")
SPACE = re.compile(r"\s+")


@dataclass(eq=False)
class Element:
    name: str
    parent: Element | None
    aside: bool  # it or an element around it is not part of an article
    semantic: bool  # article or main
    depth: int
    start: int = 0  # place among the page's elements
    end: int = 1 << 62  # place of the last element in it
    named: Element | None = None  # the innermost of it and those around it that a word or a form names as something else
    form: bool = False
    comments: bool = False
    held: int = 0  # of a named one: its characters without links


@dataclass
class Line:
    parent: Element
    parts: list[tuple[str, bool, Element | None]] = field(default_factory=list)  # text, linked, what names it
    tags: int = 0
    linked: int = 0
    text: str = ""


class Blocks(HTMLParser):
    """Collects the lines of a page from the parser's events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[Element] = [Element("", None, False, False, 0)]
        self.names: dict[str, int] = {}
        self.line: Line | None = None
        self.tags = 0
        self.count = 0
        self.total = 0  # characters without links
        self.rest = 0  # of these, what no word or form names as something else
        self.named: list[Element] = []
        self.contents: list[Element] = []  # articles, mains and what a word names as content

    def handle_starttag(self, tag, attrs):
        if tag in PARAGRAPH_ENDS and self.names.get("p"):
            self._close("p")
        if tag in SIBLING_ENDS:
            self._close_siblings(tag)
        if tag in BLOCKS:
            self._break()
        elif tag == "br":
            self._text(" ")
        self.tags += 1
        if tag not in VOID:
            parent = self.open[-1]
            named = dict(attrs)
            semantic = tag in ("article", "main") or named.get("role") in ("main", "article")
            self.count += 1
            element = Element(tag, parent, parent.aside or self._is_aside(tag, named), semantic, parent.depth + 1, self.count, named=parent.named)
            if not element.aside:
                self._name(element, named)
            self.open.append(element)
            self.names[tag] = self.names.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # in HTML the slash means nothing
        if tag not in VOID and tag in ("svg", "math", "path"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self._break()
        self.tags += 1
        if self.names.get(tag):
            self._close(tag)

    def handle_data(self, data):
        self._text(data)

    def _is_aside(self, tag: str, attrs: dict) -> bool:
        if tag in SILENT or tag in ASIDE or attrs.get("role") in ASIDE_ROLES:
            return True
        if tag == "header":
            return not any(e.semantic for e in self.open)
        return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "")

    def _name(self, element: Element, attrs: dict) -> None:
        """Note an element that its words, or its being a form, name as something else or as content."""
        tag = element.name
        element.form = tag == "form" or attrs.get("role") == "form"
        if tag in ("html", "body", "main") or tag in HEADINGS or tag not in BLOCKS and tag not in ("span", "ins"):
            tokens = []
        elif tag == "article" and not any(e.name == "article" for e in self.open):
            tokens = []
        else:
            tokens = [(t, tag not in TEXT_ELEMENTS) for t in (attrs.get("class") or "").split()]
            ids = (attrs.get("id") or "").split()
            if not (tag == "section" or tag in TEXT_ELEMENTS or ("section", True) in tokens):
                tokens += [(t, False) for t in ids]
            elif tag == "section" and not any(e.semantic for e in self.open):
                tokens += [(t, False) for t in ids if t in ("comments", "respond", "disqus_thread")]
        kinds = [kind_of(*t) for t in tokens]
        aside = {"aside", "comments"} & set(kinds) or "header" in kinds and not any(e.semantic for e in self.open)
        if "content" in kinds or element.semantic and not aside:
            self.contents.append(element)
        elif aside:
            element.named, element.comments = element, "comments" in kinds
        if element.form:
            element.named = element
        if element.named is element:
            self.named.append(element)

    def _text(self, data: str) -> None:
        element = self.open[-1]
        if element.aside:
            return
        if self.line is None:
            if not data.strip():
                return
            block = element
            while block.parent and block.name not in BLOCKS:
                block = block.parent
            self.line, self.tags = Line(block, tags=self.tags), 0
        linked = bool(self.names.get("a"))
        self.line.parts.append((data, linked, element.named))
        if not linked:
            size, named = len(data.strip()), element.named
            self.total += size
            self.rest += 0 if named else size
            while named:
                named.held += size
                named = named.parent.named

    def _break(self) -> None:
        if self.line is not None:
            self.line.tags, self.tags = self.line.tags + self.tags, 0
            self.lines.append(self.line)
            self.line = None

    def _close(self, tag: str) -> None:
        self._break() if tag in BLOCKS else None
        while True:
            element = self.open.pop()
            element.end = self.count
            self.names[element.name] -= 1
            if element.name == tag:
                return

    def _close_siblings(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].name in SIBLING_WITHIN:
                return
            if self.open[k].name in SIBLING_ENDS[tag]:
                self._break()
                for element in self.open[k:]:
                    element.end = self.count
                    self.names[element.name] -= 1
                del self.open[k:]
                return self._close_siblings(tag)

    def finish(self) -> list[Line]:
        self.close()
        self._break()
        wrappers = {id(e) for e in self.named if self._wraps_page(e)}
        out, tags = [], 0
        for line in self.lines:
            parts = [(data, linked) for data, linked, named in line.parts if not _named_within(named, wrappers)]
            line.text = SPACE.sub(" ", "".join(data for data, _ in parts)).strip()
            line.tags += tags
            tags = 0 if line.text else line.tags
            if line.text:
                line.linked = sum(len(data.strip()) for data, linked in parts if linked)
                out.append(line)
        return out

    def _wraps_page(self, element: Element) -> bool:
        """Whether a named element holds most of the page's text and no content is named beside it."""
        if not (2 * element.held > self.total or element.form and element.held and not self.rest):
            return False
        if element.comments and 100 * (self.total - element.held) >= WRAPPED_REST * self.total:
            return False
        return not any(_beside(e, element) and (e.named is None or not _beside(e.named, element)) for e in self.contents)


def _beside(a: Element, b: Element) -> bool:
    """Whether neither of two elements is within the other."""
    return a.end < b.start or b.end < a.start


def kind_of(token: str, anywhere: bool) -> str:
    """What one name of a class or id says: aside, comments, header, content or nothing (an empty string).
    ``anywhere``: a word that has no other sense may stand anywhere in it."""
    words = [w.lower() for w in WORDS.findall(token.split("--")[0])]
    if STATE_WORDS & set(words):
        return ""
    head = list(words)
    while len(head) > 1 and (head[-1] in LAYOUT_WORDS or head[-1].isdigit() or len(head[-1]) == 1):
        head.pop()
    if head and head[-1] in COMMENT_WORDS:
        return "comments"
    if head and head[-1] in ASIDE_WORDS | TOPIC_WORDS or anywhere and ASIDE_WORDS & set(words):
        return "aside"
    if token.lower() in CONTENT_WORDS or set(words) & CONTENT_WORDS - {"body", "text"} and set(words) <= CONTENT_WORDS | LAYOUT_WORDS:
        return "content"
    return "header" if "header" in words and not set(words) & CONTENT_WORDS else ""


def _named_within(named: Element | None, wrappers: set[int]) -> bool:
    while named is not None and id(named) in wrappers:
        named = named.parent.named
    return named is not None


def page_lines(html: str) -> list[Line]:
    cut = UNFINISHED.search(html)
    parser = Blocks()
    end = cut.start() if cut else len(html)
    for at in range(0, end, CHUNK):
        parser.feed(html[at:min(at + CHUNK, end)])
    return parser.finish()


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean along the lines; at the ends over the lines there are."""
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(values, kernel)[reach:reach + len(values)] / np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]


def threshold(values: np.ndarray) -> float:
    """Half way between the means of two clusters (two-means in one dimension)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        below, above = values[values <= middle], values[values > middle]
        new = (float(below.mean()) if len(below) else low, float(above.mean()) if len(above) else high)
        if new == (low, high):
            break
        low, high = new
    # clusters that hardly differ are one
    return (low + high) / 2 if high - low > 1.0 else low - 1.0


def content_lines(lines: list[Line]) -> list[Line]:
    """The lines of the content region."""
    if not lines:
        return []
    ratio = np.array([np.log1p(len(x.text) / max(1, x.tags)) for x in lines])
    smooth = smoothed(ratio)
    marked = np.maximum(smooth, ratio) >= threshold(smooth)
    if not marked.any():
        return []
    held: dict[Element, int] = {}
    for line, mark in zip(lines, marked):
        element = line.parent if mark else None
        while element is not None:
            held[element] = held.get(element, 0) + len(line.text) - line.linked
            element = element.parent
    enough = REGION_SHARE * max(held.values())
    regions = [e for e, n in held.items() if n >= enough]
    semantic = [e for e in regions if e.semantic]
    core = max(semantic or regions, key=lambda e: e.depth)
    if not semantic and core.name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre") and core.parent:
        core = core.parent  # one long paragraph is in a region, not one
    own = ratio >= threshold(smooth)
    region, grown = _grown(lines, core, marked, own)
    inside = [k for k, x in enumerate(lines) if _within(x.parent, region)]
    if region.semantic:
        return [lines[k] for k in inside]
    in_core = [k for k in inside if _within(lines[k].parent, core)]
    if semantic:
        taken = set(in_core) | grown
        beside = set()
    else:
        # without an article element: the marked lines, what lies between them, and the other blocks beside a marked one
        taken = {k for k in in_core if marked[k]} | grown
        beside = {id(lines[k].parent.parent) for k in taken}
    first, last = min(taken), max(taken)
    return [lines[k] for k in inside if k in taken or lines[k].linked < 0.5 * len(lines[k].text)
            and (first <= k <= last or id(lines[k].parent.parent) in beside)]


def _grown(lines: list[Line], core: Element, marked: np.ndarray, own: np.ndarray) -> tuple[Element, set[int]]:
    """The smallest element that holds the core and the content lines outside
    it, and these lines. Outside an article or main element a line counts that
    is marked by its own ratio, without its neighbours'."""
    around, named = core, core if core.semantic else None  # the outermost article or main that holds the core
    while around is not None:
        named = around if around.semantic else named
        around = around.parent
    at = [_within(x.parent, core) for x in lines]
    found = set()
    for k, line in enumerate(lines):
        if not at[k] and 2 * line.linked < len(line.text) and (marked if named is None or _within(line.parent, named) else own)[k]:
            found.add(k)
    if not any(_heading(x.parent) for x, own_line in zip(lines, at) if own_line):
        first = next((k for k, x in enumerate(lines) if at[k]), 0)
        found.update([k for k in range(first) if _heading(lines[k].parent) and 2 * lines[k].linked < len(lines[k].text)][-1:])
    region = core
    for k in found:
        while not _within(lines[k].parent, region):
            region = region.parent
    return region, found


def _heading(element: Element | None) -> bool:
    while element is not None and element.name != "h1":
        element = element.parent
    return element is not None


def _within(element: Element, region: Element) -> bool:
    return region.start <= element.start <= region.end


def main_text(html: str | None) -> str:
    return "\n\n".join(x.text for x in content_lines(page_lines(html or "")))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars per page."""
    kinds = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in (id_col, url_col))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(extract, f"{kinds}, text string, n_chars long")
