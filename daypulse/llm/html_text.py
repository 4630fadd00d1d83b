"""Main text of web pages by text-to-tag ratios."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Width of the Gaussian over lines, and how far it reaches.
SIGMA, REACH = 1.0, 3
#: Elements nested deeper than this are read as if they lay at it.
MAX_DEPTH = 512
#: A container holds the article if it has this share of the content cluster.
SHARE = 0.8
#: A form with this many characters at least, and that share of the page, is its frame.
FRAME_CHARS = 200
#: A container with more than this share of its text in links is a menu.
LINK_SHARE = 0.5

# Elements of HTML by their part in a page.
_SILENT = frozenset("script style noscript template title svg math iframe object canvas audio video "
                    "select datalist option button textarea map".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                    "meter nobr output progress q rp rt ruby s samp small span strike strong sub sup "
                    "time tt u var wbr br img input embed area param source track".split())
_BOILER = frozenset("nav footer aside menu form dialog".split())
_SECTIONS = frozenset("html body main article section div td th header nav footer aside form menu dialog "
                      "ul ol dl table blockquote figure center fieldset details".split())
# An open element ends where one of these begins.
_ENDED_BY = {
    "p": frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dt dd".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]), "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]), "head": frozenset(["body"]), "option": frozenset(["option"])}
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog "
                          "form menu menubar toolbar".split())
# Words of class and id names.
_BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login comment "
    "comments commentlist replies respond disqus discussion share sharing social related recommended "
    "recommendations widget toolbar pagination pager copyright legal disclaimer skip search form".split())
_NOT_WORDS = frozenset("has with no without is not".split())
_COMMENT_HEADS = frozenset("comments comment commentaires kommentare comentarios".split())
_HEADER_WORDS = frozenset(["header", "topbar"])

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def boilerplate_name(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element's role, class or id says that it is not the article's.
    A class like ``has-sidebar`` speaks of something else."""
    if tag in ("html", "body", "main"):
        return False
    words = _BOILER_WORDS if in_article else _BOILER_WORDS | _HEADER_WORDS
    for name, value in attrs:
        value = value or ""
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
        if name == "role" and value.lower() in _BOILER_ROLES:
            return True
        if name in ("class", "id"):
            for one in value.split():
                found = [w.lower() for w in _WORD.findall(one)]
                if found and found[0] not in _NOT_WORDS and not words.isdisjoint(found):
                    return True
    return False


@dataclass(eq=False)
class Box:
    """A container of the page. Sums are over all text under it that is not
    boilerplate; ``content`` is the part in the content cluster."""
    parent: Box | None
    tag: str
    boiler: bool
    article: bool
    out: bool = False       # it or one around it is boilerplate
    chars: int = 0
    link_chars: int = 0
    content: int = 0
    under: bool = False     # the article's container, or inside it
    menu: bool = False
    edge: bool = False


@dataclass
class Line:
    """A block of text with the tags seen since the last one."""
    box: Box
    heading: bool
    tags: int = 0
    link_chars: int = 0
    text: list[str] = field(default_factory=list)
    clean: str = ""


class Lines(HTMLParser):
    """Parser events to lines. Block elements part lines; inline ones do not.
    Holds one page's text, nothing else of it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Box(None, "html", False, False)
        self.boxes = [self.root]                # parents before children
        self.open: list[tuple[str, Box]] = []   # open elements and the container inside them
        self.silent: list[str] = []             # open elements whose text is not shown
        self.links = self.tags = 0
        self.lines: list[Line] = []
        self.line: Line | None = None

    def box(self) -> Box:
        return self.open[-1][1] if self.open else self.root

    def part(self) -> None:
        """Ends the line."""
        line, self.line = self.line, None
        if line:
            line.clean = " ".join("".join(line.text).split())
            if line.clean:
                line.tags, self.tags = self.tags, 0
                self.lines.append(line)

    def close_to(self, k: int) -> None:
        """Closes the open elements from the k-th on."""
        for tag, _ in self.open[k:]:
            self.links -= tag == "a"
        del self.open[k:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.append(tag)
            return
        if tag not in _INLINE:
            self.part()
            for k in range(len(self.open) - 1, -1, -1):
                name = self.open[k][0]
                if tag in _ENDED_BY.get(name, ()):
                    self.close_to(k)
                    break
                if name in _SECTIONS:
                    break
        elif tag == "br" and self.line:
            self.line.text.append(" ")
        if tag in _SILENT:
            self.silent.append(tag)
            return
        if tag in _VOID or len(self.open) >= MAX_DEPTH:
            return
        if tag in ("article", "main"):  # what is left open before it has ended
            for k, (name, _) in enumerate(self.open):
                if name in ("nav", "header", "head", "menu"):
                    self.close_to(k)
                    break
        box = self.box()
        article = box.article or tag in ("article", "main")
        named = boilerplate_name(tag, attrs, box.article)
        if tag in _SECTIONS or named:
            own = tag in _BOILER or (tag == "header" and not box.article) or named
            box = Box(box, tag, own, article)
            self.boxes.append(box)
        self.links += tag == "a"
        self.open.append((tag, box))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
            return
        if tag not in _INLINE:
            self.part()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.close_to(k)
                break
            if tag in _INLINE and self.open[k][0] in _SECTIONS:
                break

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        if self.line is None:
            if not data.strip():
                return
            heading = any(name in ("h1", "h2", "h3", "h4", "h5", "h6") for name, _ in self.open[-3:])
            self.line = Line(self.box(), heading)
        self.line.text.append(data)
        if self.links > 0:
            self.line.link_chars += len("".join(data.split()))

    def parse_html_declaration(self, i: int) -> int:
        """Any ``<!`` that is no comment is left out up to its ``>``."""
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        end = self.rawdata.find(">", i)
        return -1 if end < 0 else end + 1


def read_page(html: str) -> Lines:
    parser = Lines()
    parser.feed(html)
    if re.match(r"<[a-zA-Z/!?]", parser.rawdata):
        parser.rawdata = ""     # the page ends inside a tag or comment
    parser.close()
    parser.part()
    return parser


def ratios(lines: list[Line]) -> np.ndarray:
    """Characters of each line for every tag since the line before, smoothed by
    a Gaussian over the lines around it."""
    raw = np.array([len(x.clean) / max(1, x.tags) for x in lines])
    near = np.arange(-REACH, REACH + 1)
    bell = np.exp(-(near ** 2) / (2 * SIGMA ** 2))
    weight = np.convolve(np.ones(len(raw)), bell, "full")[REACH:REACH + len(raw)]
    return np.convolve(raw, bell, "full")[REACH:REACH + len(raw)] / weight


def threshold(values: np.ndarray) -> float:
    """Border of two clusters: the midpoint of their means of log(1 + ratio),
    from the two extremes until it rests."""
    logs = np.log1p(values)
    low, high = float(logs.min()), float(logs.max())
    border = (low + high) / 2
    for _ in range(100):
        above = logs > border
        if above.all() or not above.any():
            break
        new = (float(logs[above].mean()) + float(logs[~above].mean())) / 2
        if math.isclose(new, border, rel_tol=1e-12):
            break
        border = new
    return border


def mark_comments(lines: list[Line]) -> None:
    """A container that opens with a heading that only says "comments" holds them."""
    seen: set[int] = set()
    for line in lines:
        if id(line.box) not in seen:
            seen.add(id(line.box))
            words = [w for w in line.clean.lower().split() if not re.fullmatch(r"[\d()]+", w)]
            if line.heading and len(words) == 1 and words[0].strip(":()") in _COMMENT_HEADS \
                    and line.box.tag not in ("body", "html", "main", "article"):
                line.box.boiler = True


def sum_up(page: Lines, picked: set[int]) -> list[Line]:
    """The lines that are not boilerplate; their text summed per container."""
    for b in page.boxes:
        b.out = b.boiler or (b.parent is not None and b.parent.out)
        b.chars = b.link_chars = b.content = 0
    left = [x for x in page.lines if not x.box.out]
    for x in left:
        x.box.chars += len(x.clean)
        x.box.link_chars += x.link_chars
        x.box.content += len(x.clean) if id(x) in picked else 0
    for b in reversed(page.boxes):
        if b.parent is not None and not b.out:
            b.parent.chars += b.chars
            b.parent.link_chars += b.link_chars
            b.parent.content += b.content
    return left


def unwrap(page: Lines) -> None:
    """A form around nearly all text of a page is a frame of the page, not a form."""
    forms = [b for b in page.boxes if b.tag == "form" and b.boiler]
    for form in forms:
        form.boiler = False
    if forms:
        sum_up(page, set())
        for form in forms:
            form.boiler = form.chars < max(FRAME_CHARS, SHARE * page.root.chars)


def main_lines(page: Lines) -> list[str]:
    """The article's lines: the content cluster picks the container that holds
    it, and every line of that container stays which is neither boilerplate nor
    a menu, however short."""
    if not page.lines:
        return []
    mark_comments(page.lines)
    unwrap(page)
    smooth = ratios(page.lines)
    border = threshold(smooth)
    picked = {id(x) for x, v in zip(page.lines, np.log1p(smooth)) if v > border}
    left = sum_up(page, picked)
    if not left:    # names alone called it boilerplate
        for b in page.boxes:
            b.boiler = b.boiler and b.tag in _BOILER
        left = sum_up(page, picked)
    if not any(id(x) in picked for x in left):
        picked = {id(x) for x in left}
        left = sum_up(page, picked)
    inside = [b for b in page.boxes if not b.out]
    marked = [b for b in inside if b.tag in ("article", "main") and b.content]
    top = page.root
    if marked:  # the page names its article, perhaps one inside the other
        top = max(marked, key=lambda b: b.content)
        for b in inside:
            b.under = b is top or (b.parent is not None and b.parent.under)
        top = min((b for b in marked if b.under and b.content >= SHARE * top.content), key=lambda b: b.content)
    else:
        for b in inside:
            if b.parent is top and b.content >= SHARE * top.content:
                top = b
    for b in inside:
        b.under = b is top or (b.parent is not None and b.parent.under)
        if b.under and b is not top:
            b.menu = b.parent.menu or (not b.content and b.link_chars > LINK_SHARE * b.chars)
            # at the edges of a page without an article, a part without content is not of it
            b.edge = b.parent.edge or (not top.article and not b.content and b.tag in ("div", "section", "td"))
    kept = [x for x in left if x.box.under and not x.box.menu]
    found = [k for k, x in enumerate(kept) if id(x) in picked]
    between = range(found[0], found[-1] + 1) if found else range(0)
    return [x.clean for k, x in enumerate(kept) if not x.box.edge or k in between]


def main_text(html: str | None) -> str:
    """Main text of a page, its blocks joined by line ends."""
    return "\n".join(main_lines(read_page(html))) if html else ""


EXTRACT_SCHEMA = "page_id bigint, url string, text string, n_chars bigint"


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``.

    Rows are worked on where they lie, without a shuffle; a page needs memory in
    proportion to its length. White space inside a block becomes one space.
    Null and empty pages, and those without an article, have the empty text.
    Null or repeated ids are rows like any other; an empty table gives none;
    other columns are not read. Broken markup is read as far as it goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, EXTRACT_SCHEMA)


def op12_html_extraction(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Main text of every page."""
    return extract(pages)
