"""Main text of web pages by line-block distribution.

Markup is stripped into lines in one pass over the page, menus, adverts and footers with it: each tag of a block
element ends a line, so where several follow each other lines between them are empty. A line has a length: that of its
text outside links. Over the lengths a window slides; where the sum surges from nothing a stretch begins, where it
dives to nothing the stretch ends. Paragraphs that follow each other have one empty line between them, what is in
another part of the page has more, so adverts, menus and footers are stretches of their own. The stretches of the
largest length are the text, with what is between them and what stands beside their paragraphs.

Names then correct the edges: lines in elements that say they are chrome (menus, headers, footers, sidebars, notices,
adverts, forms, readers' comments, scripts and styles) have no length and are left out; where a page marks articles,
the text is extended to their ends and clipped to them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

#: Lines whose lengths are summed in a window, empty ones too.
WINDOW = 2
#: Blocks around a line, from the page's root on, that its place knows.
PLACE = 64
#: Share of the largest stretch's length from which another stretch is text as well.
ALSO_TEXT = 0.2

#: Elements of HTML, by how they affect the text. All others are part of a line.
BLOCK = frozenset("address article aside blockquote body br caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp".split())
VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
#: What these hold is no text of the page.
RAW = frozenset("script style template iframe textarea title noembed noframes".split())
CHROME = frozenset("nav header footer aside form button select dialog menu fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold one paragraph, and those that hold a whole page.
PARAGRAPHS = HEADINGS | frozenset("p pre blockquote li dt dd figcaption".split())
ROOTS = frozenset(("", "html", "body"))
ARTICLES = frozenset(("article", "main"))
#: Elements whose end tag may be missing: an open one ends where one of the named elements begins.
CLOSED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
#: Words in class or id, and roles, that mark chrome.
CHROME_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment commentlist comments consent cookie cookies disqus footer gdpr header menu modal nav navbar navigation newsletter notice notices paywall popup promo promoted promotion related replies respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar widget".split())
CHROME_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words that say what an element holds, so that a name such as sidebar-right beside them says how it is laid out.
CONTENT_WORDS = frozenset("article body container content entry layout main page post story text wrapper".split())
#: What a compound name is about if it begins so, and what a header is one of if its name begins so.
NOT_CHROME_FIRST = frozenset("has with no without".split())
PAGE_HEADERS = frozenset("global main masthead page site top".split())

_NAME = re.compile(r"/?[A-Za-z][^\s/>]*")
#: A tag's rest up to its end; a quoted value, which follows an equals sign, may hold ends of tags.
_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"']++))?""")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _names_chrome(name: str, value: str) -> bool:
    """Whether a class or id marks an element of this name as chrome."""
    tokens = value.split()
    for token in tokens:
        words = _WORD.findall(token)
        if not words or words[0] in NOT_CHROME_FIRST:
            continue
        if len(words) == 1:
            if words[0] in CHROME_WORDS:
                return True
        elif name in BLOCK and (words[0] in CHROME_WORDS or words[-1] in CHROME_WORDS):
            content = words[-1] == "header" and words[0] not in PAGE_HEADERS and words[0] not in CHROME_WORDS
            if not content and not any((x := _WORD.findall(other)) and x[-1] in CONTENT_WORDS for other in tokens if other != token):
                return True
    return False


def _is_chrome(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is chrome by itself; inside: in an article or section, whose header is part of it."""
    if name in CHROME and not (name == "header" and inside):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if kind == "hidden" or kind == "aria-hidden" and value == "true":
            return True
        if kind == "style" and _HIDDEN.search(value):
            return True
        if kind == "role" and value in CHROME_ROLES:
            return True
        if kind in ("class", "id") and name not in HEADINGS and _names_chrome(name, value):
            return True
    return False


class Line:
    """Text of one block: the text, its length outside links, whether a heading h1, its article (0: none), whether chrome, block tags before it, what it stands in.

    The place is the numbers of the open blocks from the page's root on, the last being the line's own if that is a
    paragraph; roots is how many of them hold a whole page.
    """

    __slots__ = ("article", "breaks", "chrome", "length", "paragraph", "place", "roots", "text", "top")

    def __init__(self, text: str, length: int, top: bool, article: int, chrome: bool, breaks: int, place: tuple[int, ...], roots: int, paragraph: bool):
        self.text, self.length, self.top, self.article, self.chrome, self.breaks, self.place, self.roots, self.paragraph = text, length, top, article, chrome, breaks, place, roots, paragraph


class Reader:
    """Reads a page once: each tag is looked at once, and what is open is found by name."""

    def __init__(self, page: str):
        self.page = page
        self.lines: list[Line] = []
        #: Of each open element: name, whether chrome, whether a link, the article around it.
        self.open: list[tuple[str, bool, bool, int]] = []
        #: Places in open of the blocks, and of the elements of each name.
        self.blocks: list[int] = []
        self.named: dict[str, list[int]] = {}
        self.parts: list[str] = []
        self.linked = self.links = self.chrome = self.article = self.articles = 0
        #: Tags of blocks since the last line, and blocks so far.
        self.breaks = self.made = 0
        #: Of each open block its number.
        self.numbers: list[int] = []
        self.quotes = True

    def end_line(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            self.parts.clear()
            if text:
                # Places are cut at PLACE blocks, so that a page of deeply nested blocks takes linear time.
                names = [self.open[i][0] for i in self.blocks[:PLACE]]
                roots = sum(x in ROOTS for x in names)
                paragraph = bool(names) and len(self.blocks) <= PLACE and names[-1] in PARAGRAPHS
                self.lines.append(Line(text, max(0, len(text) - self.linked), bool(self.named.get("h1")), self.article, self.chrome > 0, self.breaks, tuple(self.numbers[:PLACE]), roots, paragraph))
                self.breaks = 0
        self.linked = 0

    def close(self, at: int) -> None:
        while len(self.open) > at:
            name, chrome, link, outer = self.open[-1]
            if name in BLOCK:
                self.end_line()
                self.blocks.pop()
                self.numbers.pop()
            if name in ARTICLES:
                self.article = outer
            self.open.pop()
            self.named[name].pop()
            self.chrome -= chrome
            self.links -= link

    def add_text(self, text: str) -> None:
        if text:
            self.parts.append(text)
            if self.links:
                self.linked += len(text.strip())

    def after(self, mark: str, at: int) -> int:
        """What follows the next mark; the page's end if there is none."""
        found = self.page.find(mark, at)
        return len(self.page) if found < 0 else found + len(mark)

    def tag_end(self, at: int) -> int:
        """Where the tag whose name ends at at ends; -1 if nowhere."""
        if self.quotes:
            if m := _REST.match(self.page, at):
                return m.end()
            self.quotes = False  # quotes are out of step from here on, and are not heeded any more
        return self.page.find(">", at) + 1 or -1

    def start(self, name: str, attributes: str, at: int) -> int:
        """Opens an element whose tag ends at at; returns where to go on."""
        if name in RAW:
            m = re.compile(rf"</{name}\s*+>", re.I).search(self.page, at)
            return m.end() if m else len(self.page)
        if name in VOID:
            if name in BLOCK:
                self.end_line()
            return at
        for i in reversed(self.blocks):
            own = self.open[i][0]
            if name in CLOSED_BY.get(own, ()):
                self.close(i)
                break
            if own not in CLOSED_BY:
                break
        if name in BLOCK:
            self.end_line()
            self.blocks.append(len(self.open))
            self.made += 1
            self.numbers.append(self.made)
        elif attributes.endswith("/"):
            return at
        own = self.named.setdefault(name, [])
        if name == "a" and own and (not self.blocks or own[-1] > self.blocks[-1]):  # links don't nest
            self.close(own[-1])
        chrome = _is_chrome(name, attributes, self.article > 0 or bool(self.named.get("section")))
        link = name == "a" and "href" in attributes.lower()
        own.append(len(self.open))
        self.open.append((name, chrome, link, self.article))
        self.chrome += chrome
        self.links += link
        if name in ARTICLES and not self.article:
            self.articles += 1
            self.article = self.articles
        return at

    def read(self) -> list[Line]:
        page, at, look = self.page, 0, 0
        # What is before at was read; what is before look is known to hold no more markup.
        while (tag := page.find("<", look)) >= 0:
            m = _NAME.match(page, tag + 1)
            after = page[tag + 1 : tag + 4]
            if not m and after[:1] not in ("!", "?", "/"):
                look = tag + 1
                continue
            if m and (end := self.tag_end(m.end())) < 0:  # no tag ends any more, so what is left is text
                break
            self.add_text(page[at:tag])
            if not m:
                at = self.after("-->", tag + 2) if after == "!--" else self.after("]]>" if page.startswith("<![CDATA[", tag) else ">", tag)
            else:
                name, at = m[0].lower(), end
                ends = name.lstrip("/") in BLOCK
                if name[0] != "/":
                    at = self.start(name, page[m.end() : end - 1].rstrip(), end)
                elif own := self.named.get(name[1:]):
                    self.close(own[-1])
                elif name == "/p":
                    self.end_line()
                self.breaks += ends
            look = at
        self.add_text(page[at:])
        self.close(0)
        self.end_line()
        return self.lines


def lines_of(page: str) -> list[Line]:
    """The non-empty lines of a page, in order, with character references decoded and white space made single."""
    return Reader(page).read()


def stretches(lengths: list[int], breaks: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """First and last line, end exclusive, of each stretch between a surge and its dive.

    lengths: those of the lines that aren't empty; breaks: tags of blocks before each, all but one of which make an empty
    line. A surge is a line with a length where there was none; a dive is where the window that follows a line sums to
    nothing, as all lines in it are empty or without length.
    """
    out, start, last, zeros = [], None, 0, 0
    for i, length in enumerate(lengths):
        zeros += max(breaks[i] - 1, 0)
        if not length:
            zeros += 1
            continue
        if start is not None and zeros >= window:
            out.append((start, last + 1))
            start = None
        if start is None:
            start = i
        last, zeros = i, 0
    return out if start is None else [*out, (start, last + 1)]


def found_by_windows(lines: list[Line]) -> list[bool]:
    """Which lines the distribution of lengths makes text, whatever articles are marked.

    The stretch of the largest length, those of ALSO_TEXT of it or more and those with a heading of the first rank; what
    is between the first and the last of them; what is in the innermost block that holds all of them, if that is part of
    a page; and paragraphs that stand beside one of theirs.
    """
    lengths = [0 if x.chrome else x.length for x in lines]
    found = [(a, b, sum(lengths[a:b]), any(x.top and not x.chrome for x in lines[a:b])) for a, b in stretches(lengths, [x.breaks for x in lines])]
    most = max((n for _, _, n, _ in found), default=0)
    if not most:
        return [False] * len(lines)
    chosen = [(a, b) for a, b, n, top in found if top or n >= ALSO_TEXT * most]
    own = [x for a, b in chosen for x in lines[a:b] if not x.chrome and x.length]
    around = [x.place[:-1] if x.paragraph else x.place for x in own]
    low, high = min(around), max(around)
    same = 0
    while same < min(len(low), len(high)) and low[same] == high[same]:
        same += 1
    inner = low[:same]
    part = same > max(x.roots for x in own)
    beside = {x.place[:-1] for x in own if x.paragraph}
    first, end = chosen[0][0], chosen[-1][1]
    return [not x.chrome and (first <= i < end or (part and x.place[:same] == inner) or (x.paragraph and x.length > 0 and x.place[:-1] in beside)) for i, x in enumerate(lines)]


def main_text(page: str) -> str:
    """The page's main text: its blocks joined by one space; empty if there is none.

    On a page that marks articles (outermost article and main elements) with text, their lines outside chrome are the
    text: what the windows found, extended to the articles' ends and clipped to them. On others it is what they found.
    """
    lines = lines_of(page)
    keep = found_by_windows(lines)
    if any(x.article and not x.chrome for x in lines):
        keep = [x.article > 0 and not x.chrome for x in lines]
    return " ".join(x.text for x, kept in zip(lines, keep) if kept)


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every row of pages (page_id, url, html): page_id, url, text, n_chars (its code points).

    Null or empty html, and pages without text outside chrome, give the empty text. Each row is read by itself, so
    repeated rows and ties in page_id give a row each; an empty table gives no rows. A page of any length is read whole,
    in time proportional to it. Other columns of pages are not read, whatever their names.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = [main_text(x) for x in texts(batch.column("html"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(read, "page_id long, url string, text string, n_chars long")
