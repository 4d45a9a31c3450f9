"""Main text of web pages by line-block distribution.

Markup is stripped so that every block is a line. Over the lines, characters outside links are summed in windows of WINDOW lines. The
text surges where a window, looking ahead, reaches the threshold, from the line on where the windows before it rose over FOOT of the
threshold; it dives where a whole window is empty. What lies between is kept but for lines that are mostly links. A page may surge
several times. The threshold is `surge` characters, or on short pages SHARE of the fullest window.

Elements, roles, classes and ids only weigh lines before that. What can't be the article (scripts, menus, forms, adverts, comments and the
like) counts nothing: it leaves a window of empty lines, so that the distribution dives there, but inside an article element, whose own
boxes don't interrupt it, one. Where a page has article elements, lines outside count OUTSIDE of their characters. Other containers leave an empty
line. Pages that are all of that kind by class or id alone are read again without believing these.

A page that is null, empty or without text gives the empty text. Each page is read by itself, so repeated rows give the same text; pages of any length
are scanned once from start to end.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeplane.llm.common import pieces, strings, table

#: Lines in a window, the characters in it that make a surge, the share of the fullest window that suffices, and that of a surge at its foot.
WINDOW, SURGE, SHARE, FOOT = 3, 80, 0.5, 1 / 8
#: What a character outside the article elements counts on a page that has some.
OUTSIDE = 0.25

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content isn't markup, or no text of a page.
RAW = frozenset("script style noscript template textarea iframe object svg math canvas audio video title noembed noframes xmp".split())
CONTAINERS = frozenset("div section main body table".split())
ARTICLES = frozenset(("article", "main"))
FORMS = frozenset(("form", "fieldset"))
#: A page whose text beside its forms is less than this share of its text with them is wrapped in a form.
BESIDE_FORMS = 0.1
NOT_TEXT = frozenset("nav header footer aside form button select menu dialog fieldset search head".split())
NOT_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar tablist status note".split())
#: Words of a class or id that mark what isn't the article.
NOT_TEXT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alerts warning "
    "sidebar sidebars sidenav rail menu menus nav navbar navigation breadcrumb breadcrumbs topbar toolbar header masthead footer foot copyright comment comments commentlist "
    "reply replies respond responses disqus discussion social share sharing related recommended recommendations newsletter subscribe subscription signup login popup popover "
    "modal overlay widget pagination pager skip search form".split()
)
#: Of a compound name, its first word decides if it is one of these, else its last one that isn't NEUTRAL.
TELLING_FIRST = frozenset("ad ads advert adverts advertisement sponsor sponsored promo cookie cookies gdpr newsletter comment comments disqus related".split())
NEUTRAL = frozenset(
    "area bar block body bottom box center col column container content div group inner item items left list main outer page panel post posts "
    "region right row section site title top wrap wrapper".split()
)
#: Words by which a class says what is absent or how the page is laid out.
MODIFIERS = frozenset("no not non has have with without is".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end where the next of their kind begins or their parent ends.
OPTIONAL_END = frozenset("p li dt dd td th tr option".split())
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TO_QUOTE = re.compile(r"""[^"'>]*""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_WORDS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Lines:
    """Blocks of text, with characters in links, and whether they stand in an article element; empty lines are gaps."""

    text: list[str] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    inside: list[bool] = field(default_factory=list)

    def add(self, text: str, linked: int, inside: bool) -> None:
        self.text.append(text)
        self.linked.append(linked)
        self.inside.append(inside)

    def gap(self, lines: int) -> None:
        """At least so many empty lines at the end."""
        there = 0
        while there < min(lines, len(self.text)) and not self.text[-1 - there]:
            there += 1
        for _ in range(lines - there):
            self.add("", 0, False)


@dataclass
class Tag:
    name: str
    end: bool
    attributes: str


class Scanner:
    """Reads a page once: text, and tags whose quoted attribute values may be of any length and hold any characters."""

    def __init__(self, page: str) -> None:
        self.page, self.at = page, 0
        self.gone: set[str] = set()  # quotes and end tags of which none is left

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def __iter__(self) -> Iterator[str | Tag]:
        page = self.page
        while self.at < len(page):
            start = self.find("<", self.at)
            if start < 0:
                break
            after = page[start + 1 : start + 2]
            name = _NAME.match(page, start + 1 + (after == "/"))
            if not name and after not in ("!", "?"):
                yield page[self.at : start + 1]  # no tag
                self.at = start + 1
                continue
            if start > self.at:
                yield page[self.at : start]
            if not name:
                comment = page.startswith("<!--", start)
                stop = self.find("-->" if comment else ">", start + 2)
                self.at = len(page) if stop < 0 else stop + (3 if comment else 1)
                continue
            stop = self.tag_end(name.end())
            self.at = stop + 1
            if stop < len(page):  # a tag that the page's end cuts off is none
                yield Tag(name[0].lower(), after == "/", page[name.end() : stop])
        if self.at < len(page):
            yield page[self.at :]

    def tag_end(self, at: int) -> int:
        """The place of the > that ends a tag; only behind = does a quote begin a value. The page's length if there is none."""
        page = self.page
        while True:
            at = _TO_QUOTE.match(page, at).end()
            if at >= len(page) or page[at] == ">":
                return at
            back = at - 1
            while page[back].isspace():
                back -= 1
            stop = self.find(page[at], at + 1) if page[back] == "=" else -1
            at = max(at, stop) + 1

    def skip_content(self, name: str) -> None:
        """Go on behind the element's end tag; a title without one has no content, others have all that's left."""
        found = None if f"</{name}" in self.gone else end_tag(name).search(self.page, self.at)
        if found:
            self.at = found.end()
            return
        self.gone.add(f"</{name}")
        if name != "title":
            self.at = len(self.page)


@functools.cache
def end_tag(name: str) -> re.Pattern[str]:
    """The end tag of one of the RAW elements."""
    return re.compile(rf"</{re.escape(name)}(?![^\s/>])[^>]*(?:>|\Z)", re.IGNORECASE)


def unwanted_name(token: str, in_article: bool) -> bool:
    """Whether a class or id marks what isn't the article: as a whole, not as in `no-sidebar` or `alert-history`. An article's own header holds its title."""
    parts = [x.lower() for x in _NAME_WORDS.split(token) if x]
    if not parts or MODIFIERS.intersection(parts):
        return False
    last = next((x for x in reversed(parts) if x not in NEUTRAL), "")
    return parts[0] in TELLING_FIRST or last in NOT_TEXT_NAMES and not (last == "header" and in_article)


def unwanted(tag: Tag, in_article: bool, by_name: bool, by_form: bool = True) -> bool:
    """Whether an element holds no text of the article. by_name: by class and id too; by_form: forms and field sets hold none."""
    name = tag.name
    if name in VOID or name in FORMS and not by_form:
        return False
    if name in NOT_TEXT and not (name == "header" and in_article):
        return True
    if not tag.attributes or name in ("html", "body", "article", "main"):
        return False
    for m in _ATTRIBUTE.finditer(tag.attributes):
        key, value = m[1].lower(), html.unescape((m[2] or "").strip("\"'"))
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return True
        if key == "role" and value.lower() in NOT_TEXT_ROLES:
            return True
        if by_name and key in ("class", "id") and name not in HEADINGS and any(unwanted_name(x, in_article) for x in value.split()):
            return True
    return False


def stripped(page: str, by_name: bool = True, window: int = WINDOW, by_form: bool = True) -> Lines:
    """The page's blocks as lines. An unwanted element ends at its end tag, or where an article begins."""
    lines, parts, linked = Lines(), [], 0
    link, article, skipping, depth = 0, 0, "", 0

    def close() -> None:
        nonlocal parts, linked
        text = " ".join("".join(parts).split())
        if text:
            lines.add(text, min(linked, len(text)), article > 0)
        parts, linked = [], 0

    scanner = Scanner(page)
    for token in scanner:
        if isinstance(token, str):
            if not skipping:
                text = html.unescape(token)
                parts.append(text)
                linked += len(" ".join(text.split())) if link else 0
            continue
        name, end = token.name, token.end
        if name in RAW and not end:
            scanner.skip_content(name)
            parts.append(" ")
            continue
        if skipping:
            over = skipping in OPTIONAL_END and (name == skipping or end and name in BLOCKS)
            depth += (name == skipping) * (-1 if end else 1)
            if depth and not over and not (name in ARTICLES and not end and not article):
                continue
            own_end = end and name == skipping
            skipping = ""
            lines.gap(1 if article else window)
            if own_end:
                continue
        if name == "br":
            parts.append(" ")
        elif name == "a":
            link = 0 if end else 1
        elif not end and not token.attributes.endswith("/") and unwanted(token, article > 0, by_name, by_form):
            close()
            skipping, depth = name, 1
        elif name in BLOCKS:
            close()
            link = 0
            if name in ARTICLES:
                article = max(0, article + (-1 if end else 1))
                lines.gap(1 if article > (0 if end else 1) else window)
            elif name in CONTAINERS:
                lines.gap(1)
    close()
    return lines


def between_surge_and_dive(lines: Lines, window: int = WINDOW, surge: float = SURGE) -> list[str]:
    """The lines of the text."""
    marked = any(t and i for t, i in zip(lines.text, lines.inside, strict=True))
    size = [
        0.0 if 2 * n > len(t) else (len(t) - n) * (OUTSIDE if marked and not i else 1)
        for t, n, i in zip(lines.text, lines.linked, lines.inside, strict=True)
    ]
    sums = [0.0]
    for n in size:
        sums.append(sums[-1] + n)
    ahead = [sums[min(i + window, len(size))] - sums[i] for i in range(len(size))]
    least = min(surge, SHARE * max(ahead, default=0))
    kept, rising, within = [], [], False
    for line, inside, n, sum_ahead in zip(lines.text, lines.inside, size, ahead, strict=True):
        linked = line and inside and within  # a paragraph of links in the midst of an article element
        within = within and sum_ahead > 0 or n > 0 and sum_ahead >= least
        if n > 0 or linked:
            rising.append(line)
        if within:
            kept += rising
        if within or sum_ahead < FOOT * least:
            rising = []
    return kept


def main_text(page: str, window: int = WINDOW, surge: float = SURGE) -> str:
    """The page's text; where classes and ids leave none at all, they aren't believed, and neither are forms that hold nearly all of it."""

    def read(by_form: bool) -> str:
        found = between_surge_and_dive(stripped(page, window=window, by_form=by_form), window, surge)
        return "\n".join(found or between_surge_and_dive(stripped(page, by_name=False, window=window, by_form=by_form), window, surge))

    found = read(by_form=True)
    if any(f"<{x}" in page or f"<{x.upper()}" in page for x in FORMS):
        wrapped = read(by_form=False)
        return found if len(found) >= BESIDE_FORMS * len(wrapped) else wrapped
    return found


def extract(pages: DataFrame, html_col: str = "html", window: int = WINDOW, surge: float = SURGE) -> DataFrame:
    """pages without the html column, plus text (empty for null, empty or textless pages). Each row by itself; a column text of pages is replaced."""
    kept = [c for c in pages.columns if c not in (html_col, "text")]
    source = pages.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(kept)], F.col(f"`{html_col}`").alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, len(kept)):
            texts = pa.array([main_text(x, window, surge) for x in strings(batch.column(len(kept)))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*batch.schema.names[:-1], "text"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema if f.name != "_html")
    return source.mapInArrow(run, f"{fields}text string").toDF(*kept, "text")


def op1_line_block_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
