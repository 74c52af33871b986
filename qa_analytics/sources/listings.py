"""HTML listing pages to questions (S4, F8-F12) and page texts.

The only Python that sees rows: `mapInPandas` reads the cards of each page
into raw strings. All typing is done by Column expressions afterwards.
"""

import re
import sys
from collections import defaultdict
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..functions.values import abbreviated_number, absolute_url, id_from_path, iso_timestamp, whole_number
from ..schema import QUESTION_FIELDS, UNKNOWN_AUTHOR

# The row code travels with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Class names of the listing markup.
CARD = "s-post-summary"
TITLE = "s-post-summary--content-title"
EXCERPT = "s-post-summary--content-excerpt"
TAG_BOX = "s-post-summary--meta-tags"
TAG_LINK = "post-tag"
STATS_BOX = "s-post-summary--stats"
STATS_ITEM = "s-post-summary--stats-item"
STATS_NUMBER = "s-post-summary--stats-item-number"
AUTHOR_BOX = "s-user-card--link"
USER_CARD = "s-user-card"
TIME = "relativetime"

CARDS_AT_ONCE = 512

VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr".split())

# Regular markup: text, then one tag in lower case with quoted attributes, or the usual document type.
# A start tag brings the text and the end tag of its element along where nothing else is inside.
TOKEN = re.compile(
    r'''([^<]*)<(?:
    /([a-z][a-z0-9]*)[ \n]*>
    |([a-z][a-z0-9]*)((?:[ \n]+[a-z][a-z0-9-]*="[^"&]*")*)[ \n]*(?:(/)>|>(?:([^<]*)</\3[ \n]*>)?)
    |!(?:DOCTYPE|doctype)[ ]html>)''', re.VERBOSE)
ATTRIBUTE = re.compile(r'([a-z][a-z0-9-]*)="([^"]*)"')

# Elements whose content parsers read in their own way.
OWN_CONTENT = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())

RAW_CARD = (
    "page_id long, title string, href string, summary string, tags array<string>, "
    "stat_titles array<string>, stat_numbers array<string>, author_name string, author_href string, "
    "reputation string, asked_at string, unreadable boolean"
)


class _Element:
    """An element of a page; of the page's elements in document order, those from `at` to `end` are inside this one."""

    __slots__ = ("tag", "attrs", "classes", "children", "at", "end")

    def __init__(self, tag, attrs, classes, at):
        self.tag, self.attrs, self.classes, self.children, self.at, self.end = tag, attrs, classes, [], at, at

    def text(self):
        """Stripped text pieces in document order, joined without a separator."""
        pieces, todo = [], self.children[::-1]
        while todo:
            node = todo.pop()
            if isinstance(node, _Element):
                todo.extend(node.children[::-1])
            else:
                pieces.append(node.strip())
        return "".join(pieces)


class _Root(_Element):
    """What holds a page, with the page's elements in document order."""

    __slots__ = ("elements",)

    def __init__(self):
        super().__init__("", {}, [], 0)
        self.elements = []

    def inside(self, element, tag, css=None):
        """The elements of a tag and class inside of `element`."""
        return [
            e for e in self.elements[element.at:element.end] if e.tag == tag and (css is None or css in e.classes)]

    def firsts(self, element):
        """The first element of each tag and class inside of `element`."""
        found = {}
        for e in self.elements[element.at:element.end]:
            for css in e.classes:
                found.setdefault((e.tag, css), e)
        return found


class _TreeBuilder(HTMLParser):
    """A forgiving element tree: an end tag closes up to its nearest open element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Root()
        self.open = [self.root]
        self.waiting = defaultdict(int)

    def handle_starttag(self, tag, attrs):
        self.handle_startendtag(tag, attrs)
        if tag not in VOID_TAGS:
            self.open.append(self.root.elements[-1])
            self.waiting[tag] += 1

    def handle_startendtag(self, tag, attrs):
        attrs, elements = dict(attrs), self.root.elements
        element = _Element(tag, attrs, (attrs.get("class") or "").split(), len(elements) + 1)
        elements.append(element)
        self.open[-1].children.append(element)

    def handle_endtag(self, tag):
        _close(tag, self.open, self.waiting, len(self.root.elements))

    def handle_data(self, data):
        self.open[-1].children.append(data)

    def close(self):
        super().close()
        _close_all(self.open, len(self.root.elements))


def _close(tag, open_, waiting, end):
    """Close up to the nearest open element of a tag; an end tag without one costs nothing."""
    while waiting[tag]:
        last = open_.pop()
        last.end = end
        waiting[last.tag] -= 1
        if last.tag == tag:
            return


def _close_all(open_, end):
    for element in open_:
        element.end = end


class _Attributes(dict):
    """(attributes, classes) of a regular start tag, remembered: the same markup comes again on every card."""

    def __missing__(self, markup):
        if len(self) > 4096:
            self.clear()
        attrs = dict(ATTRIBUTE.findall(markup))
        value = self[markup] = attrs, (attrs.get("class") or "").split()
        return value


def _regular_tree(html, attributes):
    """The tree of a page of regular markup, as the standard parser builds it; None for any other page."""
    root, waiting, at = _Root(), defaultdict(int), 0
    open_, elements, inside = [root], root.elements, root.children
    while token := TOKEN.match(html, at):
        at = token.end()
        text, end_tag, tag, markup, single, content = token.groups()
        if text:
            inside.append(unescape(text) if "&" in text else text)
        if end_tag:
            _close(end_tag, open_, waiting, len(elements))
            inside = open_[-1].children
        elif tag:
            element = _Element(tag, *attributes[markup], len(elements) + 1)
            elements.append(element)
            inside.append(element)
            if single:
                continue
            if tag in OWN_CONTENT and (content is None or tag not in ("script", "style", "title")):
                # Only the end tag may follow; whatever looks like markup is left to the parser.
                return None
            if content:
                raw = "&" not in content or tag in ("script", "style")
                (inside if tag in VOID_TAGS else element.children).append(content if raw else unescape(content))
            elif content is None and tag not in VOID_TAGS:
                open_.append(element)
                waiting[tag] += 1
                inside = element.children
    if "<" in html[at:]:
        return None
    if at < len(html):
        inside.append(unescape(html[at:]))
    _close_all(open_, len(elements))
    return root


def _tree(html, attributes):
    """The element tree of a page; the standard parser reads every page that is not of regular markup."""
    regular = _regular_tree(html, attributes)
    if regular is not None:
        return regular
    builder = _TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _text(element):
    return None if element is None else element.text()


def _card_fields(page, card):
    """Raw strings of one card, or None without a title link."""
    first = page.firsts(card).get
    heading = first(("h3", TITLE))
    link = next(iter(page.inside(heading, "a")), None) if heading else None
    if link is None or link.attrs.get("href") is None:
        return None
    tag_box, stats_box = first(("div", TAG_BOX)), first(("div", STATS_BOX))
    stat_titles, stat_numbers = [], []
    for item in page.inside(stats_box, "div", STATS_ITEM) if stats_box else []:
        number = next(iter(page.inside(item, "span", STATS_NUMBER)), None)
        if number is not None:
            stat_titles.append(item.attrs.get("title") or "")
            stat_numbers.append(number.text())
    author_box, user_card = first(("div", AUTHOR_BOX)), first(("div", USER_CARD))
    author = next(iter(page.inside(author_box, "a")), None) if author_box else None
    reputation = next(
        (s for s in (page.inside(user_card, "span") if user_card else []) if "reputation" in (s.attrs.get("title") or "").lower()),
        None,
    )
    asked = first(("span", TIME))
    return {
        "title": link.text(), "href": link.attrs["href"], "summary": _text(first(("div", EXCERPT))),
        "tags": [t.text() for t in page.inside(tag_box, "a", TAG_LINK)] if tag_box else [],
        "stat_titles": stat_titles, "stat_numbers": stat_numbers, "author_name": _text(author),
        "author_href": author.attrs.get("href") or "" if author else None,
        "reputation": _text(reputation), "asked_at": asked.attrs.get("title") if asked else None,
    }


def _cards(html, attributes):
    """Fields of the cards of a page; its tree is gone before the next one is built."""
    page = _tree(html, attributes)
    return [_card_fields(page, card) for card in page.inside(page, "div", CARD)]


def _read_cards(batches):
    columns = [c.split()[0] for c in RAW_CARD.split(", ")]
    rows, attributes = [], _Attributes()
    for pages in batches:
        for page_id, html in zip(pages["page_id"], pages["html"]):
            try:
                cards = _cards(html, attributes)
            except (AssertionError, ValueError):
                # The standard parser gives up on some broken declarations: the page is marked, the others go on.
                rows.append({**dict.fromkeys(columns), "page_id": page_id, "tags": [], "stat_titles": [], "stat_numbers": [], "unreadable": True})
                continue
            rows.extend({"page_id": page_id, "unreadable": False, **fields} for fields in cards if fields)
            if len(rows) >= CARDS_AT_ONCE:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
    yield pd.DataFrame(rows, columns=columns)


def raw_cards(pages: DataFrame) -> DataFrame:
    """Raw strings of every card that has a title link; pages without a card are skipped before Python."""
    return _with_cards(pages).mapInPandas(_read_cards, RAW_CARD)


def _with_cards(pages):
    return pages.where(F.contains("html", F.lit(CARD))).select(F.col("page_id").cast("long"), "html")


def _given_up(batches):
    """Ids of the pages that the parser gives up on; no card is read."""
    attributes = _Attributes()
    for pages in batches:
        ids = []
        for page_id, html in zip(pages["page_id"], pages["html"]):
            try:
                _tree(html, attributes)
            except (AssertionError, ValueError):
                ids.append(page_id)
        yield pd.DataFrame({"page_id": pd.Series(ids, dtype=pages["page_id"].dtype)})


def _may_be_given_up():
    """Whether a page holds what a parser can give up on: a marked section, or a numeric reference of very many digits.

    640 digits is the least limit that Python can be given for reading whole numbers.
    """
    digits = F.contains("html", F.lit("&#")) & F.col("html").rlike("&#[0-9]{640}")
    return F.contains("html", F.lit("<![")) | digits


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """Ids of the pages with cards that the parser gave up on; pages that it cannot give up on are skipped before Python."""
    return _with_cards(pages).where(_may_be_given_up()).mapInPandas(_given_up, "page_id long")


def _stats():
    """The stats items of a card: titles in lower case, readable numbers."""

    def typed(item):
        number = F.when(item["number"] == "", F.lit("0")).otherwise(item["number"])
        return F.struct(F.lower(item["title"]).alias("title"), whole_number(number).alias("number"))

    return F.transform(F.arrays_zip(F.col("stat_titles").alias("title"), F.col("stat_numbers").alias("number")), typed)


def _counter(kinds, not_kinds=()):
    """the last readable number among the stats items of a kind; 0 without one."""

    def is_kind(item):
        hit = F.lit(False)
        for k in kinds:
            hit = hit | F.contains(item["title"], F.lit(k))
        for k in not_kinds:
            hit = hit & ~F.contains(item["title"], F.lit(k))
        return hit

    values = F.filter("stats", lambda s: is_kind(s) & s["number"].isNotNull())
    return F.coalesce(F.try_element_at(values, F.lit(-1))["number"], F.lit(0).cast("long"))


def listing_questions(pages: DataFrame, base_url, as_of) -> DataFrame:
    """Typed questions; a card whose link holds no id is dropped.

    `as_of` replaces a missing or unreadable date.
    """
    cards = raw_cards(pages).where("not unreadable").withColumn("stats", _stats())
    typed = cards.select(
        id_from_path(F.col("href")).alias("question_id"), "title",
        absolute_url(F.col("href"), base_url).alias("url"),
        F.coalesce("summary", F.lit("")).alias("summary"), "tags",
        F.coalesce("author_name", F.lit(UNKNOWN_AUTHOR)).alias("author_name"),
        abbreviated_number(F.col("reputation")).alias("author_reputation"),
        F.coalesce(absolute_url(F.col("author_href"), base_url), F.lit("")).alias("author_profile_url"),
        iso_timestamp(F.col("asked_at"), as_of).alias("publication_date"),
        _counter(["view"], ["score", "votes", "answer"]).alias("view_count"),
        _counter(["score", "votes"]).alias("vote_count"),
        _counter(["answer"], ["score", "votes"]).alias("answer_count"),
    )
    return typed.where(F.col("question_id").isNotNull()).select(*QUESTION_FIELDS)


def page_links(pages: DataFrame) -> DataFrame:
    """Every quoted link of a page with its plain text, in page order."""
    links = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)">([^<]*)</a>'), F.lit(1))
    texts = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)">([^<]*)</a>'), F.lit(2))
    return pages.select("page_id", F.posexplode(F.arrays_zip(links.alias("href"), texts.alias("label")))).select(
        "page_id", F.col("pos").cast("long").alias("position"), "col.href", "col.label")


def page_titles(pages: DataFrame) -> DataFrame:
    """The text of each page's title element."""
    return pages.select("page_id", F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"))
