"""Main text of web pages by removal of site templates.

Pages are parsed leniently into blocks of text. Every element subtree gets a
hash over its tag, class and content, menus and other elements that are no text
at all included; Spark counts on how many different pages of a host each
subtree stands, and what stands inside a subtree that recurs on many pages of its
host is deleted. A page that marks its articles or its main element keeps all of
those, and their paragraphs are text even where many pages quote them: in an
article only groups made up of links count as template. What stands in main
beside an article, and an article among several, is template where it recurs.

Counts say nothing of a host with few pages or of menus, adverts and comments
that differ from page to page. So what its tag or role says is no article text
goes anyhow; where only a class or a form says so, an article or main element
inside is text all the same, and reader comments are text only where a page has
nothing else.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import prepare, stored

MIN_PAGES = 4
LINK_SHARE = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template iframe svg math canvas object nav aside form button select textarea "
    "input dialog menu footer title xmp noembed noframes".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead "
    "tr ul caption option optgroup head".split()
)
CLOSES_P = BLOCKS - {"option", "optgroup", "head", "body", "html", "tr", "tbody", "thead", "tfoot", "caption"}
# A start tag of the first ends an open one of the second, up to one of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
P_SCOPE = frozenset("article main section div td th li dd dt blockquote body html table button figure".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
CONTENT_NAMES = frozenset("content main article post entry story body page wrapper container layout text".split())
TEMPLATE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations widget "
    "pagination pager toolbar copyright skip".split()
)
COMMENT_NAMES = frozenset("comment comments commentlist reply replies respond disqus".split())
# Beside a comment word in one class, these tell of a state of the page: has-comments, comments-open.
STATES = frozenset("has no with open closed on off enabled disabled allow allowed show hide count".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)|[^<]++|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/"'>]|\Z)""", re.I)
_NAME = re.compile(r"[A-Za-z]+")


@dataclass
class Element:
    tag: str
    names: str = ""
    dropped: bool = False
    doubt: int = 0  # elements around that are template by class or as a form
    comment: int = 0  # elements around that hold reader comments by class
    article: int = -1
    start: int = 0
    letters: int = 0
    linked: int = 0
    content: list[bytes] = field(default_factory=list)


@dataclass
class Block:
    text: str
    article: int
    doubt: int = 0
    comment: int = 0


ANY = -2


@dataclass
class Subtree:
    """A subtree that may be template: the hash, and the blocks ``first`` to ``last`` (end
    exclusive) that go with it; those of one article only, unless ``article`` is ``ANY``."""

    mark: int
    first: int
    last: int
    article: int = ANY


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(raw)} if raw else {}


def is_template(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether tag, role or class says for sure that an element is no article text."""
    if (tag in DROPPED and tag != "form") or (tag == "header" and not in_article):
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    return attributes.get("role") in ROLES - {"form"}


def may_be_template(tag: str, attributes: dict[str, str]) -> bool:
    """Whether an element is no article text unless it holds an article: a form, or by a word of its class."""
    if tag == "form":
        return True
    if not attributes or tag in ("html", "body"):
        return False
    if attributes.get("role") == "form":
        return True
    if tag in ("article", "main"):
        return False
    template = False
    for words in _classes(attributes):
        if words[0] in TEMPLATE_NAMES or not TEMPLATE_NAMES.isdisjoint(words) and CONTENT_NAMES.isdisjoint(words):
            template = True
        elif not CONTENT_NAMES.isdisjoint(words):
            return False
    return template


def is_comment(tag: str, attributes: dict[str, str]) -> bool:
    """Whether a class or id says that an element holds reader comments."""
    if not attributes or tag in ("html", "body", "main"):
        return False
    return any(not COMMENT_NAMES.isdisjoint(words) and STATES.isdisjoint(words) for words in _classes(attributes))


def _classes(attributes: dict[str, str]) -> list[list[str]]:
    """The words of each class and id."""
    each = f"{attributes.get('class', '')} {attributes.get('id', '')}".split()
    return [words for words in map(_NAME.findall, each) if words]


class Page:
    """Blocks of one page, and the subtrees that may be template."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.buffer: list[str] = []
        self.articles: list[int] = []  # characters of each article or main element
        self.kinds: list[str] = []
        self.doubts: list[int] = []
        self.comments: list[int] = []
        self.subtrees: list[Subtree] = []
        self.beside: list[Subtree] = []  # that count if the main element they are in has an article
        self.within: list[int] = []  # the main element around an article
        self.seals: dict[int, int] = {}
        self.stack = [Element("#root")]
        self._read(source)
        while len(self.stack) > 1:
            self._close()
        self._flush()
        self._settle()

    def _settle(self) -> None:
        """Add the subtrees that depend on which articles the page has."""
        articles = [i for i, size in enumerate(self.articles) if size and self.kinds[i] == "article"]
        holders = {self.within[i] for i in articles}
        self.subtrees += [t for t in self.beside if t.article in holders]
        if len(articles) > 1:
            self.subtrees += [Subtree(self.seals[i], 0, len(self.blocks), i) for i in articles]

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer = []
            if text:
                top = self.stack[-1]
                self.blocks.append(Block(text, top.article, top.doubt, top.comment))
                if top.article >= 0 and (top.doubt, top.comment) == (self.doubts[top.article], self.comments[top.article]):
                    self.articles[top.article] += len(text)

    def _open(self, tag: str, raw: str) -> None:
        if tag in ENDS:
            ended, limit = ENDS[tag]
            self._close_to(ended, limit)
        if tag in CLOSES_P:
            self._close_to({"p"}, P_SCOPE)
        if tag in BLOCKS:
            self._flush()
        elif tag == "br":
            self.buffer.append(" ")
        elif tag in ("td", "th"):
            self.buffer.append(" ")
        parent = self.stack[-1]
        attributes = _attributes(raw)
        if tag in VOID:
            return
        names = f"{attributes.get('class', '')}#{attributes.get('id', '')}"
        element = Element(tag, names, parent.dropped, parent.doubt, parent.comment, parent.article, len(self.blocks))
        if not element.dropped and is_template(tag, attributes, parent.article >= 0):
            self._flush()
            element.start = len(self.blocks)
            element.dropped = True
        if not element.dropped:
            element.doubt += may_be_template(tag, attributes)
            element.comment += is_comment(tag, attributes)
            if (element.doubt, element.comment) != (parent.doubt, parent.comment):
                self._flush()
                element.start = len(self.blocks)
            main = tag == "main" or attributes.get("role") == "main"
            inside = parent.article >= 0 and self.kinds[parent.article] == "main"
            if (parent.article < 0 and (main or tag == "article")) or (tag == "article" and inside):
                self._flush()
                element.start = len(self.blocks)
                element.article = len(self.articles)
                self.articles.append(0)
                self.kinds.append("article" if tag == "article" else "main")
                self.doubts.append(element.doubt)
                self.comments.append(element.comment)
                self.within.append(parent.article)
        self.stack.append(element)

    def _close(self) -> None:
        element = self.stack[-1]
        parent = self.stack[-2]
        state = lambda e: (e.dropped, e.doubt, e.comment, e.article)
        if element.tag in BLOCKS or state(element) != state(parent):
            self._flush()
        self.stack.pop()
        seal = blake2b(f"{element.tag}\0{element.names}\0".encode("utf-8", "replace"), digest_size=8)
        for part in element.content:
            seal.update(part)
        digest = seal.digest()
        parent.content.append(digest)
        parent.letters += element.letters
        parent.linked += element.letters if element.tag == "a" else element.linked
        if parent.dropped or element.tag in ("html", "body") or not element.letters:
            return
        tree = Subtree(int.from_bytes(digest, "big", signed=True), element.start, len(self.blocks))
        if element.dropped:  # no text at all, but it is counted like the others
            self.subtrees.append(tree)
            return
        if element.article >= 0 and element.article != parent.article:
            self.seals[element.article] = tree.mark
        elif element.article >= 0 and self.kinds[element.article] == "main":
            self.beside.append(Subtree(tree.mark, tree.first, tree.last, element.article))
        if element.article < 0 or (
            element.tag not in ("article", "main") and element.linked >= LINK_SHARE * element.letters
        ):
            self.subtrees.append(tree)

    def _close_to(self, tags, limit) -> None:
        """Close the nearest open element of ``tags`` and all inside it, unless one of ``limit`` is nearer."""
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].tag
            if tag in tags:
                while len(self.stack) > depth:
                    self._close()
                return
            if tag in limit:
                return

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        text = entities.unescape(raw) if "&" in raw else raw
        size = len(text) - text.count(" ")
        if size:
            top.letters += size
            top.content.append(blake2b(text.strip().encode("utf-8", "replace"), digest_size=8).digest())
        if not top.dropped:
            self.buffer.append(text)

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        match = _TOKEN.match
        while at < n:
            found = match(source, at)
            at = found.end()
            tag = found.group(2)
            if tag is None:
                if source[found.start()] != "<" or at - found.start() == 1:
                    self._text(found.group())
                continue
            tag = tag.lower()
            if found.group(1):
                if tag == "p" and not any(e.tag == "p" for e in self.stack):
                    self._flush()
                self._close_to({tag}, frozenset())
                continue
            self._open(tag, found.group(3))
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(source, at)
                at = end.start() if end else n
            elif found.group(3).endswith("/") and tag in ("svg", "math"):
                self._close()

    def main_blocks(self) -> list[int]:
        """Places of the blocks of all articles and of main beside them, or of the whole page.

        Of articles, as of main elements, those least in doubt are taken. On a
        page without either, blocks in doubt stay out unless they hold most of
        its text; then the counts decide. Reader comments stay out unless
        there is nothing else.
        """
        marked = [i for i, size in enumerate(self.articles) if size]
        outside = [i for i in marked if not self.comments[i]]
        blocks = range(len(self.blocks))
        kept = set()
        for kind in ("article", "main"):
            which = [i for i in outside or marked if self.kinds[i] == kind]
            kept.update(i for i in which if self.doubts[i] == min(self.doubts[k] for k in which))
        if kept and (outside or not any(not b.comment for b in self.blocks)):
            own = lambda b: (b.doubt, b.comment) == (self.doubts[b.article], self.comments[b.article])
            return [i for i in blocks if self.blocks[i].article in kept and own(self.blocks[i])]
        least = min((b.comment for b in self.blocks), default=0)
        own = [i for i in blocks if self.blocks[i].comment == least]
        total = sum(len(self.blocks[i].text) for i in own)
        level, held = 0, sum(len(self.blocks[i].text) for i in own if not self.blocks[i].doubt)
        while 2 * held < total:
            level += 1
            held += sum(len(self.blocks[i].text) for i in own if self.blocks[i].doubt == level)
        return [i for i in own if self.blocks[i].doubt <= level]


def parse_page(source: str | None) -> tuple[Page, list[int], int]:
    """The page, the places of its main blocks, and a hash of the main text."""
    page = Page(source or "")
    kept = page.main_blocks()
    text = blake2b("\n".join(page.blocks[i].text for i in kept).encode("utf-8", "replace"), digest_size=8).digest()
    return page, kept, int.from_bytes(text, "big", signed=True)


_PARSED = (
    "places array<int>, articles array<int>, texts array<string>, "
    "marks array<long>, firsts array<int>, lasts array<int>, owners array<int>, main long"
)


def _parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for sources in batches:
        rows = []
        for source in sources:
            page, kept, main = parse_page(source)
            blocks, trees = [page.blocks[i] for i in kept], page.subtrees
            rows.append(
                (kept, [b.article for b in blocks], [b.text for b in blocks], [t.mark for t in trees],
                 [t.first for t in trees], [t.last for t in trees], [t.article for t in trees], main)
            )
        yield pd.DataFrame(rows, columns=["places", "articles", "texts", "marks", "firsts", "lasts", "owners", "main"])


def without_templates(places, articles, texts, marks, firsts, lasts, owners, template) -> tuple[str, int]:
    """The text of the blocks outside all subtrees whose mark is in ``template``, and how many
    such subtrees there are that lie in no other. Linear in blocks and subtrees."""
    places, articles = np.asarray(places, dtype=np.int64), np.asarray(articles, dtype=np.int64)
    marks, owners = np.asarray(marks, dtype=np.int64), np.asarray(owners, dtype=np.int64)
    hit = np.isin(marks, np.asarray(template, dtype=np.int64))
    if not hit.any():
        return "\n\n".join(texts), 0
    firsts, lasts = np.asarray(firsts, dtype=np.int64)[hit], np.asarray(lasts, dtype=np.int64)[hit]
    owners, size = owners[hit], int(max(lasts.max(), places.max(initial=0) + 1)) + 1
    gone = np.zeros(len(places), dtype=bool)
    for owner in np.unique(owners):
        change = np.zeros(size, dtype=np.int64)
        np.add.at(change, firsts[owners == owner], 1)
        np.add.at(change, lasts[owners == owner], -1)
        covered = np.cumsum(change)[places] > 0
        gone |= covered if owner == ANY else covered & (articles == owner)
    # Widest first: a subtree inside one that went before is not counted again.
    order = np.lexsort((-lasts, firsts))
    outermost, end = 0, -1
    for first, last in zip(firsts[order].tolist(), lasts[order].tolist()):
        if last > end or first == last:
            outermost += 1
            end = max(end, last)
    return "\n\n".join(t for t, g in zip(texts, gone.tolist()) if not g), outermost


def _kept_text(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
    for columns in batches:
        rows = [without_templates(*row[:-1], [] if row[-1] is None else row[-1]) for row in zip(*columns)]
        yield pd.DataFrame(rows, columns=["text", "n_template"])


def extract_text(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars, n_template`` of every row of ``page_id, url, html``.

    A subtree is template when it stands on at least ``min_pages`` pages of
    its host with different main texts, however many pages the host has.
    Copies of a page count once. ``n_template`` is the number of subtrees that
    were deleted by these counts and lie in no other such subtree.

    Defined results: a null or empty html, or one without main text, gives an
    empty text; a null url belongs to a host of its own; repeated rows give
    repeated results; an empty table gives no rows. Pages of any length and
    depth are read whole, with memory in proportion to their size. Other
    columns are not read, so they may have any name.
    """
    prepare(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    parse = F.pandas_udf(_parse, _PARSED)
    # Pages are parsed twice, once for the marks and once for the texts: the
    # texts are as large as the pages, and are not written in between.
    parsed = pages.select("page_id", "url", host.alias("host"), parse("html").alias("p"))
    marks = parsed.select("host", F.col("p.main").alias("main"), F.explode(F.array_distinct("p.marks")).alias("mark"))
    seen = stored(marks.distinct(), "extract_marks")
    counts = seen.groupBy(F.col("host").alias("at_host"), F.col("mark").alias("at_mark")).agg(F.count("*").alias("n"))
    recurring = counts.where(F.col("n") >= min_pages).drop("n")
    # A text gets the recurring marks it has itself; no list is kept for a host.
    hits = seen.join(recurring, (F.col("host") == F.col("at_host")) & (F.col("mark") == F.col("at_mark")))
    page = lambda main: F.concat_ws("\n", "host", F.col(main).cast("string"))
    lists = hits.groupBy(page("main").alias("at_page")).agg(F.collect_set("mark").alias("template"))
    # Pages without a marked subtree need no list; a key of their own spreads them.
    own = F.concat(F.lit("\n"), F.xxhash64("page_id", "p.main").cast("string"))
    keyed = parsed.withColumn("key", F.when(F.size("p.marks") > 0, page("p.main")).otherwise(own))
    joined = keyed.join(lists, keyed["key"] == lists["at_page"], "left")
    names = ["places", "articles", "texts", "marks", "firsts", "lasts", "owners"]
    kept = F.pandas_udf(_kept_text, "text string, n_template long")(*[F.col(f"p.{n}") for n in names], "template")
    told = joined.select("page_id", "url", kept.alias("t"))
    return told.select("page_id", "url", "t.text", F.length("t.text").cast("long").alias("n_chars"), "t.n_template")
