"""Main text of web pages, by site template removal.

A page's text is read from its articles, else from its `main`s, else from the whole body.
Every block element read there is hashed with its whole subtree. Spark counts, per host,
on how many different pages a subtree occurs; those on many are the site's template, and
their text is deleted. Without an article or `main`, template is what is on `share` of the
host's different pages, `many` at least; on a host with less than `many` pages, but `few`
at least, what is on all of them. Inside an article or `main`, where passages are quoted
and repeated, it takes `inside` of the host's different pages, `many` at least. Different
means that the pages' texts differ: a page copied many times counts once, or its own text
would look like a template.

A host of one or two pages has no recurrence to go by, and menus differ from page to page, so
elements that name themselves are deleted first: navigation, header, footer, aside,
form, script, style and the like, and elements with a class, id or role that is, as a
whole, menu, sidebar, notice, advert, comments and so on (`with-sidebar` or
`related-work` is none). An article or `main` with such a name, or in an element with one,
is read where there is no other. What is around an article is never deleted by its name,
but in another article, where it holds comments. A form around an article or `main`, or
with more paragraphs and headings than visible controls, is the page and no form.

A page is read once: its text, and its subtrees' hashes with the blocks they cover, are
stored, and only the pages of a host that hold one of its template subtrees lose blocks.
Blocks are in page order; character references are decoded; white space inside a block is
one space. Missing html is empty, with empty text. Malformed html is read as browsers do in
the common cases (paragraphs and heads that are never closed, stray end tags, a missing
end). A missing url or one without a host is of a host of its own name (empty). Repeated
rows, also of one page_id, come out as often as they came in. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import as_long, as_text, stored
from .urls import url_host

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of the main text.
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input label "
    "fieldset iframe object embed applet svg math canvas audio video map dialog menu datalist".split()
)
#: Words in class, id or role that name such a part.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner promo promotion sponsored sponsor nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar aside complementary header footer masthead contentinfo cookie cookies consent "
    "notice notices notification alert popup modal overlay newsletter subscribe signup login search share sharing social "
    "related recommended comment comments respond reply replies disqus discussion toolbar pagination pager skip hidden".split()
)
#: Compounds that name such a part, too; all others describe what they are on.
COMPOUNDS = frozenset(
    "site-header site-footer site-nav site-navigation site-menu global-header global-footer page-footer main-nav main-navigation main-menu "
    "primary-nav primary-menu secondary-nav top-nav top-menu side-nav side-bar left-sidebar right-sidebar nav-bar nav-menu menu-bar mobile-menu "
    "mobile-nav footer-nav footer-links breadcrumb-nav page-navigation post-navigation skip-link skip-links ad-banner ad-container ad-slot ad-unit "
    "ad-wrapper ad-box cookie-banner cookie-bar cookie-consent cookie-notice newsletter-signup newsletter-form search-form search-box login-form "
    "social-share social-links social-media share-buttons share-bar sharing-buttons related-posts related-articles related-links "
    "comment-list comments-list comments-area comments-section comment-form comment-body comment-respond".split()
)
#: An element that starts closes an open paragraph; these close their own kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KEPT_IN_P = frozenset("a abbr b bdi bdo br cite code data del dfn em font i img ins kbd mark q s samp small span strong sub sup time tt u var wbr input label button select textarea object script style noscript template svg math canvas audio video iframe embed map picture source track link meta".split())
#: What a head can hold; anything else ends it.
IN_HEAD = frozenset("title meta link base basefont bgsound style script noscript template".split())
CONTROLS = frozenset("input select textarea button".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6".split())
NUMBER = re.compile(r"[-_]*\d*$")
WHITE = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "names", "items", "holds", "foreign", "balance")

    def __init__(self, tag: str, names: frozenset[str] = frozenset(), foreign: bool = False):
        self.tag, self.names, self.items = tag, names, []
        self.holds = tag in ("article", "main")  # it is or holds a main part
        self.foreign = foreign or tag in ("svg", "math")  # its tags aren't html
        self.balance = 0  # of a form: paragraphs less controls

    @property
    def dropped_tag(self) -> bool:
        return self.tag in DROPPED and not (self.tag == "form" and (self.holds or self.balance > 0))

    @property
    def dropped(self) -> bool:
        return self.dropped_tag or not self.names.isdisjoint(NAMES) or not self.names.isdisjoint(COMPOUNDS)

    @property
    def dropped_around(self) -> bool:
        """Dropped where names don't count for what is or holds a main part."""
        return self.dropped and (self.dropped_tag or not self.holds)


class Reader(HTMLParser):
    """Builds the tree; `items` holds texts and elements in order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html")
        self.open = [self.root]
        self.form: Element | None = None  # the last form opened

    def _close(self, tags: set[str], barrier: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                del self.open[i:]
                return
            if self.open[i].tag in barrier:
                return

    def _end_head(self) -> None:
        for i in range(1, len(self.open)):
            if self.open[i].tag == "head":
                del self.open[i:]
                return

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            if tag == "body":
                self._end_head()
            return
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._end_head()
        foreign = self.open[-1].foreign
        if not foreign:
            if tag not in KEPT_IN_P:
                self._close({"p"}, frozenset({"table", "td", "th", "button", "object"}))
            if tag in CLOSES:
                self._close(CLOSES[tag], frozenset({"ul", "ol", "dl", "table", "select"}))
        if self.form is not None and (tag in PARAGRAPHS or tag in CONTROLS) and ("type", "hidden") not in attrs:
            if self.form in self.open:
                self.form.balance += 1 if tag in PARAGRAPHS else -1
            else:
                self.form = None
        names = frozenset(NUMBER.sub("", t.lower()).replace("_", "-") for k, v in attrs if k in ("class", "id", "role") and v for t in v.split()) if attrs else frozenset()
        if attrs and any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs):
            names |= {"hidden"}
        own = Element(tag, names, foreign)
        if tag == "form":
            self.form = own
        if own.holds:
            for x in self.open:
                x.holds = True
        self.open[-1].items.append(own)
        if tag not in VOID:
            self.open.append(own)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in ("article", "main", "table") and tag in ("p", "b", "i", "span", "a", "em", "strong", "font"):
                return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and not data.isspace():
            self._end_head()
        self.open[-1].items.append(data)


def read(html: str | None) -> Element:
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    return reader.root


def main_parts(root: Element) -> list[Element]:
    """The outermost articles, else the outermost `main`s, else everything. Those that a
    name would delete come after the others."""
    for named in (False, True):
        for tag in ("article", "main"):
            out, todo = [], [root]
            while todo:
                own = todo.pop()
                if own.dropped_around if named else own.dropped:
                    continue
                if own.tag == tag:
                    out.append(own)
                else:
                    todo += [x for x in reversed(own.items) if isinstance(x, Element)]
            if out:
                return out
    return [root]


def outline(parts: list[Element]) -> tuple[list[str], list[tuple[int, int, int]]]:
    """Texts of the blocks in page order, without what a name deletes, and for every block
    element inside the parts that has text: its subtree's signed hash, its first block and
    the one after its last. No recursion, as pages can be deep."""
    out: list[str] = []
    now: list[str] = []
    subtrees: list[tuple[int, int, int]] = []

    def end() -> None:
        if line := WHITE.sub(" ", "".join(now)).strip():
            out.append(line)
        now.clear()

    for part in parts:
        end()
        todo: list = [(part, iter(part.items), xxhash.xxh64(part.tag), 0)]
        while todo:
            own, rest, hasher, first = todo[-1]
            x = next(rest, None)
            if x is None:
                todo.pop()
                if own.tag in BLOCK:
                    end()
                    if todo and len(out) > first:
                        subtrees.append((_signed(hasher.intdigest()), first, len(out)))
                if todo:
                    todo[-1][2].update(hasher.digest())
            elif isinstance(x, str):
                now.append(x)
                if plain := " ".join(x.split()):
                    hasher.update(b"\x00" + plain.encode("utf-8", "surrogatepass"))
            elif x.tag in ("br", "hr", "wbr", "img"):
                now.append(" " if x.tag == "br" else "")
                if x.tag == "hr":
                    end()
            elif not (x.dropped if part.tag == "article" else x.dropped_around):
                if x.tag in BLOCK:
                    end()
                todo.append((x, iter(x.items), xxhash.xxh64(x.tag), len(out)))
        end()
    return out, subtrees


def without(texts: list[str], subtrees: list[tuple[int, int, int]], template: frozenset[int]) -> list[str]:
    """The blocks that no template subtree covers."""
    change = [0] * (len(texts) + 1)
    for digest, first, after in subtrees:
        if digest in template:
            change[first] += 1
            change[after] -= 1
    return [t for t, covered in zip(texts, accumulate(change), strict=False) if not covered]


def blocks(parts: list[Element], template: frozenset[int]) -> list[str]:
    """Texts of the blocks in page order, without what is deleted."""
    return without(*outline(parts), template)


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def _outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = []
        for html in rows["html"]:
            root = read(html)
            parts = main_parts(root)
            texts, subtrees = outline(parts)
            text = "\n\n".join(texts)
            key = _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))
            found.append((text, key, parts != [root], [s[0] for s in subtrees], [n for s in subtrees for n in s[1:]]))
        own = pd.DataFrame(found, columns=["text", "text_key", "inside", "subtrees", "covers"])
        yield pd.concat([rows[["page_id", "url", "host", "key"]].reset_index(drop=True), own], axis=1)


@F.pandas_udf(StringType())
def _cut(texts: pd.Series, subtrees: pd.Series, covers: pd.Series, template: pd.Series) -> pd.Series:
    out = []
    for text, digests, places, gone in zip(texts, subtrees, covers, template, strict=True):
        if text is None:
            out.append(None)
            continue
        ranges = zip(digests.tolist(), places[::2].tolist(), places[1::2].tolist(), strict=True)
        out.append("\n\n".join(without(text.split("\n\n"), list(ranges), frozenset(gone.tolist()))))
    return pd.Series(out, dtype=object)


def main_texts(pages: DataFrame, many: int = 5, share: float = 0.1, few: int = 3, inside: float = 0.5) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(as_text("page_id"), "url", "html", url_host(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("key"))
    schema = "page_id string, url string, host string, key long, text string, text_key long, inside boolean, subtrees array<long>, covers array<int>"
    seen = stored(rows.mapInPandas(_outlines, schema))
    each = seen.select("host", "inside", "key", F.explode("subtrees").alias("subtree"))
    # A null subtree is on every page of the host.
    every = seen.select("host", "inside", "text_key", F.explode("subtrees").alias("subtree"))
    every = every.unionAll(seen.select("host", F.lit(False), "text_key", F.lit(None).cast("long")))
    pages_of = every.distinct().groupBy("host", "inside", "subtree").agg(F.count("*").alias("n"))
    counted = stored(pages_of.where((F.col("n") >= min(few, many)) | F.col("subtree").isNull()))
    of_host = counted.where("subtree is null").select("host", F.col("n").alias("of"))
    anywhere = F.least(F.greatest(F.lit(many), share * F.col("of")), F.greatest(F.lit(few), F.col("of")))
    least = F.when(F.col("inside"), F.greatest(F.lit(many), inside * F.col("of"))).otherwise(anywhere)
    shared = stored(counted.where("subtree is not null").join(of_host, "host").where(F.col("n") >= least).select("host", "inside", "subtree"))
    found = each.join(shared, ["host", "inside", "subtree"]).select("key", "subtree").distinct()
    template = stored(found.groupBy("key").agg(F.collect_list("subtree").alias("template")))
    joined = seen.select("page_id", "url", "text", "subtrees", "covers", "key").join(template, "key", "left")
    hit = [F.when(F.col("template").isNotNull(), F.col(c)).alias(c) for c in ("text", "subtrees", "covers", "template")]
    text = F.coalesce(_cut(*hit), F.col("text"))
    return as_long(joined, "page_id").select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
