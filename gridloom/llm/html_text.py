"""Main text of web pages from wrappers inferred for each host.

A page's token stream, nested by its tags, is aligned with the host's wrapper so far, a union-free regular expression.
Where both agree the wrapper stays; different texts become a text slot; elements that only one side has become
optional; neighbours of one shape fold into a repeated group. A wrapper combines with a wrapper in the same way, so
inference is a partial aggregation: each task aligns the pages it reads, and only wrappers are shuffled and combined.

On the finished wrapper every part gets a role. Where three pages of a host differ, the slots decide: the main part is
the one in which most of the text that changes from page to page stands outside links; lists that hold nothing but
links are menus; a part of the main one whose texts are all the same on all pages, and that is no block of text such as
a paragraph, a list or a quotation, is the template's. Names of tags and classes are asked where pages are too few or no
part holds most of the text, and they tell what a slot can't: that readers wrote a comment, or that a part within the
article is a form or an advert. Names that are also words of an article's subject, ``DOUBTFUL``, count only where no
other word of the same class says something else, and slots overrule them. A page's text is what its tokens align to in
the main part. A page that the wrapper doesn't cover is judged by a wrapper of its own.

Elements without names are told apart by what they hold: paragraphs, links only, or bare text. Only equals fold.

Defined results: null or empty html gives an empty text; a null url belongs to the empty host; repeated rows give
repeated results; unclosed tags close with their parent; elements nested over 512 deep, where browsers flatten too,
count as their ancestor's children; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
import sys
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import staged
from .url_filter import host_of

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|[^<]+|<""", re.S)
NAMES = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
DEEPEST = 512
sys.setrecursionlimit(max(sys.getrecursionlimit(), 20_000))  # some frames for each level of a page
#: Different pages of a host from which its slots decide.
SOME = 3
#: Items of a host's wrapper from which ``prune`` leaves rare ones out, and the share of its parent's pages that makes one rare.
#: That changes roles: a part without an item has only its name, and its parent may seem never to change. ``wrappers`` prunes
#: on demand only; whole wrappers grow with the number of different parts that a host's pages have.
MOST_ITEMS, RARE = 20_000, 1 / 64
#: Characters a page from which a part's slots overrule its doubtful name, and the share of its text that links may hold.
PROSE, LINKED = 20, 0.1
#: Share of the changing text that a part must hold to be, or to hold, the main one.
MOST_TEXT = 0.6
#: Bytes of the table from which an alignment is read; larger ones are cut in halves.
TABLE_BYTES = 16 << 20

# HTML's own vocabulary.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body br dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl li dt dd table figure".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
SCOPES = frozenset("article main section div table td th body html aside nav header footer form".split())
# What marks a part that isn't the article, and one that is.
SIDE_TAGS = frozenset("head nav header footer aside form script style noscript template iframe button select option textarea label menu dialog svg canvas title object embed".split())
SIDE_NAMES = frozenset(
    "ad ads adv advert advertisement adsense banner sponsor sponsored promo promotion sidebar side rail widget related recommended recommendation trending popular share sharing social follow "
    "breadcrumb breadcrumbs pagination pager nav navbar navigation menu skip header masthead topbar footer bottombar copyright cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login paywall comment comments respond disqus replies reply hidden".split()
)
#: Of these, words that classes of an article's own parts use too.
DOUBTFUL = frozenset("side rail related recommended recommendation trending popular share sharing social follow menu skip header promotion sponsor widget alert reply".split())
#: Words of classes that say nothing about what a part holds.
NEUTRAL = frozenset(
    "area articles bar block body bottom box btn button buttons center col column container content group heading icon icons inner item items left link links list "
    "main media module news outer page pages panel post posts right row section site stories story sub tags title toggle top topics us wrap wrapper".split()
)
MAIN_NAMES = frozenset("article articlebody main post entry story content".split())


SLOTLESS = frozenset({"a", "head", *RAW})


class Item:
    """A node of a page or wrapper: an element, or a text where ``key`` is ``#``, or a group of items where it is ``()``.

    A root's ``seen`` holds digests of its different pages, ``SOME`` at most.
    """

    __slots__ = ("key", "kids", "optional", "repeated", "literal", "chars", "pages", "seen")

    def __init__(self, key: str, kids: list[Item] | None = None, literal: str | None = None, chars: int = 0, pages: int = 1):
        self.key, self.kids, self.literal, self.chars, self.pages = key, kids if kids is not None else [], literal, chars, pages
        self.optional = self.repeated = False
        self.seen: tuple[str, ...] = ()

    def packed(self) -> list:
        return [self.key, [k.packed() for k in self.kids], int(self.optional), int(self.repeated), self.literal, self.chars, self.pages, *self.seen]

    @staticmethod
    def unpacked(x: list) -> Item:
        item = Item(x[0], [Item.unpacked(k) for k in x[1]], x[4], x[5], x[6])
        item.optional, item.repeated, item.seen = bool(x[2]), bool(x[3]), tuple(x[7:])
        return item

    def mass(self) -> int:
        return self.chars + sum(k.mass() for k in self.kids)

    def slots(self) -> int:
        """Characters of the texts that change from page to page and stand outside links, head and raw elements."""
        if self.key == "#":
            return self.chars if self.literal is None or self.optional else 0
        return 0 if words_of(self.key)[0] in SLOTLESS else sum(k.slots() for k in self.kids)

    def links_only(self) -> bool:
        """Whether the part has a run of links, and no text outside of links."""

        def outside(item: Item) -> int:
            return 0 if words_of(item.key)[0] == "a" else item.chars + sum(map(outside, item.kids))

        def run(item: Item) -> bool:
            return any((k.repeated and k.has_link()) or run(k) for k in item.kids)

        return run(self) and outside(self) == 0

    def has_link(self) -> bool:
        return words_of(self.key)[0] == "a" or any(k.has_link() for k in self.kids)

    def linked(self) -> int:
        """Characters within links."""
        return self.mass() if words_of(self.key)[0] == "a" else sum(k.linked() for k in self.kids)

    def is_prose(self) -> bool:
        """Whether most of the part's text changes from page to page, and is long and outside of links."""
        slots, mass = self.slots(), self.mass()
        return slots >= PROSE * self.pages and 2 * slots >= mass and self.linked() <= LINKED * mass

    def never_changes(self) -> bool:
        """Whether all pages have the same texts here."""
        return not self.optional and (self.key != "#" or self.literal is not None) and all(k.never_changes() for k in self.kids)

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids)

    def prune(self) -> Item:
        """Leave out rare optional items where there are more than ``MOST_ITEMS``."""
        if self.size() > MOST_ITEMS:
            self._prune()
        return self

    def _prune(self) -> None:
        self.kids = [k for k in self.kids if not (k.optional and k.pages < RARE * self.pages)]
        for k in self.kids:
            k._prune()


class Element:
    """An element of a page; children are elements and texts."""

    __slots__ = ("key", "kids")

    def __init__(self, key: str):
        self.key, self.kids = key, []


def _key(tag: str, attributes: str) -> str:
    """Tag and the words of its class, id and role, which tell parts of a page apart."""
    if not attributes or attributes.isspace():
        return tag
    words: list[str] = []
    for name, *values in NAMES.findall(attributes):
        value = "".join(values).lower()
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            words.append("hidden")
        elif name in ("class", "id", "role", "itemprop"):
            words += [w for token in value.split() for w in _words_of_token(token)]
    return ".".join([tag, *sorted(set(words))])


def _words_of_token(token: str) -> list[str]:
    """The words of a class; one word where a doubtful one stands beside another that says something else."""
    words = [w for w in re.split(r"[^a-z]+", token) if w]
    if DOUBTFUL & set(words) and any(w not in SIDE_NAMES and w not in NEUTRAL for w in words):
        return ["".join(words)]
    return words


def _tell_apart(element: Element) -> str:
    """What an element holds, ``p`` blocks of text, ``t`` bare text, ``a`` links, or nothing, the first of them that it
    has; the word ends the keys of nameless divisions and sections."""
    held = set()
    for kid in element.kids:
        if isinstance(kid, str):
            held |= {"t"} if kid.strip() else set()
        else:
            inner, tag = _tell_apart(kid), words_of(kid.key)[0]
            held.add("a" if tag == "a" else "p" if tag in ("p", "pre", "blockquote") and inner != "a" else inner)
    kind = next((x for x in "pta" if x in held), "")
    if element.key in ("div", "section") and kind:
        element.key += f".~{kind}"
    return kind


def parse(text: str) -> Element:
    """The element tree of a page, by forgiving rules: void elements, implied ends, ends that match nothing."""
    root = Element("")
    stack = [root]
    tags = [""]
    at, size = 0, len(text)

    def close(names: tuple[str, ...], stops: tuple[str, ...] | frozenset[str]) -> None:
        for n in range(len(tags) - 1, 0, -1):
            if tags[n] in names:
                del stack[n:], tags[n:]
                return
            if tags[n] in stops:
                return

    while at < size:
        m = TOKEN.match(text, at)
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                stack[-1].kids.append(entities.unescape(m[0]))
            continue
        tag = tag.lower()
        if m[1]:
            close((tag,), () if tag in BLOCKS or tag == "html" else SCOPES)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, at)
            at = end.end() if end else size
            stack[-1].kids.append(Element(_key(tag, "")))
            continue
        if tag in CLOSES:
            close(CLOSES[tag], STOPS[tag])
        elif tag in BLOCKS and tag != "br":
            close(("p",), SCOPES)
        element = Element(_key(tag, m[3]))
        stack[-1].kids.append(element)
        if tag not in VOID and not m[3].endswith("/") and len(stack) < DEEPEST:
            stack.append(element)
            tags.append(tag)
    _tell_apart(root)
    return root


def item_of(element: Element) -> Item:
    """The folded wrapper of one page's element."""
    kids: list[Item] = []
    for kid in element.kids:
        if isinstance(kid, str):
            words = kid.split()
            if words:
                text = " ".join(words)
                if kids and kids[-1].key == "#":
                    kids[-1].chars += len(text)
                    kids[-1].literal = None
                else:
                    kids.append(Item("#", literal=hashlib.md5(text.encode("utf-8", "replace")).hexdigest()[:12], chars=len(text)))
        else:
            kids.append(item_of(kid))
    return Item(element.key, fold(kids))


def fold(items: list[Item]) -> list[Item]:
    """Neighbouring runs of one, two or three items that repeat become one repeated item or group."""
    for period in (1, 2, 3):
        out: list[Item] = []
        for item in items:
            out.append(item)
            while _folded(out, period):
                pass
        items = out
    return items


def _folded(out: list[Item], period: int) -> bool:
    """Fold the end of ``out`` once: a further run into the group before it, or two equal runs into one."""
    last = [x.key for x in out[-period:]]
    if period > 1 and len(out) > period and out[-period - 1].key == "()" and [k.key for k in out[-period - 1].kids] == last:
        group = out[-period - 1]
        group.kids = [merge(x, y, True) for x, y in zip(group.kids, out[-period:])]
        del out[-period:]
        return True
    if len(out) < 2 * period or [x.key for x in out[-2 * period : -period]] != last or last == ["#"]:
        return False
    both = [merge(x, y, True) for x, y in zip(out[-2 * period : -period], out[-period:])]
    del out[-2 * period :]
    if period == 1:
        both[0].repeated = True
        out += both
    else:
        group = Item("()", both, pages=both[0].pages)
        group.repeated = True
        out.append(group)
    return True


def merge(a: Item, b: Item, same_page: bool = False) -> Item:
    """The wrapper item that covers both; texts that differ become a slot."""
    out = Item(a.key, align(a.kids, b.kids, same_page), a.literal if a.literal == b.literal else None, a.chars + b.chars, max(a.pages, b.pages) if same_page else a.pages + b.pages)
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    if a.seen or b.seen:
        out.seen = tuple(sorted({*a.seen, *b.seen})[:SOME])
    return out


def align(a: list[Item], b: list[Item], same_page: bool = False) -> list[Item]:
    """Both sequences as one: a longest common subsequence of keys merges, what is left becomes optional."""
    head = 0
    while head < len(a) and head < len(b) and a[head].key == b[head].key:
        head += 1
    out = [merge(x, y, same_page) for x, y in zip(a[:head], b[:head])]
    a, b = a[head:], b[head:]
    if not a and not b:
        return out
    pairs = common([x.key for x in a], [y.key for y in b])
    i = j = 0
    for x, y in [*pairs, (len(a), len(b))]:
        for extra in [*a[i:x], *b[j:y]]:
            extra.optional = True
            out.append(extra)
        if x < len(a):
            out.append(merge(a[x], b[y], same_page))
        i, j = x + 1, y + 1
    return fold(out)


def _rows(a: list[str], b: list[str]) -> Iterator[int]:
    """For each prefix of ``b`` the longest common subsequences with all prefixes of ``a``, as bits: a zero where one more
    item of ``a`` makes it longer."""
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        met = row & places.get(y, 0)
        row = ((row + met) | (row - met)) & full
        yield row


def _lengths(a: list[str], b: list[str]) -> np.ndarray:
    """The length of the longest common subsequence of ``b`` and each prefix of ``a``."""
    *_, row = (0 if not a else (1 << len(a)) - 1), *_rows(a, b)
    bits = np.frombuffer(format(row, f"0{len(a)}b").encode(), np.uint8)[::-1] if a else np.zeros(0, np.uint8)
    return np.concatenate(([0], np.cumsum(bits == 48)))


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence, by bit-parallel rows; large tables are cut where halves meet best."""
    if not a or not b:
        return []
    if len(a) * len(b) > 8 * TABLE_BYTES and len(b) > 1:
        half = len(b) // 2
        both = _lengths(a, b[:half]) + _lengths(a[::-1], b[half:][::-1])[::-1]
        k = int(both.argmax())
        return common(a[:k], b[:half]) + [(i + k, j + half) for i, j in common(a[k:], b[half:])]
    rows = list(_rows(a, b))
    pairs, i, j = [], len(a), len(b)
    while i and j:
        if rows[j - 1] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
            if not j or rows[j - 1] >> (i - 1) & 1:
                i -= 1
                pairs.append((i, j))
    return pairs[::-1]


def words_of(key: str) -> tuple[str, frozenset[str]]:
    tag, *names = key.split(".")
    return tag, frozenset(names)


def is_side(key: str) -> bool:
    tag, names = words_of(key)
    return tag in SIDE_TAGS or (tag not in ("html", "body", "article", "main") and bool(names & SIDE_NAMES)) or (tag in ("article", "main") and bool(names & SIDE_NAMES & {"comment", "reply", "ad", "promo", "related", "hidden"}))


def is_doubtful(key: str) -> bool:
    """Whether only names, and none but doubtful ones, make it a side part."""
    tag, names = words_of(key)
    return tag not in SIDE_TAGS and names & SIDE_NAMES <= DOUBTFUL


def is_main(key: str) -> bool:
    tag, names = words_of(key)
    return tag in ("article", "main") or bool(names & {"articlebody"}) or (tag in ("div", "section") and bool(names & MAIN_NAMES))


class Wrapper:
    """A finished wrapper with the roles of its parts."""

    def __init__(self, root: Item):
        self.main: set[int] = set()
        self.fixed: set[int] = set()
        self.root = root
        self.side: set[int] = set()
        self.prose: set[int] = set()
        self.kids: dict[int, tuple[list[Item], dict[str, list[int]]]] = {}
        place, certain, everywhere = self._heaviest(len(root.seen) >= SOME)
        found = [] if certain else self._marked(root)
        if found:
            best = max(found, key=lambda x: (words_of(x.key)[0] in ("article", "main"), x.mass()))
            tag = words_of(best.key)[0]
            self.main = {id(x) for x in found if words_of(x.key)[0] == tag or x is best}
            return
        self.main = {id(place)}
        if certain:
            self._menus(place)
            self._named(place)
            for kid in _flat(place.kids) if everywhere else ():
                self._unchanging(kid)

    def _heaviest(self, by_slots: bool) -> tuple[Item, bool, bool]:
        """The innermost part that holds most of the text, whether slots have shown it, and whether all pages have it.

        Headings, paragraphs and lists beside a part belong with it, so the way down ends where such are met.
        """
        at, certain, everywhere = self.root, False, True
        while True:
            kids = [k for k in _flat(at.kids) if k.key != "#" and (by_slots or not is_side(k.key))]
            weigh = Item.slots if by_slots else Item.mass
            heavy = max(kids, key=lambda k: (weigh(k), -len(k.key)), default=None)
            if heavy is None or heavy.repeated or words_of(heavy.key)[0] in TEXT_BLOCKS:
                break
            blocks = any(words_of(k.key)[0] in TEXT_BLOCKS and weigh(k) and not k.links_only() for k in kids)
            if blocks or weigh(heavy) <= MOST_TEXT * sum(map(weigh, [*kids, *(t for t in at.kids if t.key == "#")])):
                break
            at, everywhere = heavy, everywhere and not heavy.optional
            certain = by_slots and words_of(at.key)[0] not in ("html", "body")
        return at, certain, everywhere

    def _menus(self, item: Item) -> None:
        """Lists of nothing but links in the main part are menus."""
        for kid in item.kids:
            if words_of(kid.key)[0] in ("ul", "ol", "div", "nav", "section") and kid.links_only():
                self.side.add(id(kid))
            else:
                self._menus(kid)

    def _marked(self, item: Item) -> list[Item]:
        """The outermost parts marked as main, not within a side part."""
        out: list[Item] = []
        for kid in item.kids:
            if kid.key == "#" or is_side(kid.key):
                continue
            if is_main(kid.key):
                inner = [x for x in self._marked(kid) if words_of(x.key)[0] in ("article", "main")]
                out += inner if inner and words_of(kid.key)[0] not in ("article",) else [kid]
            else:
                out += self._marked(kid)
        return out

    def _named(self, item: Item) -> None:
        """Parts with doubtful names whose slots hold prose belong to the main part."""
        for kid in item.kids:
            if kid.key not in ("#", "()") and is_side(kid.key) and is_doubtful(kid.key) and kid.is_prose():
                self.prose.add(id(kid))
            self._named(kid)

    def _unchanging(self, item: Item) -> None:
        """Parts that are no blocks of text and whose texts are equal on all pages are the template's."""
        if item.key == "#" or item.optional or words_of(item.key)[0] in TEXT_BLOCKS:
            return
        if item.never_changes():
            self.fixed.add(id(item))
        else:
            for kid in item.kids:
                self._unchanging(kid)

    def text(self, page: Element) -> str | None:
        """The page's main text, or None where the page has no part that aligns to the main one."""
        out: list[str] = []
        return " ".join("".join(out).split()) if self._walk(page, self.root, False, out) or id(self.root) in self.main else None

    def _items(self, item: Item) -> tuple[list[Item], dict[str, list[int]]]:
        """The items in a part, and by key the places at which they are, ascending."""
        if id(item) not in self.kids:
            items, places = _flat(item.kids), {}
            for k, x in enumerate(items):
                places.setdefault(x.key, []).append(k)
            self.kids[id(item)] = items, places
        return self.kids[id(item)]

    def _walk(self, element: Element, item: Item | None, inside: bool, out: list[str]) -> bool:
        inside = inside or (item is not None and id(item) in self.main)
        met = inside
        items, places = self._items(item) if item is not None else ([], {})
        at = 0
        for kid in element.kids:
            key = "#" if isinstance(kid, str) else kid.key
            match = None
            if key != "#" or kid.strip():
                if there := places.get(key):
                    n = bisect_left(there, at)
                    where = there[n] if n < len(there) else there[-1]
                    match = items[where]
                    at = where if match.repeated or where < at else where + 1
            if key == "#":
                if inside:
                    out.append(kid)
                continue
            prose = inside and match is not None and id(match) in self.prose
            if (is_side(key) and not prose) or (match is not None and (id(match) in self.side or id(match) in self.fixed)):
                if inside and words_of(key)[0] == "header" and not words_of(key)[1]:
                    _headings(kid, out)
                out.append(" ")
                continue
            block = words_of(key)[0] in BLOCKS
            if inside and block:
                out.append(" ")
            met |= self._walk(kid, match, inside, out)
            if inside and block:
                out.append(" ")
        return met


def _headings(element: Element, out: list[str]) -> None:
    """Headings in an article's own header belong to the article."""
    for kid in element.kids:
        if not isinstance(kid, str) and not is_side(kid.key):
            if re.fullmatch(r"h[1-6]", words_of(kid.key)[0]):
                out += [" ", _plain(kid), " "]
            else:
                _headings(kid, out)


def _plain(element: Element) -> str:
    return "".join(k if isinstance(k, str) else _plain(k) for k in element.kids)


def _flat(items: list[Item]) -> list[Item]:
    out: list[Item] = []
    for x in items:
        if x.key == "()":
            inner = _flat(x.kids)
            for k in inner:
                k.repeated = True
            out += inner
        else:
            out.append(x)
    return out


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", hosts_held: int = 500, fan_in: int = 32, pruned: bool = False) -> DataFrame:
    """(host, wrapper json), from all pages; if ``pruned``, without rare items of very large wrappers.

    A task holds at most ``hosts_held`` wrappers and hands on those it has when there are more. Rounds then combine up
    to about ``fan_in`` wrappers of a host in one call, so no host, however many its pages, meets in one task whole. Pages
    too are combined in pairs of equal numbers, so a page is not aligned with all different parts that came before it.
    """
    rows = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html"))

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Item]] = {}
        part, sent = TaskContext.get().partitionId(), 0
        for batch in batches:
            for host, text in zip(batch["host"], batch["html"]):
                html, name = text.as_py() or "", host.as_py()
                page = item_of(parse(html))
                page.seen = (hashlib.md5(html.encode("utf-8", "replace")).hexdigest()[:16],)
                stack = held.setdefault(name, [])
                stack.append(page)
                while len(stack) > 1 and stack[-2].pages == stack[-1].pages:
                    last = stack.pop()
                    stack[-1] = merged(stack[-1], last)
                if len(held) > hosts_held:
                    yield packed(held, part, sent)
                    held, sent = {}, sent + 1
        if held:
            yield packed(held, part, sent)

    def merged(a: Item, b: Item) -> Item:
        return merge(a, b).prune() if pruned else merge(a, b)

    def packed(held: dict[str, list[Item]], part: int, sent: int) -> pa.RecordBatch:
        return _packed({name: reduce(lambda x, y: merged(y, x), reversed(stack)) for name, stack in held.items()}, part, sent)

    schema = "host string, wrapper string, part long, pages long"
    now = staged(rows.mapInArrow(infer, schema), "host_wrappers")

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "wrapper"])
        whole = None
        for x in group["wrapper"]:
            item = Item.unpacked(json.loads(x))
            whole = item if whole is None else merged(whole, item)
        return pd.DataFrame({"host": group["host"].iloc[:1], "wrapper": [json.dumps(whole.packed())], "part": group["part"].min(), "pages": group["pages"].sum()})

    while (most := now.groupBy("host").count().agg(F.max("count")).first()[0] or 0) > 1:
        buckets = -(-most // fan_in)
        dealt = now.withColumn("bucket", F.pmod(F.xxhash64("part", "wrapper"), F.lit(buckets)) if buckets > 1 else F.lit(0))
        now = staged(dealt.groupBy("host", "bucket").applyInPandas(lambda g: combine(g), schema), "host_wrappers")
    return now.select("host", "wrapper")


def _packed(held: dict[str, Item], part: int, sent: int) -> pa.RecordBatch:
    rows = [{"host": h, "wrapper": json.dumps(x.packed()), "part": part * 1_000_000 + sent, "pages": x.pages} for h, x in held.items()]
    return pa.RecordBatch.from_pylist(rows, pa.schema([("host", pa.string()), ("wrapper", pa.string()), ("part", pa.int64()), ("pages", pa.int64())]))


_ready: dict[str, Wrapper] = {}


def _wrapper(packed: str) -> Wrapper:
    if packed not in _ready:
        if len(_ready) >= 500:
            _ready.clear()
        _ready[packed] = Wrapper(Item.unpacked(json.loads(packed)))
    return _ready[packed]


def page_text(html: str | None, packed: str | None) -> str:
    page = parse(html or "")
    text = _wrapper(packed).text(page) if packed else None
    return Wrapper(item_of(page)).text(page) or "" if text is None else text


def main_texts(pages: DataFrame, found: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(page_id, url, text). ``found`` is what ``wrappers`` returned, for other pages of the same hosts.

    Wrappers go to every worker while all of them together are below ``broadcast_bytes``; beyond, pages join theirs by a
    shuffle salted so that a host's pages spread over many tasks.
    """
    held = wrappers(pages, url_col, html_col) if found is None else found
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    size = held.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    if size <= broadcast_bytes:
        sent = pages.sparkSession.sparkContext.broadcast(dict(held.toPandas().itertuples(index=False)))

        @F.pandas_udf(T.StringType())
        def looked_up(html: pd.Series, host: pd.Series) -> pd.Series:
            return pd.Series([page_text(h, sent.value.get(name)) for h, name in zip(html, host)], dtype=object)

        return rows.select("page_id", "url", looked_up("html", "host").alias("text"))

    @F.pandas_udf(T.StringType())
    def extracted(html: pd.Series, wrapper: pd.Series) -> pd.Series:
        return pd.Series([page_text(h, w) for h, w in zip(html, wrapper)], dtype=object)

    salts = 64
    spread = held.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = rows.withColumn("_salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int")).join(spread, ["host", "_salt"], "left")
    return met.select("page_id", "url", extracted("html", "wrapper").alias("text"))
