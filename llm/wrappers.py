"""HTML extraction by inferring union-free wrappers (operator 9).

Pages of one host are token streams: opening tags (with their classes), closing tags and text
slots, nested as the tags are. Repeated neighbours are folded into groups, their contents
aligned; then streams are aligned one after another, element by element: what both have stays,
what only one has becomes optional, unless it is one more turn of a repeated group. The result
is the host's wrapper, a regular expression without unions. Each text slot of the wrapper has
statistics over all pages of the host, and the wrapper gives each slot its place or drops it as
the same on different pages. Page by page, the best place that has text there gives the text.

Wrappers are folded within each batch first, so that a host sends one partial wrapper per batch,
however many pages it has, and folding reads them one by one.

Defined results: null and empty html, and pages without main slots, give an empty text; a null or
odd url counts as host ""; repeated rows are answered alike; extra columns are ignored; markup cut
off at the end of a page is dropped, as are unclosed comments and scripts.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.session import cut_lineage

#: Wrapper decisions are broadcast up to this many bytes, and joined by shuffling beyond it.
BROADCAST_BYTES = 8 << 20
#: Longest group that folding looks for, and longest streams that are aligned item by item.
GROUP, ALIGN = 8, 400
#: So many different pages must hold the same text before it counts as the host's and not the page's.
APART = 2

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea title iframe svg math select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul li dd dt".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}
#: Elements, and words in classes, ids and roles, that never hold main text; the second of each only outside the article.
NEVER = frozenset("nav footer aside form button head dialog menu".split())
NEVER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu menus breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup comment comments commentlist respond replies disqus discussion share sharing social related recommended pagination pager login search toolbar copyright complementary contentinfo".split())
#: Of these words, those that articles use in other senses as well ("related work", "share price"): inside the article they
#: count only in a name that holds nothing else but such words and the plain words of page building below.
OPEN_WORDS = frozenset("related share sharing social discussion notice notices alert recommended search menu menus navigation subscribe login replies respond copyright comment comments notification overlay modal widget promotion promo".split())
PLAIN_WORDS = frozenset("area article articles bar block body bottom box button buttons container content count entry feed form group header icon icons inline inner item items left link links list main module outer page panel post posts reader right row section site stories story text title tools top user wrap wrapper".split())
OUTSIDE = frozenset(["header"])
OUTSIDE_WORDS = frozenset("header masthead banner topbar".split())
MAIN = frozenset(["article", "main"])

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<([A-Za-z][^\s/>]*+)([^>]*+)>|</([A-Za-z][^\s/>]*+)[^>]*+>|<[!?/][^>]*+(?:>|\Z)|<[A-Za-z][^>]*+\Z|[^<]++|<", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: (key, contents, repeated, optional); "#" is a text slot, "(a b)" a group of neighbours a and b.
Item = tuple[str, tuple, bool, bool]


def host_of(url: str | None) -> str:
    try:
        return urlsplit(url or "").hostname or ""
    except ValueError:
        return ""


@lru_cache(1 << 14)
def key_of(tag: str, attributes: str) -> str:
    """A tag with the words of its class, id and role: what must agree for two tags to be aligned.

    "!" stands among them if one of the names, taken as a whole, speaks against main text in an article too.
    """
    names = [frozenset(w.lower() for w in _WORD.findall(name)) for m in _ATTRIBUTE.finditer(attributes) for name in (m[2] or m[3] or m[4] or "").split()]
    denies = any(n & NEVER_WORDS - OPEN_WORDS or n & OPEN_WORDS and n <= NEVER_WORDS | PLAIN_WORDS for n in names)
    return ".".join([tag, *(["!"] if denies else []), *sorted(frozenset().union(*names))])


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, key, text): "<" with the tag's key, ">" with the tag, "#" with the raw text."""
    at = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m[1] or m[3]
        if tag:
            tag = tag.lower()
            attributes = (m[2] if m[1] else m[4]) or ""
            if tag in RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                yield "<", key_of(tag, attributes), ""
        elif m[5]:
            yield ">", m[5].lower(), ""
        elif page[m.start()] != "<" or m.end() - m.start() == 1:
            yield "#", "", m[0]


def slots(page: str) -> Iterator[tuple[str, str, str, bool]]:
    """("<" | ">" | "#", key or address, text, whether a block ends before it); elements close as in browsers."""
    stack: list[str] = []
    block = True
    for kind, key, text in tokens(page):
        tag = key.split(".", 1)[0]
        if kind == "#":
            if not text.isspace():
                yield "#", "/".join(stack), text, block
                block = False
            elif not block:
                yield "#", "/".join(stack), " ", False
            continue
        if tag not in INLINE:
            block = True
        if kind == "<":
            while stack and tag in CLOSED_BY.get(_open_block(stack), ()):
                yield from _close(stack, _open_block(stack))
            if tag == "br":
                yield "#", "/".join(stack), " ", False
            elif tag not in VOID:
                stack.append(key)
                yield "<", key, "", False
        elif any(k.split(".", 1)[0] == tag for k in stack):
            yield from _close(stack, tag)
    while stack:
        yield ">", stack.pop(), "", True


def _open_block(stack: list[str]) -> str:
    """The innermost open element that is no inline element."""
    return next((t for k in reversed(stack) if (t := k.split(".", 1)[0]) not in INLINE), "")


def _close(stack: list[str], tag: str) -> Iterator[tuple[str, str, str, bool]]:
    while stack:
        key = stack.pop()
        yield ">", key, "", key.split(".", 1)[0] not in INLINE
        if key.split(".", 1)[0] == tag:
            return


def _keys(items: tuple[Item, ...]) -> tuple[str, ...]:
    return tuple(x[0] for x in items)


def _merge(x: Item, y: Item, many: bool = False) -> Item:
    """One item for two of the same key: their contents aligned."""
    return x[0], align(x[1], y[1]), x[2] or y[2] or many, x[3] or y[3]


def fold(items: tuple[Item, ...]) -> tuple[Item, ...]:
    """Neighbouring groups of equal keys become one repeated group, short groups first."""
    out = list(items)
    for size in range(1, GROUP + 1):
        if 2 * size > len(out) + 1:
            break
        i, new = 0, []
        while i < len(out):
            turn = _keys(tuple(out[i : i + size]))
            name = turn[0] if size == 1 else f"({' '.join(turn)})"
            if size > 1 and new and new[-1][0] == name and len(turn) == size:  # one more turn of the group before it
                new[-1] = (name, tuple(_merge(x, y) for x, y in zip(new[-1][1], out[i : i + size], strict=True)), True, new[-1][3])
                i += size
            elif len(turn) == size and _keys(tuple(out[i + size : i + 2 * size])) == turn:
                group = tuple(out[i : i + size])
                i += size
                while _keys(tuple(out[i : i + size])) == turn:
                    group = tuple(_merge(x, y, size == 1) for x, y in zip(group, out[i : i + size], strict=True))
                    i += size
                new.append(group[0] if size == 1 else (name, group, True, False))
            else:
                new.append(out[i])
                i += 1
        out = new
    return tuple(out)


def align(a: tuple[Item, ...], b: tuple[Item, ...]) -> tuple[Item, ...]:
    """The wrapper of both: the longest common subsequence of keys, the rest optional; then folded again."""
    if a == b:
        return a
    if _keys(a) == _keys(b):
        return tuple(_merge(x, y) for x, y in zip(a, b, strict=True))
    out: list[Item] = []
    maybe = lambda x: (x[0], x[1], x[2], True)
    if max(len(a), len(b)) > ALIGN:
        out = [maybe(x) for x in (*a, *b)]
    else:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = 1 + best[i + 1][j + 1] if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
        i = j = 0
        while i < len(a) or j < len(b):
            if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
                out.append(_merge(a[i], b[j]))
                i, j = i + 1, j + 1
            elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
                out.append(maybe(a[i]))
                i += 1
            else:
                out.append(maybe(b[j]))
                j += 1
    return fold(tuple(out))


def _digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


class Wrapper:
    """The expression of a host's pages and, for each slot, [least digests of different pages that have it, at most
    ``APART``; digest of its only text so far or None]."""

    def __init__(self) -> None:
        self.items: tuple[Item, ...] | None = None
        self.stats: dict[str, list] = {}

    def read(self, page: str) -> None:
        texts: dict[str, list[str]] = {}
        open_: list[tuple[str, list[Item]]] = [("", [])]
        for kind, key, text, _ in slots(page):
            if kind == "<":
                open_.append((key, []))
            elif kind == ">":
                name, kids = open_.pop()
                open_[-1][1].append((name, fold(tuple(kids)), False, False))
            else:
                texts.setdefault(key, []).append(text)
                if text != " " and not (open_[-1][1] and open_[-1][1][-1][0] == "#"):
                    open_[-1][1].append(("#", (), False, False))
        other = Wrapper()
        other.items = fold(tuple(open_[0][1]))
        own = {a: _digest(" ".join("".join(t).split())) for a, t in texts.items()}
        whole = _digest(" ".join(f"{a} {own[a]}" for a in sorted(own) if place(a)))
        other.stats = {a: [[whole], d] for a, d in own.items()}
        self.join(other)

    def join(self, other: Wrapper) -> None:
        self.items = other.items if self.items is None else align(self.items, other.items)
        for a, (pages, text) in other.stats.items():
            mine = self.stats.setdefault(a, [[], text])
            self.stats[a] = [sorted({*mine[0], *pages})[:APART], text if mine[1] == text else None]

    def addresses(self) -> list[str]:
        """The text slots of the expression, in order, each by the keys of the elements around it."""
        found: dict[str, None] = {}

        def walk(items: tuple[Item, ...], path: tuple[str, ...]) -> None:
            for key, kids, _, _ in items:
                if key == "#":
                    found.setdefault("/".join(path))
                else:
                    walk(kids, path if key[0] == "(" else (*path, key))

        walk(self.items or (), ())
        return list(found)

    def main(self) -> dict[str, str]:
        """Slots that may hold main text and their places: without what is never main text and without body texts
        that are the same on all of ``APART`` or more different pages (copies of a page count once)."""
        named = ((a, place(a)) for a in self.addresses())
        return {a: p for a, p in named if p and not (p == "body" and len(self.stats[a][0]) == APART and self.stats[a][1] is not None)}

    def dumps(self) -> str:
        return json.dumps([self.items, self.stats], ensure_ascii=False)

    @staticmethod
    def loads(text: str) -> Wrapper:
        out = Wrapper()
        items, out.stats = json.loads(text)
        out.items = None if items is None else _tuples(items)
        return out


def _tuples(items: list) -> tuple[Item, ...]:
    return tuple((key, _tuples(kids), many, maybe) for key, kids, many, maybe in items)


@lru_cache(1 << 14)
def place(address: str) -> str:
    """Where a slot lies: "article", "below" (an article inside elements whose words speak against main text),
    "body", or "" where no main text is. Words of html and body say nothing about their contents."""
    inside, denied = "body", False
    for key in address.split("/"):
        tag, *names = key.split(".")
        never = tag not in ("html", "body") and bool(NEVER_WORDS.intersection(names))
        if tag in NEVER or "!" in names and (inside != "body" or tag == "article"):
            return ""
        denied |= never
        if tag in MAIN or not never and "main" in names and tag in ("div", "section"):
            inside = "below" if denied else "article"
        elif inside == "body":
            if tag in OUTSIDE:
                return ""
            denied |= tag not in ("html", "body") and bool(OUTSIDE_WORDS.intersection(names))
    return "" if inside == "body" and denied else inside


def text_of(page: str, main: dict[str, str], between: str = "\n") -> str:
    """Blocks of the page's main slots in page order, joined by ``between``. The article if this page has one with
    text; else what lies in the body or in articles below denied elements, whichever has more text here."""
    seen = list(slots(page))
    size = dict.fromkeys(("article", "below", "body"), 0)
    for kind, key, text, _ in seen:
        if kind == "#" and key in main:
            size[main[key]] += len((html.unescape(text) if "&" in text else text).strip())
    best = "article" if size["article"] else "body" if size["body"] > size["below"] else "below"
    blocks: list[list[str]] = []
    new = True
    for kind, key, text, block in seen:
        if kind != "#":
            new |= key.split(".", 1)[0] not in INLINE
        elif text == " " and blocks and not new and not block:
            blocks[-1].append(text)  # a blank between two elements of a block, listed or not
        elif main.get(key) == best:
            if new or block or not blocks:
                blocks.append([])
            blocks[-1].append(text)
            new = False
        elif text != " ":
            new = True
    out = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
    return between.join(b for b in out if b)


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) of every host: partial wrappers of each batch, folded host by host."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own: dict[str, Wrapper] = {}
            for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own.setdefault(host_of(url), Wrapper()).read(page or "")
            yield pa.record_batch([pa.array(list(own), pa.string()), pa.array([w.dumps() for w in own.values()], pa.string())], names=["host", "wrapper"])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, wrapper = None, Wrapper()
        row = lambda: pa.record_batch([pa.array([host]), pa.array([wrapper.dumps()])], names=["host", "wrapper"])
        for b in batches:
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if h != host:
                    if host is not None:
                        yield row()
                    host, wrapper = h, Wrapper()
                wrapper.join(Wrapper.loads(text))
        if host is not None:
            yield row()

    parts = pages.select("url", "html").mapInArrow(partial, "host string, wrapper string")
    return parts.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(folded, "host string, wrapper string")


def _main_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        main = [json.dumps(Wrapper.loads(w).main()) for w in b.column(1).to_pylist()]
        yield pa.record_batch([b.column(0), pa.array(main, pa.string())], names=["host", "main"])


def _host(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.record_batch([*b.columns, pa.array([host_of(u) for u in b.column(1).to_pylist()], pa.string())], names=[*b.schema.names, "host"])


@lru_cache(1 << 12)
def _places(main: str) -> dict[str, str]:
    return json.loads(main)


def extract(pages: DataFrame, between: str = "\n") -> DataFrame:
    """(page_id, url, text) of every page, blocks joined by ``between``."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            page, main = b.column(2).to_pylist(), b.column(3).to_pylist()
            text = [text_of(p or "", _places(m), between) for p, m in zip(page, main, strict=True)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select("page_id", "url", "html")
    main = cut_lineage(wrappers(rows).mapInArrow(_main_slots, "host string, main string"))
    size = main.agg(F.sum(F.length("main") + F.length("host"))).first()[0] or 0
    kind = rows.schema[0].dataType.simpleString()
    with_host = rows.mapInArrow(_host, f"page_id {kind}, url string, html string, host string")
    joined = with_host.join(F.broadcast(main) if size <= BROADCAST_BYTES else main, "host")
    return joined.select("page_id", "url", "html", "main").mapInArrow(texts, f"page_id {kind}, url string, text string")


def op9(pages: DataFrame, between: str = "\n") -> DataFrame:
    return extract(pages, between).withColumn("n_chars", F.length("text").cast("long"))
