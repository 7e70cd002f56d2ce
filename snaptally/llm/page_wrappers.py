"""Main text of web pages by union-free wrapper inference.

A *wrapper* is a regular expression over tags without alternatives: sequences in which
parts may be optional (``?``) or repeated (``+``), and text slots, which hold either one
text on all pages or varying ones. Every host has one. It begins as the host's first
page, and each further page is aligned with it element by element:

* an element that the wrapper hasn't at this place goes in as optional, one that the page
  lacks becomes optional;
* an element that comes again after its place was passed makes the stretch from its
  place on a repeated group, so each kind of element has one place among its siblings;
* a text that differs from a slot's text makes the slot a varying one.

Wrappers are aligned with each other in the same way, so tasks make wrappers of their own
pages and Spark rounds bring those of a host together, a bounded number at a time. What a
wrapper counted on the way (text, link text, pages) says what its parts are: menus,
adverts and other furniture by their names, by link text and by text that never varies;
the article by its name, else by holding most of the text that varies. Pages are then read
along their host's wrapper.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._flat import parts, record, release, texts_of
from ._html import BLOCKS, RAW, Element, parse
from ._shared import written

PAGE_BYTES = 4 << 20  #: html read at once
MOST_KINDS = 48  #: kinds of children with their own names; further ones go by tag, then together
HELD_HOSTS = 2_000  #: wrappers that a task holds before it hands them on
FAN_IN = 256  #: wrappers of a host brought together in one task of a round
SENT_BYTES = 64 << 20  #: wrappers broadcast; beyond, they are joined to the pages by host

# words of class, id and role that name furniture
FURNITURE = frozenset(
    """ad ads adv advert adverts advertisement advertising advertorial alert banner breadcrumb breadcrumbs comment comments commentlist
    complementary consent contentinfo cookie cookies dialog discussion disqus flyout foot footer gdpr login menu menubar modal nav
    navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promotion recommendations
    recommended related replies respond responses rss search share sharing sidebar signup skip skyscraper social sponsor sponsored
    sponsors subscribe subscription tagcloud toast toolbar topbar tracking widget widgets""".split()
)
_ENDINGS, _BEGINNINGS = ("nav", "menu", "footer", "sidebar", "banner", "comments"), ("cookie", "advert", "sponsor", "newsletter", "breadcrumb", "sidebar", "navbar")
HEADERS = frozenset("header head masthead".split())
#: tags that are never part of an article's text
NEVER = frozenset("script style noscript template iframe noembed noframes svg math canvas object embed audio video head title textarea nav aside footer button select datalist dialog menu option input label".split())
#: names of an article's own element, when no tag says it
ARTICLE = frozenset("article articlebody post story entry hentry body text content main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: headings that begin reader comments
_COMMENTS = re.compile(r"(?:\d+ )?(?:reader |user )?(?:comments?|replies|responses|kommentare?|commentaires?|comentarios?)(?: \(?\d+\)?)?:?|(?:leave|post|write|add) (?:a|your) (?:comment|reply)", re.I)

VARIES = -1


def is_furniture(words) -> bool:
    return any(w in FURNITURE or w.endswith(_ENDINGS) or w.startswith(_BEGINNINGS) for w in words)


def is_header(element: Element) -> bool:
    return element.tag == "header" or not HEADERS.isdisjoint(element.words)


def _hash(text: str) -> int:
    """A positive 62-bit hash that is the same in every process."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") >> 2 or 1


class Slot:
    """A part of a wrapper. ``n``: how often it was met; ``chars`` and ``linked``: letters
    of its text, and those within links; ``value``: the hash of the one text it always
    has, or VARIES; ``loops``: stretches of its children that repeat."""

    __slots__ = ("key", "n", "optional", "chars", "linked", "value", "children", "loops", "place")

    def __init__(self, key: str):
        self.key, self.n, self.optional, self.chars, self.linked, self.value = key, 0, False, 0, 0, 0
        self.children: list[Slot] = []
        self.loops: list[tuple[int, int]] = []
        self.place: dict[str, int] = {}

    def find(self, key: str) -> Slot | None:
        """The part for a kind of child: its own, its tag's, or the common one."""
        for name in (key, key.partition(".")[0], "*"):
            if name in self.place:
                return self.children[self.place[name]]
        return None

    def _enter(self, key: str, after: int) -> Slot:
        """The part for a kind of child; a new one goes in behind ``after``."""
        if key not in self.place and len(self.children) >= MOST_KINDS:
            if (known := self.find(key)) is not None:
                return known
            key = "*" if len(self.children) >= 2 * MOST_KINDS else key.partition(".")[0]
        if key not in self.place:
            child = Slot(key)
            child.optional = self.n > 0
            self.children.insert(after + 1, child)
            self.loops = [(a + (a > after), b + (b > after)) for a, b in self.loops]
            self.place = {c.key: i for i, c in enumerate(self.children)}
        return self.children[self.place[key]]

    def _loop(self, first: int, last: int) -> None:
        """A stretch repeats; stretches that share a part become one."""
        apart = [x for x in self.loops if x[1] < first or x[0] > last]
        joined = [x for x in self.loops if x not in apart] + [(first, last)]
        self.loops = sorted([*apart, (min(a for a, _ in joined), max(b for _, b in joined))])

    def _note(self, n: int, value: int, seen: set[str]) -> None:
        if self.n:
            for child in self.children:
                child.optional = child.optional or child.key not in seen
        self.value = value if not self.n or self.value == value else VARIES
        self.n += n

    def align(self, page: Element, linked: bool = False) -> tuple[int, int, int]:
        """Take in one more element. Returns its text's letters, those in links, and hash."""
        chars = inside = value = 0
        linked = linked or page.tag == "a"
        at, seen = -1, set()
        for kind, part in _pieces(page):
            child = self._enter(kind, at)
            now = self.place[child.key]
            if now <= at:
                self._loop(now, at)
            at = now
            seen.add(child.key)
            if isinstance(part, str):
                c, i, v = len(part), len(part) if linked else 0, _hash(part)
                child._note(1, v, set())
                child.chars, child.linked = child.chars + c, child.linked + i
            else:
                c, i, v = child.align(part, linked)
            chars, inside = chars + c, inside + i
            value = _pair(value, v) if v else value
        self._note(1, value, seen)
        self.chars, self.linked = self.chars + chars, self.linked + inside
        return chars, inside, value

    def join(self, other: Slot) -> None:
        """Take in another wrapper of the same kind of element."""
        at, names = -1, []
        for theirs in other.children:
            child = self._enter(theirs.key, at)
            now = self.place[child.key]
            if now <= at:
                self._loop(now, at)
            at = now
            names.append(child.key)
            child.optional = child.optional or theirs.optional
            child.join(theirs)
        for a, b in other.loops:
            span = [self.place[x] for x in names[a : b + 1]]
            self._loop(min(span), max(span))
        if other.n:
            self._note(other.n, other.value, set(names))
        self.chars, self.linked = self.chars + other.chars, self.linked + other.linked

    def packed(self) -> list:
        return [self.key, self.n, int(self.optional), self.chars, self.linked, self.value, [c.packed() for c in self.children], self.loops]

    @classmethod
    def unpacked(cls, row: list) -> Slot:
        out = cls(row[0])
        _, out.n, optional, out.chars, out.linked, out.value, children, loops = row
        out.optional = bool(optional)
        out.children = [cls.unpacked(c) for c in children]
        out.loops = [tuple(x) for x in loops]
        out.place = {c.key: i for i, c in enumerate(out.children)}
        return out

    def expression(self) -> str:
        """The wrapper as an expression: ``<div.menu>(<a>TEXT</a>)+</div>``; a text that
        never varies is ``FIXED``."""
        if self.key == "#":
            out = "TEXT" if self.value == VARIES else "FIXED"
            return f"({out})?" if self.optional else out
        pieces = [c.expression() for c in self.children]
        for a, b in self.loops:
            pieces[a] = "(" + pieces[a]
            pieces[b] += ")+"
        inner = "".join(pieces)
        if self.key != "#root":
            inner = f"<{self.key}>{inner}</{self.key.partition('.')[0]}>"
        return f"({inner})?" if self.optional else inner


def _pair(a: int, b: int) -> int:
    return (a * 0x5851F42D4C957F2D + b * 0x14057B7EF767814F + 1) & 0x3FFFFFFFFFFFFFFF


def _pieces(element: Element):
    """Kind and content of an element's children: elements, and texts between them
    (``#``, white space as one space). Code and line breaks aren't pieces."""
    text = ""
    for c in element.children:
        if isinstance(c, str):
            text += c
        elif c.tag == "br":
            text += " "
        else:
            if text and (text := " ".join(text.split())):
                yield "#", text
            text = ""
            if c.tag not in RAW:
                yield c.key, c
    if text and (text := " ".join(text.split())):
        yield "#", text


class Wrapper:
    """A host's expression, and the first hashes of its pages' texts (8 at most), from
    which it knows whether there are different pages."""

    PAGES = 8

    def __init__(self):
        self.root, self.pages = Slot("#root"), set()

    def take(self, page: Element) -> None:
        self._page({self.root.align(page)[2]})

    def join(self, other: Wrapper) -> None:
        self.root.join(other.root)
        self._page(other.pages)

    def _page(self, more: set) -> None:
        self.pages = set(sorted(self.pages | more)[: self.PAGES])

    def pack(self) -> str:
        return json.dumps([sorted(self.pages), self.root.packed()], separators=(",", ":"))

    @classmethod
    def unpack(cls, text: str) -> Wrapper:
        out = cls()
        pages, root = json.loads(text)
        out.pages, out.root = set(pages), Slot.unpacked(root)
        return out


class Reader:
    """What a host's wrapper says about its parts."""

    def __init__(self, wrapper: Wrapper | None):
        self.root = wrapper.root if wrapper else Slot("#root")
        self.several = wrapper is not None and len(wrapper.pages) >= 3
        self.furniture: dict[tuple, bool] = {}
        self.holds: dict[int, bool] = {}
        self.letters: dict[int, int] = {}
        self.total = max(1, self._live(self.root))

    def _holds_article(self, slot: Slot) -> bool:
        """Whether an article or main element is inside."""
        if id(slot) not in self.holds:
            self.holds[id(slot)] = any(c.key.partition(".")[0] in ("article", "main") or self._holds_article(c) for c in slot.children)
        return self.holds[id(slot)]

    def drops(self, element: Element, slot: Slot | None) -> bool:
        """Whether an element is furniture: by its tag, its names, or its part of the wrapper."""
        if element.tag in NEVER or element.hidden:
            return True
        if slot is None:
            return is_furniture(element.words)
        known = (id(slot), element.words)
        if known not in self.furniture:
            self.furniture[known] = self._drops(element, slot)
        return self.furniture[known]

    def _drops(self, element: Element, slot: Slot) -> bool:
        named = is_furniture(element.words) or element.tag == "form"
        large = element.tag not in ("li", "p") and slot.chars > slot.linked and slot.chars - slot.linked >= 0.7 * (self.root.chars - self.root.linked)
        if named and not (self._holds_article(slot) or large):
            return True
        # one text on at least three different pages, in an element of its own kind
        return self.several and slot.n >= 3 and slot.value not in (0, VARIES) and element.tag in ("div", "section", "ul", "ol", "table", "center")

    def menu(self, slot: Slot | None) -> bool:
        """Whether most of a part's text is links, on the whole host."""
        return slot is not None and slot.chars > 0 and slot.linked >= 0.6 * slot.chars

    # --- reading a page

    def main(self, page: Element) -> list[tuple[Element, Slot | None]]:
        """The elements that hold the article, in page order."""
        found: dict[str, list] = {"article": [], "main": []}
        named: list[tuple[int, Element, Slot]] = []

        def walk(element: Element, slot: Slot | None, depth: int) -> None:
            for child, part in self.children(element, slot):
                if self.drops(child, part) or (is_header(child) and not (part is not None and self._holds_article(part))):
                    continue
                kind = "article" if child.tag == "article" or "articlebody" in child.words else "main" if child.tag == "main" else None
                if kind:
                    found[kind].append((child, part))
                if kind != "article":
                    if part is not None and child.tag in BLOCKS and child.tag != "body" and not ARTICLE.isdisjoint(child.words) and 2 * self._live(part) >= self.total:
                        named.append((depth, child, part))
                    walk(child, part, depth + 1)

        walk(page, self.root, 0)
        for kind in ("article", "main"):
            if found[kind]:
                full = [x for x in found[kind] if not self.menu(x[1])]
                return full or found[kind]
        if named:
            deepest = max(d for d, _, _ in named)
            return [(e, s) for d, e, s in named if d == deepest]
        element, slot = page, self.root
        while True:  # down to the part that has most of the host's text
            best = [(c, s) for c, s in self.children(element, slot) if s is not None and c.tag not in ("p", "li") and not is_header(c) and c.tag not in HEADINGS and not self.drops(c, s)]
            over = [(c, s) for c, s in best if self._live(s) >= 0.7 * max(1, self._live(slot))]
            if len(over) != 1:
                return [(element, slot)]
            element, slot = over[0]

    def _live(self, slot: Slot) -> int:
        """Letters of varying text outside links, and outside what is furniture by tag or name."""
        if id(slot) not in self.letters:
            tag, *words = slot.key.split(".")
            if tag == "#":
                out = 0 if self.several and slot.n >= 3 and slot.value != VARIES else slot.chars - slot.linked
            elif tag in NEVER or ((tag in ("header", "form") or not HEADERS.isdisjoint(words) or is_furniture(words)) and not self._holds_article(slot) and not self._large_name(slot, words)):
                out = 0
            else:
                out = sum(self._live(c) for c in slot.children)
            self.letters[id(slot)] = out
        return self.letters[id(slot)]

    def _large_name(self, slot: Slot, words: list[str]) -> bool:
        """Whether a part with a furniture name holds most of the host's text all the same."""
        return bool(words) and slot.chars - slot.linked >= 0.7 * (self.root.chars - self.root.linked)

    @staticmethod
    def children(element: Element, slot: Slot | None):
        for c in element.children:
            if not isinstance(c, str):
                yield c, slot.find(c.key) if slot is not None else None

    def text(self, page: Element) -> str:
        blocks: list[str] = []
        line: list[str] = []

        def end() -> None:
            text = " ".join("".join(line).split())
            line.clear()
            if text:
                blocks.append(text)

        def walk(element: Element, slot: Slot | None, named: bool) -> None:
            parts = {id(c): s for c, s in self.children(element, slot)}
            for c in element.children:
                if isinstance(c, str):
                    line.append(c)
                    continue
                if c.tag in ("br", "wbr"):
                    line.append(" " if c.tag == "br" else "")
                    continue
                part = parts[id(c)]
                if self.drops(c, part) or (not named and self.menu(part) and c.tag in ("div", "ul", "ol", "table", "section")):
                    if c.tag in BLOCKS:
                        end()
                    continue
                if c.tag in HEADINGS and _COMMENTS.fullmatch(_line(c)):
                    end()
                    return  # reader comments go on to the end of this element
                if is_header(c) and c.tag not in HEADINGS:
                    end()
                    blocks.extend(_headings(c) if named else [])
                    continue
                if c.tag in BLOCKS:
                    end()
                    walk(c, part, named)
                    end()
                else:
                    walk(c, part, named)

        for element, slot in self.main(page):
            named = element.tag in ("article", "main") or not ARTICLE.isdisjoint(element.words)
            walk(element, slot, named)
            end()
        return "\n".join(blocks)


def _line(element: Element) -> str:
    out: list[str] = []
    todo: list = [element]
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag not in NEVER:
            todo += reversed(c.children)
    return " ".join("".join(out).split())


def _headings(element: Element) -> list[str]:
    """Headings of an article's own header."""
    out, todo = [], [element]
    while todo:
        c = todo.pop()
        if isinstance(c, str) or c.tag in NEVER:
            continue
        if c.tag in HEADINGS:
            if text := _line(c):
                out.append(text)
        else:
            todo += reversed(c.children)
    return out


# --- Spark

_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"
_PACKED = pa.schema([("host", pa.string()), ("pages", pa.int64()), ("wrapper", pa.string())])


def host_of(url: str) -> F.Column:
    """The lower-cased host of a URL column; ``''`` for null and for text without one."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(f"`{url}`"), _HOST, 1)), F.lit(""))


def _html_parts(batches):
    yield from parts(batches, lambda b: texts_of(b.column("html")).lengths, PAGE_BYTES)


def _emit(held: dict[str, Wrapper]) -> pa.RecordBatch:
    names = list(held)
    return record(_PACKED, names, [held[h].root.n for h in names], [held[h].pack() for h in names])


def _of_pages(batches):
    held: dict[str, Wrapper] = {}
    for part in _html_parts(batches):
        for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
            if html:
                if host not in held and len(held) >= HELD_HOSTS:
                    yield _emit(held)
                    held = {}
                held.setdefault(host, Wrapper()).take(parse(html))
    yield _emit(held)
    release()


def _of_wrappers(batches):
    """Neighbouring rows of one host and share brought together."""
    last, held = None, Wrapper()
    for part in batches:
        for host, share, text in zip(part.column("host").to_pylist(), part.column("share").to_pylist(), part.column("wrapper").to_pylist(), strict=True):
            if (host, share) != last:
                if last is not None:
                    yield _emit({last[0]: held})
                last, held = (host, share), Wrapper()
            held.join(Wrapper.unpack(text))
    if last is not None:
        yield _emit({last[0]: held})


def wrappers(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """One row for each host: ``host``, ``pages`` (with html), ``wrapper`` (its packed form).

    A task holds the wrappers of its own pages; rounds bring together ``FAN_IN`` of a host at
    a time, so a host with a third of all pages is many shares. A wrapper's size is
    bounded by the kinds of elements, not by pages.
    """
    rows = pages.select(host_of(url).alias("host"), F.col(f"`{html}`").alias("html"))
    schema = "host string, pages long, wrapper string"
    found = written(rows.mapInArrow(_of_pages, schema))
    while True:
        most = found.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return found
        shares = -(-most // FAN_IN)
        dealt = found.withColumn("share", F.pmod(F.monotonically_increasing_id(), F.lit(shares)).cast("int"))
        found = written(dealt.repartition("host", "share").sortWithinPartitions("host", "share").mapInArrow(_of_wrappers, schema))


def expressions(found: DataFrame) -> DataFrame:
    """``host, pages, expression`` of :func:`wrappers`' rows, for reading."""

    def run(batches):
        for part in batches:
            yield record(_PACKED, part.column("host"), part.column("pages"), [Wrapper.unpack(x).root.expression() for x in part.column("wrapper").to_pylist()])

    return found.mapInArrow(run, "host string, pages long, wrapper string").withColumnRenamed("wrapper", "expression")


RESULTS = ("text", "n_chars")


def main_text(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", keep: tuple[str, ...] = (), sent_bytes: int = SENT_BYTES) -> DataFrame:
    """The article of every page, read along its host's wrapper.

    Returns a row for each row: id and url as they are, the columns named in ``keep``,
    ``text`` (blocks in page order, white space in each as one space, joined by a line
    break; ``''`` if none) and ``n_chars`` (its code points).

    Null and empty html give an empty text. Null urls and urls without a host share the
    host ``''``. Rows that repeat give equal results each; copies of one page never make
    its text fixed. A kept column named like a result, id or url is left out. An empty table
    gives an empty result. Wrappers above ``sent_bytes`` are joined to the pages
    instead of broadcast, with the same result.
    """
    spark = pages.sparkSession
    keep = tuple(c for c in keep if c not in RESULTS and c not in (id, url))
    found = wrappers(pages, url=url, html=html)
    size = found.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    rows = pages.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{url}`").alias("__url"), *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)], host_of(url).alias("host"), F.col(f"`{html}`").alias("html"))
    shared = None
    if size <= sent_bytes:
        shared = spark.sparkContext.broadcast({r["host"]: r["wrapper"] for r in found.collect()})
    else:
        rows = rows.join(found.select(F.col("host").alias("__host"), "wrapper"), F.col("host") == F.col("__host"), "left").drop("__host")
    fields = [pages.select(f"`{c}`").schema[0] for c in (id, url, *keep)]
    names = [id, url, *keep, "text", "n_chars"]
    schema = ", ".join([f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, fields, strict=False)] + ["text string, n_chars long"])
    head = len(fields)

    def run(batches):
        readers: dict[str, Reader] = {}
        for part in _html_parts(batches):
            texts = []
            packed = part.column("wrapper") if shared is None else None
            for i, (host, html) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True)):
                if not html:
                    texts.append("")
                    continue
                if host not in readers:
                    if len(readers) >= HELD_HOSTS:
                        readers = {}
                    wrapper = shared.value.get(host) if shared is not None else packed[i].as_py()
                    readers[host] = Reader(Wrapper.unpack(wrapper) if wrapper else None)
                texts.append(readers[host].text(parse(html)))
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(head)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)
        release()

    return rows.mapInArrow(run, schema)


def op12_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Page, url, main text and its length of all pages."""
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
