"""A tolerant HTML reader: elements with their children, for whole pages of any size.

It follows the parts of the HTML rules that decide which text belongs where: comments,
raw-text elements, void elements, and end tags that may be left out. Nothing raises on
bad markup. Elements deeper than ``MAX_DEPTH`` are read as part of the one at that depth;
their text stays.
"""

from __future__ import annotations

import re
from html import unescape

MAX_DEPTH = 60

_TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:--!?>|$(?![\s\S])))|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|$(?![\s\S]))|[!?/][^>]*+(?:>|$(?![\s\S])))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_NUMBERED = re.compile(r"[A-Za-z]+\d{1,2}")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^\W\d_]+")

RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var".split())
#: elements that end an open paragraph
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
BLOCKS = _ENDS_P | frozenset("li dt dd tr td th caption thead tbody tfoot legend summary option body html head".split())
#: elements that end an open one of the second kind, up to one of the third
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "a": ({"a"}, {"td", "th", "div", "article", "section", "body"}),
}
_SCOPE = frozenset("td th caption table".split())
_TABLE = frozenset("table tr td th tbody thead tfoot caption body html".split())


class Element:
    """A tag with the lower-cased words of its class, id and role. ``key``: its kind, with
    short names that end in a number (x1) as they are; ``children`` are elements and texts
    (references decoded, white space as it is)."""

    __slots__ = ("tag", "words", "key", "hidden", "children")

    def __init__(self, tag: str, words: tuple[str, ...] = (), marks: tuple[str, ...] = (), hidden: bool = False):
        self.tag, self.words, self.hidden, self.children = tag, words, hidden, []
        self.key = ".".join((tag, *words, *marks)) if words or marks else tag


def words_of(name: str) -> list[str]:
    """The letters-only words of a class or id, also at changes of case (adBox: ad, box)."""
    return [w.lower() for w in _PART.findall(name)]


def _made(tag: str, rest: str) -> Element:
    if "=" not in rest and "hidden" not in rest:
        return Element(tag)
    words: list[str] = []
    marks: list[str] = []
    hidden = False
    for m in _ATTRIBUTE.finditer(rest):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "itemprop"):
            for w in words_of(unescape(value)):
                if w not in words:
                    words.append(w)
            marks += [x.lower() for x in value.split() if _NUMBERED.fullmatch(x)]
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    return Element(tag, tuple(words), tuple(marks), hidden)


def parse(html: str) -> Element:
    """The page as one element ``#root``."""
    root = Element("#root")
    stack = [root]
    extra: dict[str, int] = {}  # open elements below the deepest level
    at = 0

    def close(tags, until) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return close(tags, until)
            if stack[i].tag in until:
                return

    while True:
        m = _TAG.search(html, at)
        text = html[at : m.start() if m else len(html)]
        if text:
            stack[-1].children.append(unescape(text) if "&" in text else text)
        if not m:
            return root
        at = m.end()
        if not m[2]:
            continue  # a comment, doctype or the like
        tag = m[2].lower()
        if m[1]:
            if extra.get(tag):
                extra[tag] -= 1
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in _SCOPE and tag not in _TABLE:
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else len(html)
            made = _made(tag, m[3])
            made.children.append(html[at:stop])
            stack[-1].children.append(made)
            at = stop
            if end:
                close_at = html.find(">", end.end())
                at = close_at + 1 if close_at >= 0 else len(html)
            continue
        if tag in _ENDS_P:
            close({"p"}, _SCOPE)
        if tag in _ENDS:
            close(*_ENDS[tag])
        made = _made(tag, m[3])
        if tag in INLINE and not made.words and not made.hidden:
            continue  # no more than its text
        if tag in VOID:
            stack[-1].children.append(made)
        elif len(stack) > MAX_DEPTH:
            extra[tag] = extra.get(tag, 0) + 1
            if tag in BLOCKS:
                stack[-1].children.append(Element("br"))
        else:
            stack[-1].children.append(made)
            if not m[3].endswith("/") or tag in BLOCKS:
                stack.append(made)
