"""A small HTML tokenizer: structure and text blocks of a page."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import xxhash

# Element names of HTML.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img br".split()
)
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
# An opening tag ends the open element of its kind, up to the element behind.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
# What a paragraph ends before.
PARAGRAPH_STOPS = frozenset("article aside section div main td th li dd body html blockquote form".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.DOTALL,
)
# Drawings and formulas nest; what looks like one in a comment or script is none.
_FOREIGN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b[^>]*>.*?</(?P=raw)\s*>"
    r"|<(?P<close>/?)(?P<name>svg|math)(?=[\s/>])(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL | re.I,
)
# A slash at the end of a tag, but not of an attribute's value without quotes.
_SELF_CLOSED = re.compile(r"(?:\A|[\s\"'/]|[\s\"'][^\s\"'=]*)/\s*\Z")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_LETTERS = re.compile(r"[A-Za-z]+")


class Element:
    """An open element. It knows what holds it and not its whole path, so that
    badly closed pages, whose elements nest without end, cost a step an element."""

    __slots__ = ("parent", "label", "number", "key")

    def __init__(self, parent: Element | None, label: str, number: int) -> None:
        self.parent, self.label, self.number = parent, label, number
        # Elements of the same path have the same key.
        self.key = xxhash.xxh64_intdigest(label.encode("utf-8", "replace"), parent.key) if parent else 0

    @property
    def name(self) -> str:
        return self.label.partition(".")[0]

    @property
    def words(self) -> list[str]:
        return self.label.split(".")[1:]

    @property
    def path(self) -> str:
        labels, at = [], self
        while at.parent:
            labels.append(at.label)
            at = at.parent
        return "".join(f"/{x}" for x in reversed(labels))


class Token(NamedTuple):
    kind: str  # "open", "close" or "text"
    element: Element  # what is opened or closed, or holds the text
    text: str  # of a block: decoded, with single spaces

    @property
    def path(self) -> str:
        """The elements that are open, each as name.class-name.id."""
        return self.element.path


def label(name: str, rest: str) -> str:
    """An element's name and the names in its class, id and role, each as its
    runs of letters with hyphens, so that numbered names are alike."""
    if not rest or "=" not in rest and "hidden" not in rest.lower():
        return name
    words = []
    for key, *values in _ATTRIBUTE.findall(rest):
        given = ["hidden"] if key.lower() == "hidden" else " ".join(values).split()
        words += ["-".join(_LETTERS.findall(w)).lower() for w in given]
    return ".".join([name, *filter(None, words)])


def _foreign_ends(html: str, at: int) -> dict[int, int]:
    """Where each svg and math element ends, by the end of its opening tag. One
    that is self-closed or never closed has no entry: it is empty."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {"svg": [], "math": []}
    for m in _FOREIGN.finditer(html, at):
        if not m["name"]:
            continue
        inside = opened[m["name"].lower()]
        if not m["close"]:
            if not _SELF_CLOSED.search(m["rest"]):
                inside.append(m.end())
        elif inside:
            ends[inside.pop()] = m.end()
    return ends


# What an opening tag ends, one rule after the other; the last is for all others.
_RULES = [*ENDS.values(), ({"p"}, PARAGRAPH_STOPS)]
_RULE_OF = {name: i for i, name in enumerate(ENDS)}
_IN_RULES = frozenset().union(*(kinds | stops for kinds, stops in _RULES))


class _Open:
    """The open elements, the deepest last."""

    def __init__(self) -> None:
        self.elements = [Element(None, "", 0)]
        self.made = 1
        self.places: dict[str, list[int]] = {}
        # Per depth and rule the place of the element that an opening tag ends.
        self.ends: list[tuple[int, ...]] = [(-1,) * len(_RULES)]

    def make(self, label_: str) -> Element:
        self.made += 1
        return Element(self.elements[-1], label_, self.made - 1)

    def push(self, element: Element, name: str) -> None:
        place, ends = len(self.elements), self.ends[-1]
        if name in _IN_RULES:
            ends = tuple(
                place if name in kinds else -1 if name in stops else end for (kinds, stops), end in zip(_RULES, ends)
            )
        self.elements.append(element)
        self.ends.append(ends)
        self.places.setdefault(name, []).append(place)

    def pop(self) -> Element:
        self.ends.pop()
        element = self.elements.pop()
        self.places[element.name].pop()
        return element


def tokens(html: str) -> list[Token]:
    """The tags and text blocks of a page in order. Inline elements do not part
    blocks; comments, declarations and the content of raw elements are left
    out; elements that are not closed end with what holds them. The work is
    linear in the page, however deep it nests."""
    out: list[Token] = []
    parts: list[str] = []
    open_ = _Open()

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append(Token("text", open_.elements[-1], text))

    def close(place: int) -> None:
        while len(open_.elements) > place:
            out.append(Token("close", open_.pop(), ""))

    at, size = 0, len(html)
    foreign: dict[int, int] | None = None
    while at < size:
        m = _TAG.search(html, at)
        between = html[at : m.start() if m else size]
        if between:
            parts.append(unescape(between) if "&" in between else between)
        if not m:
            break
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if not m["close"] and name in ("svg", "math"):
            if foreign is None:
                foreign = _foreign_ends(html, m.start())
            at = foreign.get(at, at)
            continue
        if not m["close"] and name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else size
            continue
        if name in INLINE:
            if name in ("br", "wbr", "img"):
                parts.append(" " if name == "br" else "")
            continue
        flush()
        if m["close"]:
            if open_.places.get(name):
                close(open_.places[name][-1])
            continue
        end_place = open_.ends[-1][_RULE_OF.get(name, -1)]
        if end_place >= 0:
            close(end_place)
        element = open_.make(label(name, m["rest"]))
        out.append(Token("open", element, ""))
        if name not in VOID:
            open_.push(element, name)
    flush()
    close(1)
    return out
