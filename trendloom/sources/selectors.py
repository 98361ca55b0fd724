"""Selectors over pages: compiled once, matched in one pass over the parse events.

A selector is a list of chains (``nav li, ul > li.main``). A chain joins parts by blanks (anywhere
inside) or ``>`` (directly inside); a part names any of a tag, ``#id``, ``.class``, ``[attr]`` and
``[attr=value]``, or ``*``. Each open element keeps as bits how far every chain has come at it and
above it, so a start tag is matched against its parent only, however deep the page is.

End tags may be left out where browsers add them: list items, paragraphs, cells, rows, options.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from html.parser import HTMLParser

_PART = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[[^\]]+\])*)$")
_MARK = re.compile(r"([.#])([\w-]+)|\[\s*([\w-]+)\s*(?:=\s*[\"']?([^\"'\]]*)[\"']?\s*)?\]")

# Fixed values of HTML: elements without content, raw text, and what ends an element left open.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset(("script", "style"))
_ENDS_P = (
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt listing main menu nav ol p plaintext pre search section summary table ul xmp"
).split()
_IN_LIST, _IN_TABLE = frozenset(("ul", "ol", "menu")), frozenset(("table",))
_IN_P = frozenset("button td th caption object marquee applet template html".split())
_LEFT_OPEN = {
    "li": (frozenset(("li",)), _IN_LIST),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (frozenset(("td", "th")), _IN_TABLE),
    "th": (frozenset(("td", "th")), _IN_TABLE),
    "tr": (frozenset(("tr",)), _IN_TABLE),
    "thead": (frozenset(("tr", "thead", "tbody", "tfoot")), _IN_TABLE),
    "tbody": (frozenset(("tr", "thead", "tbody", "tfoot")), _IN_TABLE),
    "tfoot": (frozenset(("tr", "thead", "tbody", "tfoot")), _IN_TABLE),
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
}
_P = frozenset(("p",))


@dataclass(frozen=True)
class Part:
    tag: str | None
    classes: frozenset[str]
    attributes: tuple[tuple[str, str | None], ...]
    child: bool  # directly inside the element of the part before

    def fits(self, tag: str, attributes: dict[str, str], classes: frozenset[str]) -> bool:
        if self.tag is not None and self.tag != tag or not self.classes <= classes:
            return False
        return all(n in attributes and v in (None, attributes[n]) for n, v in self.attributes)


Chains = tuple[tuple[Part, ...], ...]


def compile_selector(selector: str) -> Chains:
    """The chains of a selector; what is not described above raises."""
    chains = []
    for chain in re.split(r",(?![^\[]*\])", selector):
        parts, child = [], False
        for word in re.findall(r">|(?:\[[^\]]*\]|[^\s>])+", chain):
            if word == ">":
                if child or not parts:
                    raise ValueError(f"selector {selector!r}: > without a part before")
                child = True
                continue
            found = _PART.match(word)
            marks = [m for m in _MARK.finditer(found.group(2))] if found else []
            if not found or "".join(m.group(0) for m in marks) != found.group(2):
                raise ValueError(f"selector {selector!r}: {word!r} is not supported")
            tag = (found.group(1) or "*").lower()
            classes = frozenset(m.group(2) for m in marks if m.group(1) == ".")
            pairs = tuple(
                ("id", m.group(2)) if m.group(1) else (m.group(3).lower(), m.group(4)) for m in marks if m.group(1) != "."
            )
            parts.append(Part(None if tag == "*" else tag, classes, pairs, child))
            child = False
        if child or not parts:
            raise ValueError(f"selector {selector!r}: a chain without a last part")
        chains.append(tuple(parts))
    return tuple(chains)


@dataclass
class Found:
    """The text of a matching element, and the first cell inside it."""

    pieces: list[str] = field(default_factory=list)
    cell: Found | None = None

    @property
    def text(self) -> str:
        return "".join(self.pieces).strip()


class _Open:
    """An element that is open: bits of chain parts matched here, here or above, and its matches."""

    __slots__ = ("tag", "own", "seen", "found", "rows")

    def __init__(self, tag: str, own: int, seen: int):
        self.tag, self.own, self.seen = tag, own, seen
        self.found: Found | None = None
        self.rows: list[Found] = []


class Finder(HTMLParser):
    """All matches of several selectors, in page order, and of a cell selector inside them."""

    def __init__(self, selectors: Sequence[Chains], cell: Chains = ()):
        super().__init__(convert_charrefs=True)
        self.matches: list[list[Found]] = [[] for _ in selectors]
        self.open: list[_Open] = []
        self.parts: list[tuple[Part, int, int, list[int]]] = []  # part, bit, bit of the part before, selectors it ends
        for at, chains in enumerate([*selectors, cell]):
            for chain in chains:
                before = 0
                for i, part in enumerate(chain):
                    bit = 1 << len(self.parts)
                    self.parts.append((part, bit, before, [at] if i == len(chain) - 1 else []))
                    before = bit

    def handle_starttag(self, tag, attrs):
        self._end_what_was_left_open(tag)
        if tag in _VOID:
            return
        attributes = {name: value or "" for name, value in reversed(attrs)}  # of repeated ones the first counts
        classes = frozenset(attributes.get("class", "").split())
        above = self.open[-1] if self.open else _Open("", 0, 0)
        own, ends = 0, set()
        for part, bit, before, last in self.parts:
            if (not before or (above.own if part.child else above.seen) & before) and part.fits(tag, attributes, classes):
                own |= bit
                ends.update(last)
        element = _Open(tag, own, own | above.seen)
        if ends:
            element.found = Found()
            if len(self.matches) in ends:
                for outer in self.open:
                    for row in outer.rows:
                        row.cell = row.cell or element.found
            for at in sorted(ends - {len(self.matches)}):
                row = Found(element.found.pieces)
                self.matches[at].append(row)
                element.rows.append(row)
        self.open.append(element)

    def _end_what_was_left_open(self, tag: str) -> None:
        if tag in _LEFT_OPEN:
            self._close(*_LEFT_OPEN[tag])
        if tag in _ENDS_P:
            self._close(_P, _IN_P)

    def _close(self, tags: frozenset[str], bounds: frozenset[str]) -> None:
        """End the outermost of ``tags`` inside the nearest of ``bounds``, with all it holds."""
        outermost = None
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag in tags:
                outermost = depth
            elif self.open[depth].tag in bounds:
                break
        if outermost is not None:
            del self.open[outermost:]

    def handle_endtag(self, tag):
        bounds = _IN_P if tag == "p" else _LEFT_OPEN[tag][1] if tag in _LEFT_OPEN else ()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return
            if self.open[depth].tag in bounds:
                return

    def handle_data(self, data):
        raw = bool(self.open) and self.open[-1].tag in _RAW
        for element in self.open[-1:] if raw else self.open:
            if element.found is not None:
                element.found.pieces.append(data)


def find(html: str | None, selectors: Sequence[Chains], cell: Chains = ()) -> list[Found]:
    """Matches of the first selector that matches anything."""
    finder = Finder(selectors, cell)
    finder.feed(html or "")
    finder.close()
    return next((found for found in finder.matches if found), [])
