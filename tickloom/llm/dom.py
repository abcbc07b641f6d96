"""A forgiving HTML reader that yields the tree of block elements of a page and the text runs in it."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_QUOTE_OR_END = re.compile("[>\"']")
#: Elements that hold no page text.
RAW = frozenset("script style template iframe".split())
_RAW_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in [*RAW, "title", "desc", "metadata"]}
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big canvas cite code data del dfn em font i ins kbd mark object q rb rp rt rtc ruby s samp small span strike strong sub sup time tt u var wbr"
    " math semantics annotation mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover"
    " svg circle defs ellipse g line path polygon polyline rect text tspan use".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track".split())
#: Elements that an opening tag ends, when they are the innermost open block, without a closing tag.
_ENDS = {
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}


class Page:
    """Block elements in page order: ``tags``, ``attrs``, ``parents``; ``runs``: (node, text, characters in links)."""

    __slots__ = ("attrs", "parents", "runs", "tags")

    def __init__(self):
        self.tags, self.attrs, self.parents, self.runs = ["#page"], [""], [-1], []


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag, names in lower case."""
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(source)}


def tokens(source: str) -> Iterator[tuple[str, str, str, str]]:
    """``(text, slash, tag, attributes)`` in page order; text has an empty tag.

    One cursor moves forward: what a search has shown to be absent is not searched again, so the time is linear in the
    length of any source.  A tag ends at the next ``>`` outside quotes; a quote that never closes is no quote, and once
    a tag has no end outside quotes, quotes count no more.  Without any further ``>`` the rest is text.  Comments and raw
    elements that never close reach to the end.
    """
    at, n = 0, len(source)
    last = {q: source.rfind(q) for q in "\"'>"}
    quotes, in_svg = True, False

    def end_of_tag(i: int) -> int:
        while m := _QUOTE_OR_END.search(source, i):
            q, i = m[0], m.end()
            if q == ">":
                return m.start()
            if last[q] >= i:
                i = source.find(q, i) + 1
        return -1

    while at < n:
        opens = source.find("<", at)
        if opens < 0:
            opens = n
        if opens > at:
            yield source[at:opens], "", "", ""
            at = opens
            continue
        if source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        slash = "/" if source.startswith("/", at + 1) else ""
        name = _NAME.match(source, at + 1 + len(slash)) if last[">"] > at else None
        if name is None:
            if source[at + 1 : at + 2] in ("!", "?", "/"):
                end = source.find(">", at) if last[">"] > at else -1
                at = n if end < 0 else end + 1
            else:
                yield "<", "", "", ""
                at += 1
            continue
        end = end_of_tag(name.end()) if quotes else -1
        if end < 0:
            quotes = False
            end = source.find(">", name.end())
        tag, attrs, at = name[0].lower(), source[name.end() : end], end + 1
        if tag == "svg":
            in_svg = not slash and not attrs.endswith("/")
        elif in_svg and tag not in INLINE and tag not in _RAW_ENDS:
            in_svg = False  # a drawing that is not closed ends where the page's blocks go on
        if not slash and (tag in RAW or in_svg and tag in _RAW_ENDS):
            closes = _RAW_ENDS[tag].search(source, at)
            at = closes.end() if closes else n
            continue
        yield "", slash, tag, attrs


def read(source: str | None) -> Page:
    """The page of a source text; any text gives some page."""
    page, stack, links = Page(), [0], 0
    tags, attrs, parents, runs = page.tags, page.attrs, page.parents, page.runs
    opened: Counter = Counter()
    parts: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                runs.append((stack[-1], text, linked))
            parts.clear()
        linked = 0

    def leave(depth: int) -> None:
        opened.subtract(tags[k] for k in stack[depth:])
        del stack[depth:]

    for piece, close, tag, source_attrs in tokens(source or ""):
        if not tag:
            parts.append(piece)
            if links:
                linked += len(piece)
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if close else 1
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if close:
            if opened[tag]:
                leave(next(k for k in range(len(stack) - 1, 0, -1) if tags[stack[k]] == tag))
                links = 0
            continue
        if tag in VOID:
            continue
        if tag in _ENDS:
            while len(stack) > 1 and tags[stack[-1]] in _ENDS[tag]:
                leave(len(stack) - 1)
        elif len(stack) > 1 and tags[stack[-1]] == "p":
            leave(len(stack) - 1)  # a paragraph ends where another block begins
        tags.append(tag)
        attrs.append(source_attrs)
        parents.append(stack[-1])
        links = 0
        if not source_attrs.endswith("/"):
            stack.append(len(tags) - 1)
            opened[tag] += 1
    flush()
    return page
