"""Events of an HTML page: tags with their paths, text runs with decoded references."""

from __future__ import annotations

import html
import re
from collections.abc import Container, Iterator
from dataclasses import dataclass

_EVENT = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I,
)
_TAG = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_READ = {"class", "id", "role", "itemprop", "hidden", "aria-hidden"}
_WORD = re.compile(r"[a-z]+")

# Element names and the words of class, id and role that mark what is no article text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "b", "bdi", "bdo", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "object", "audio", "video", "canvas"}
DROPPED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pagination", "popup", "promo",
    "promoted", "promotion", "recommended", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
MAIN_WORDS = {"main", "articlebody"}
# Elements of running text: left out for a whole name such as "notice", not for a part of one such as "related-work".
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
_CLOSED_BY = {"p": "p", "li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}


@dataclass(slots=True)
class Event:
    kind: str  # open, close, text or break
    name: str
    path: str  # of the element or of the text's element, without inline elements
    dropped: bool  # inside something that is no article text
    main: int  # 2 for an article, 1 for a main element, else 0
    text: str = ""
    number: int = 0  # of an element, in the order they open


def _kind_of(raw: str, name: str) -> tuple[str, bool, bool, int]:
    """Name with its classes and id; whether it is left out for what it is and for how it is called; how much it looks like the article."""
    label, dropped, called, main = name, name in DROPPED, False, 2 if name == "article" else 1 if name == "main" else 0
    if len(raw) > len(name) + 2:
        for key, a, b, c in _ATTRIBUTE.findall(raw, len(name) + 1):
            key, value = key.lower(), (a or b or c).lower()
            if key not in _READ:
                continue
            if key in ("hidden", "aria-hidden"):
                dropped = dropped or key == "hidden" or value == "true"
                continue
            words = _WORD.findall(value)
            label += f".{'-'.join(words)}"
            if name not in ("html", "body", "article", "main"):
                called = called or not DROPPED_WORDS.isdisjoint(value.split() if name in PROSE else words)
            if key != "class" and not MAIN_WORDS.isdisjoint(words):
                main = max(main, 1)
    return label, dropped, called, main


def events(page: str) -> Iterator[Event]:
    """The events in order. Where every article lies inside elements left out for their class, id or role, those wrappers stay."""
    found = list(_events(page, frozenset()))
    if not any(e.main for e in found):
        wrappers: set[int] = set()
        around: list[int] = []
        for e in _events(page, None):
            if e.kind == "open":
                around.append(e.number)
                if e.main:
                    wrappers.update(around)
            elif e.kind == "close" and around:
                around.pop()
        if wrappers:
            found = list(_events(page, wrappers))
    return iter(found)


def _events(page: str, kept: Container[int] | None) -> Iterator[Event]:
    """Events where the elements of the numbers ``kept`` (None: all) are not left out for how they are called."""
    number = 0
    stack: list[tuple[str, str, bool]] = []  # name, path, dropped
    for found in _EVENT.finditer(page):
        raw = found.group()
        path, dropped = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        if not raw.startswith("<") or raw == "<" or raw.startswith("<![CDATA["):
            yield Event("text", "", path, dropped, 0, html.unescape(raw))
            continue
        tag = _TAG.match(raw)
        if not tag or found.group(1):
            continue
        name = tag.group(1).lower()
        if name in VOID:
            if name in ("br", "hr"):
                yield Event("break", name, path, dropped, 0)
            continue
        if raw.startswith("</"):
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if at < 0 or name in INLINE and any(s[0] not in INLINE for s in stack[at + 1 :]):
                continue
            while len(stack) > at:
                inner, inner_path, inner_dropped = stack.pop()
                if inner not in INLINE:
                    yield Event("close", inner, inner_path, inner_dropped, 0)
            continue
        if name in INLINE:
            if not raw.endswith("/>"):
                stack.append((name, path, dropped))
            continue
        if name in _CLOSED_BY or name not in ("html", "body"):
            while stack and (stack[-1][0] in INLINE and name in _CLOSED_BY or stack[-1][0] == "p" or stack[-1][0] == _CLOSED_BY.get(name)):
                inner, inner_path, inner_dropped = stack.pop()
                if inner not in INLINE:
                    yield Event("close", inner, inner_path, inner_dropped, 0)
            path, dropped = (stack[-1][1], stack[-1][2]) if stack else ("", False)
        label, own, called, main = _kind_of(raw, name)
        number += 1
        path, dropped = f"{path}/{label}", dropped or own or called and kept is not None and number not in kept
        yield Event("open", name, path, dropped, 0 if dropped else main, number=number)
        if not raw.endswith("/>"):
            stack.append((name, path, dropped))
    while stack:
        inner, inner_path, inner_dropped = stack.pop()
        if inner not in INLINE:
            yield Event("close", inner, inner_path, inner_dropped, 0)
