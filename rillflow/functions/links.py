"""Links in Markdown and HTML as column expressions: scanning, targets and keys."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_BRACKET = re.compile(r"[\[\]]")
_SCANNED = pa.struct([("gaps", pa.list_(pa.string())), ("hits", pa.list_(pa.struct([(n, pa.string()) for n in ("whole", "label", "url", "title")])))])


class _Next:
    """Where the next match of a pattern stands, for places that only grow: a text is searched once."""

    def __init__(self, pattern: str, text: str):
        self.text, self.search, self.at, self.found = text, re.compile(pattern).search, -1, -1

    def __call__(self, at: int) -> int:
        if not self.at <= at <= self.found:
            m = self.search(self.text, at)
            self.at, self.found = at, m.start() if m else len(self.text)
        return self.found


def _addresses(text: str) -> Callable[[int], tuple[int, int, int, int] | None]:
    """A function of where the inside of parentheses begins, asked in rising order: begin and end of the address, ends of its title and of it all."""
    shown, stop, past, quote = (_Next(p, text) for p in (r"\S", r"[\s)]", r"\S", '"'))

    def address(at: int) -> tuple[int, int, int, int] | None:
        start = shown(at)
        end = stop(start)
        after = title = past(end)
        if end < after and text.startswith('"', after):
            title = quote(after + 1) + 1
            after = re.compile(r"\s*").match(text, title).end()
        else:
            title = end
        return (start, end, title, after + 1) if start < end and text.startswith(")", after) else None

    return address


_Span = tuple[int, int, tuple[int, int, int, int]]


def _links(text: str) -> Iterator[_Span]:
    """Links by where they start, with the end of the label; brackets are paired, and a label may hold pairs that hold none themselves."""
    address = _addresses(text)
    opened: list[list[int]] = []  # start, levels of pairs inside
    found = []
    for m in _BRACKET.finditer(text):
        at = m.start()
        if text[at] == "[":
            opened.append([at, 0])
        elif opened:
            start, inside = opened.pop()
            if opened:
                opened[-1][1] = max(opened[-1][1], inside + 1)
            image = start > 0 and text[start - 1] == "!"
            if inside <= 1 and not image and text.startswith("(", at + 1) and (to := address(at + 2)):
                found.append((start, at, to))
    yield from sorted(found)


def _images(text: str) -> Iterator[_Span]:
    """Images: an exclamation mark before a label that goes up to the next closing bracket."""
    address, closing = _addresses(text), _Next("]", text)
    for m in re.finditer(r"!\[", text):
        close = closing(m.end())
        if text.startswith("(", close + 1) and (to := address(close + 2)):
            yield m.start(), close, to


def scanner(images: bool = False) -> Callable[[Column], Column]:
    """A column function: Markdown -> struct(``hits``: whole, label, url, title; ``gaps``: the text around them, one more).

    Hits are links, or else images; of two that overlap the one that starts first counts. An
    address has no blanks and no closing parenthesis; a title is quoted and keeps the blanks before
    it. Brackets count also after a backslash. Null gives null.
    """
    each = _images if images else _links

    def scanned(text: str | None) -> dict | None:
        if text is None:
            return None
        gaps, hits, last = [], [], 0
        for start, close, (url, blank, title, end) in each(text) if "](" in text else ():
            if start >= last:
                gaps.append(text[last:start])
                label = text[start + 1 + images : close]
                hits.append({"whole": text[start:end], "label": label, "url": text[url:blank], "title": text[blank:title] or None})
                last = end
        return {"gaps": [*gaps, text[last:]], "hits": hits}

    @F.arrow_udf("struct<gaps:array<string>,hits:array<struct<whole:string,label:string,url:string,title:string>>>")
    def scan(text: pa.Array) -> pa.Array:
        return pa.array([scanned(t.as_py()) for t in text], _SCANNED)

    return scan


ANCHOR = r'<a\s[^>]*href="([^"]*)"[^>]*>((?s:.*?))</a>'  # a label may hold markup
# Kinds of targets by path, tried in this order.
TARGETS = (
    ("page", r"/courses/([0-9]+)/pages/([^/?#]+)"),
    ("item", r"/courses/([0-9]+)/modules/items/([0-9]+)"),
    ("assignment", r"/courses/([0-9]+)/assignments/([0-9]+)"),
    ("quiz", r"/courses/([0-9]+)/quizzes/([0-9]+)"),
    ("discussion", r"/courses/([0-9]+)/discussion_topics/([0-9]+)"),
    ("file", r"/courses/([0-9]+)/files/([0-9]+)"),
)


def decoded_slug(slug: Column) -> Column:
    """Percent-decoded and lower-case; a plus stays a plus, malformed escapes stay as they are."""
    return F.lower(F.coalesce(F.try_url_decode(F.replace(slug, F.lit("+"), F.lit("%2B"))), slug))


def url_key(url: Column, base_host: str) -> Column:
    """``kind:course:id`` of a URL on the base host (relative ones are), else null."""
    absolute = url.rlike(r"^(?i:[a-z][a-z0-9+.-]*:)?//")
    own = ~absolute | (F.lower(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)) == base_host.lower())
    path = F.regexp_replace(F.regexp_replace(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*", ""), r"[?#].*$", "")

    def key(kind: str, pattern: str) -> Column:
        ident = F.regexp_extract(path, pattern, 2)
        ident = decoded_slug(ident) if kind == "page" else ident
        return F.when(path.rlike(pattern), F.concat_ws(":", F.lit(kind), F.regexp_extract(path, pattern, 1), ident))

    other_scheme = url.rlike(r"^(?i:[a-z][a-z0-9+.-]*:)") & ~url.rlike(r"^(?i:https?:)")
    return F.when(own & ~other_scheme, F.coalesce(*[key(k, p) for k, p in TARGETS]))
