"""HTML to Markdown: a small per-row converter in an Arrow UDF."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that start a block of their own, and those that are dropped with their text.
BLOCKS = frozenset("address article aside blockquote body caption dd div dl dt figure figcaption footer form h1 h2 h3 h4 h5 h6 header html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset("head script style title template noscript".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MOST_SPANNED = 1000  # columns that a cell can span in HTML
MARKS = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}


_MARKERS = dict.fromkeys((1, 2, 3))  # the converter's own marks, dropped from texts


def _cell(text: str) -> str:
    lines = [x.strip() for x in text.split("\n")]
    return re.sub(r"(?<!\\)\|", r"\\|", "<br>".join(x for x in lines if x))


class _Converter(HTMLParser):
    """Builds Markdown on a stack of open elements; each holds the text made inside it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict[str, str | int | None], list[str]]] = [("", {}, [])]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a = dict(attrs)
        if tag == "p" and any(t == "p" for t, *_ in self.open):
            self.handle_endtag("p")
        if tag == "br":
            self.say("  \n")
        elif tag == "hr":
            self.say("\n\n* * *\n\n")
        elif tag == "img" and a.get("src"):
            title = f' "{a["title"]}"' if a.get("title") else ""
            self.say(f"![{a.get('alt') or ''}]({a['src']}{title})")
        elif tag not in VOID:
            self.open.append((tag, a, []))

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, *_ in self.open[1:]):
            while self.open[-1][0] != tag:
                self.end()
            self.end()

    def handle_data(self, data: str) -> None:
        data = data.translate(_MARKERS)
        if any(t == "pre" for t, *_ in self.open):
            self.say(data)
        else:
            flat = re.sub(r"\s+", " ", data)
            self.say(re.sub(r"([\\`*_\[\]])", r"\\\1", flat))

    def say(self, text: str) -> None:
        self.open[-1][2].append(text)

    def end(self) -> None:
        tag, a, parts = self.open.pop()
        text = "".join(parts)
        hidden = re.search(r"\bcdbData\b", a.get("class") or "") or re.search(r"display:\s*none", a.get("style") or "", re.I)
        if tag in DROPPED or hidden:
            return
        inner = text.strip()
        if re.fullmatch("h[1-6]", tag):
            text = f"\n\n{'#' * int(tag[1])} {inner}\n\n" if inner else ""
        elif tag in MARKS:
            text = f"{MARKS[tag]}{inner}{MARKS[tag]}" if inner else ""
        elif tag == "a" and a.get("href"):
            title = f' "{a["title"]}"' if a.get("title") else ""
            text = f"[{inner}]({a['href']}{title})"
        elif tag == "li":
            above = self.open[-1][1]
            n = above["\x01"] = above.get("\x01", 0) + 1  # no attribute has such a name
            mark = f"{n}. " if self.open[-1][0] == "ol" else "- "
            text = "\x01" + mark + inner.replace("\n", "\n    ") + "\n"
        elif tag in ("ul", "ol"):
            text = f"\n\n{text.strip()}\n\n" if self.open[-1][0] != "li" else f"\n{text.strip()}"
        elif tag == "pre":
            text = f"\n\n```\n{text.strip(chr(10))}\n```\n\n"
        elif tag == "blockquote":
            text = "\n\n" + "\n".join(f"> {x}".rstrip() for x in re.sub(r"\n{3,}", "\n\n", inner).split("\n")) + "\n\n"
        elif tag in ("td", "th"):
            span = a.get("colspan") or ""
            text = _cell(text) + "\x02" * (min(MOST_SPANNED, max(1, int(span))) if re.fullmatch("[0-9]{1,9}", span) else 1)
        elif tag == "tr":
            text = "\x03" + text
        elif tag == "table":
            rows = [[c.strip() for c in r.split("\x02")[:-1]] for r in text.split("\x03")[1:]]
            rows = [r for r in rows if any(r)]
            width = max((len(r) for r in rows), default=0)
            lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
            text = "\n\n" + "\n".join([*lines[:1], "| " + " | ".join(["---"] * width) + " |", *lines[1:]]) + "\n\n" if rows else ""
        elif tag in BLOCKS and tag not in ("thead", "tbody", "tfoot"):
            text = f"\n\n{inner}\n\n" if inner else ""
        self.say(text)


def to_markdown(html: str | None) -> str:
    """ATX headings, dash bullets, fenced code, star emphasis, inline links, tables; scripts and hidden parts dropped."""
    if not html or not html.strip():
        return ""
    c = _Converter()
    c.feed(html)
    c.close()
    while len(c.open) > 1:
        c.end()
    text = "".join(c.open[0][2]).replace("\x01", "").replace("\x02", " ").replace("\x03", "\n")
    return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n(?!\n)", lambda m: "  \n" if m[0].startswith("  ") else "\n", text)).strip()


def html_to_markdown(html: Column) -> Column:
    """Column form of ``to_markdown``; null and blank become empty."""

    @F.arrow_udf("string")
    def convert(pages: pa.Array) -> pa.Array:
        return pa.array([to_markdown(p.as_py()) for p in pages], pa.string())

    return convert(html)
