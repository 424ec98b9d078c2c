"""HTML main text by consensus host paths."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, pick, table

# How HTML elements behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea select title".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
ENDS_P = BLOCK - {"html", "body", "p"} | {"p"}
INSIDE = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
PEERS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
# Elements and name parts that are not main text.
JUNK_TAGS = frozenset("nav footer aside form button dialog menu fieldset label input".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
JUNK_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar aside rail menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup comment comments commentlist disqus reply replies respond discussion share sharing social related recommended widget widgets login search toolbar pagination pager skip".split()
)
LISTS = frozenset("ul ol menu dir dl table thead tbody tfoot tr".split())
HELD = 0.9  # a container gives way to one inside it that has this share of its score

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attrs(raw: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(raw)} if raw.strip(" /") else {}


def _step(tag: str, attrs: dict[str, str]) -> str:
    """A container's generalised name: its tag and the letters of its classes, or else of its id."""
    names = attrs.get("class") or attrs.get("id") or ""
    return ".".join([tag, *sorted({re.sub(r"[^a-z]+", "-", n.lower()).strip("-") for n in names.split()} - {""})])


def _junk(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in JUNK_TAGS or tag == "header" and not in_article or attrs.get("role", "").lower() in JUNK_ROLES:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    return any(p.lower() in JUNK_NAMES for p in _NAME.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}"))


def blocks(page: str) -> list[tuple[tuple[str, ...], str, int, bool]]:
    """A page's blocks in order: (path of containers, text, characters in links, whether junk)."""
    out: list[tuple[tuple[str, ...], str, int, bool]] = []
    stack: list[tuple[str, str, bool]] = []  # tag, generalised name, junk
    path: tuple[str, ...] = ()
    text: list[str] = []
    links = link_depth = 0

    def flush() -> None:
        nonlocal text, links
        said = " ".join(html.unescape("".join(text)).split())
        if said:
            out.append((path, said, links, any(j for _, _, j in stack)))
        text, links = [], 0

    def close(depth: int) -> None:
        nonlocal path, link_depth
        if any(t in BLOCK for t, _, _ in stack[depth:]):
            flush()
        link_depth -= sum(t == "a" for t, _, _ in stack[depth:])
        del stack[depth:]
        path = tuple(s for t, s, _ in stack if t in BLOCK)

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece:
            text.append(piece)
            if link_depth:
                links += len(piece)
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for d in range(len(stack) - 1, -1, -1):
                if stack[d][0] == tag:
                    close(d)
                    break
                if stack[d][0] in ("table", "article", "body") and tag not in ("body", "html", "table", "article", "main"):
                    break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n if tag in ("script", "style", "title", "textarea") else at
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in ENDS_P and (open_p := max((d for d, x in enumerate(stack) if x[0] == "p"), default=-1)) >= 0:
            close(open_p)
        if tag in PEERS:
            for d in range(len(stack) - 1, -1, -1):
                if stack[d][0] in INSIDE[tag]:
                    break
                if stack[d][0] in PEERS[tag]:
                    close(d)
                    break
        if tag in BLOCK:
            flush()
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
            continue
        attrs = _attrs(m[3])
        junk = _junk(tag, attrs, any(t == "article" for t, _, _ in stack))
        if junk and tag not in BLOCK:  # an inline advert or button ends the words before it
            text.append(" ")
        stack.append((tag, _step(tag, attrs), junk))
        link_depth += tag == "a"
        if junk and tag not in BLOCK:
            inner = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = inner.end() if inner else at
            close(len(stack) - 1)
            continue
        if tag in BLOCK:
            path = (*path, stack[-1][1])
    flush()
    return out


def scores(found: list[tuple[tuple[str, ...], str, int, bool]]) -> dict[str, float]:
    """Container path -> how well it holds the main text and nothing else.

    A container gains the characters of its blocks that are no junk, less three times those in
    links, loses those of its junk blocks, and a little for each step that it stands above others,
    so of nested containers with the same text the innermost wins.
    """
    total: dict[str, float] = defaultdict(float)
    for path, text, links, junk in found:
        gain = -2.0 * len(text) if junk else len(text) - 3.0 * links
        for k in range(1, len(path) + 1):
            if k == len(path) and path[-1].split(".")[0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dd", "dt", "pre", "blockquote"):
                continue  # a paragraph is a block, not a container
            total["/".join(path[:k])] += gain + 0.001 * k
    for p in total:
        tags = {s.split(".")[0] for s in p.split("/")}
        if total[p] > 0 and tags & {"article", "main"}:
            total[p] *= 1.5
    return total


def winner(s: dict[str, float]) -> str | None:
    """The container with the best score, or the innermost in it that still has most of that score.

    An ancestor has all the text that its parts have, so its better score alone doesn't count.
    """
    best = max((p for p in s if s[p] > 0), key=lambda p: (s[p], p), default=None)
    while best is not None:
        inner = (p for p in s if p.startswith(best + "/") and "/" not in p[len(best) + 1 :] and p.rsplit("/", 1)[1].split(".")[0] not in LISTS)
        child = max(inner, key=lambda p: (s[p], p), default=None)
        if child is None or s[child] < HELD * s[best]:
            break
        best = child
    return best


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        votes: dict[tuple[str, str], int] = defaultdict(int)
        for host, page in zip(batch.column("host"), batch.column("html")):
            best = winner(scores(blocks(page.as_py() or "")))
            if best is not None:
                votes[(host.as_py(), best)] += 1
        keys = list(votes)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([votes[k] for k in keys], pa.int64())], ["host", "path", "vote"])


def main_text(page: str, paths: list[str]) -> str:
    """The blocks under the page's most voted path, or, if it has none of them, under its own best.

    Ancestors of its own best are passed over: every page has them, whatever its layout.
    """
    found = blocks(page)
    s = scores(found)
    own = winner(s)
    have = {"/".join(p[:k]) for p, _, _, junk in found if not junk for k in range(1, len(p) + 1)}
    chosen = next((p for p in paths if p in have and s[p] > 0 and not (own or "").startswith(p + "/")), own)
    if chosen is None:
        chosen = max(s, key=lambda p: (s[p], p), default=None)
        if chosen is not None:
            chosen = chosen.split("/")[0]
    inside = lambda p: chosen is None or "/".join(p).startswith(chosen + "/") or "/".join(p) == chosen
    return "\n".join(t for p, t, _, junk in found if not junk and inside(p))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            texts = [main_text(p or "", w or []) for p, w in zip(part.column("html").to_pylist(), part.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def host_paths(pages: DataFrame) -> DataFrame:
    """``(host, html)`` -> ``host, paths``: each host's container paths with two votes or more, most voted first.

    Every page votes for its own best container; votes are pre-aggregated in each batch, so a hot
    host costs a row per path and batch. A path with one vote serves only the page that gave it,
    which finds it as its own best.
    """
    votes = pages.mapInArrow(_votes, "host string, path string, vote long").groupBy("host", "path").agg(F.sum("vote").alias("vote")).where("vote > 1")
    return votes.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("vote")).alias("v"), (-F.length("path")).alias("n"), "path"))), lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: ``page_id, url, text``, a row per input row.

    Blocks stand in page order, one per line, white space inside them is one space; blocks of
    menus, headers, footers, sidebars, notices, adverts, forms and reader comments, and scripts and
    styles, are left out wherever they stand. A null or empty page has an empty text; a page without
    a host shares the empty host; unclosed and truncated markup is read as far as it goes; repeated
    rows vote and are extracted each; an empty table gives an empty result; other columns are ignored.
    """
    p = pick(pages, page_id=id_col, url=url_col, html=html_col)
    p = p.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)))
    kind = dict(p.dtypes)["page_id"]
    won = cut(host_paths(p.select("host", "html")))
    return p.join(won, "host", "left").select("page_id", "url", "html", "paths").mapInArrow(_extracted, f"page_id {kind}, url string, text string")


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all ``pages``."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
