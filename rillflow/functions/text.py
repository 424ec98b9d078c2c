"""Text functions as column expressions. Each takes and returns a Column; nulls stay null unless stated."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Damaged sequences and what they stand for, replaced in this order.
MOJIBAKE = (
    ("‚Äô", "’"),
    ("‚Äò", "‘"),
    ("‚Äú", "“"),
    ("‚Äù", "”"),
    ("‚Äì", "–"),
    ("‚Äî", "—"),
    ("‚Ä¶", "…"),
    ("‚Ä¢", "•"),
    ("¬†", " "),
)
# XML's named references, the ampersand last.
XML_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
NOISE = r"[\x00-\x08\x0B-\x1F\x7F\x{FEFF}]"
MAX_NAME = 120
SHARE_TOKENS = {"p": "pptx", "x": "xlsx", "w": "docx", "b": "pdf"}


def trimmed(c: Column) -> Column:
    """Without white space (Unicode's, and the byte order mark) at both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$", "")


def pad2(n: Column) -> Column:
    """At least two digits; longer numbers stay whole."""
    return F.format_string("%02d", n)


def safe_name(c: Column) -> Column:
    """A file name: no reserved or control characters, single spaces, 120 code points; null or empty: untitled."""
    kept = F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1F]', "")
    short = trimmed(F.left(trimmed(F.regexp_replace(kept, r"(?U)\s+", " ")), F.lit(MAX_NAME)))
    return F.coalesce(F.nullif(short, F.lit("")), F.lit("untitled"))


def yaml_escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit(" "))


def frontmatter(fields: Sequence[tuple[str, Column]]) -> Column:
    """A front matter block of the fields that are neither null nor empty, in this order."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), v.alias("v")) for k, v in fields])
    held = F.filter(pairs, lambda p: p["v"].isNotNull() & (p["v"] != ""))
    lines = F.transform(held, lambda p: F.concat(p["k"], F.lit(': "'), yaml_escaped(p["v"]), F.lit('"')))
    return F.array_join(F.concat(F.array(F.lit("---")), lines, F.array(F.lit("---"), F.lit(""))), "\n")


def extension(name: Column) -> Column:
    """The lower-case extension of one to six letters or digits, else empty."""
    return F.lower(F.regexp_extract(F.coalesce(name, F.lit("")), r"(?i)\.([a-z0-9]{1,6})$", 1))


def extension_label(name: Column) -> Column:
    """The extension for an inventory, or that there is none."""
    return F.coalesce(F.nullif(extension(name), F.lit("")), F.lit("(no extension)"))


def host_label(url: Column) -> Column:
    """The host for an inventory, or that there is no URL or none that can be read."""
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("(no url)")).otherwise(F.coalesce(F.nullif(host(url), F.lit("")), F.lit("(unparseable)")))


def host(url: Column) -> Column:
    """The lower-case host of an absolute URL, else empty."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def clean_text(c: Column) -> Column:
    """Line ends made LF, form feeds line breaks, other control characters dropped, at most one blank line in a row."""
    lines = F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"\f", "\n")
    return trimmed(F.regexp_replace(F.regexp_replace(lines, NOISE, ""), r"\n{3,}", "\n\n"))


def noise_count(c: Column) -> Column:
    """Control characters that are no tab or line feed; counts CR and FF, which cleaning turns into line breaks."""
    return (F.length(c) - F.length(F.regexp_replace(c, NOISE, ""))).cast("long")


def noise_stripped(c: Column) -> Column:
    """Without the characters that ``noise_count`` counts; line ends go too, nothing is trimmed."""
    return F.regexp_replace(c, NOISE, "")


def replaced(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements, one after the other."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def mojibake_repaired(c: Column) -> Column:
    return replaced(c, MOJIBAKE)


def xml_decoded(c: Column) -> Column:
    return replaced(c, XML_REFERENCES)


def escaped_cell(c: Column) -> Column:
    """Text that fits one Markdown table cell: trimmed lines joined by <br>, pipes escaped once."""
    lines = F.transform(F.split(F.regexp_replace(c, r"\r\n?", "\n"), "\n", -1), trimmed)
    return F.regexp_replace(F.array_join(F.filter(lines, lambda x: x != ""), "<br>"), r"(?<!\\)\|", r"\\|")


def _once(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` made once, although lambdas in ``then`` use it for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def markdown_table(rows: Column) -> Column:
    """Rows of cell texts as a Markdown table: empty rows dropped, short ones padded, the first is the header."""
    cells = F.transform(rows, lambda r: F.transform(r, lambda x: escaped_cell(F.coalesce(x, F.lit("")))))

    def table(held: Column, width: Column) -> Column:
        line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), " | "), F.lit(" |"))
        rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
        joined = lambda lines: F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))), "\n")
        return F.when(F.size(held) > 0, _once(F.transform(held, line), joined)).otherwise(F.lit(""))

    held = F.filter(cells, lambda r: F.exists(r, lambda x: x != ""))
    return F.coalesce(_once(held, lambda h: _once(F.coalesce(F.array_max(F.transform(h, lambda r: F.size(r))), F.lit(0)), lambda w: table(h, w))), F.lit(""))


def sheet_table(rows: Column) -> Column:
    """A sheet's rows as a Markdown table, or that it is empty."""
    return _once(markdown_table(rows), lambda t: F.coalesce(F.nullif(t, F.lit("")), F.lit("_(empty sheet)_")))


def meta_line(parts: Sequence[tuple[str, Column]]) -> Column:
    """``**Name:** value`` for each value that isn't null, two spaces and a pipe between."""
    return F.concat_ws("  |  ", *[F.when(v.isNotNull(), F.concat(F.lit(f"**{k}:** "), v)) for k, v in parts])


def points(c: Column) -> Column:
    """A number as text, whole ones without a decimal point."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def guarded_json(raw: Column) -> Column:
    """A JSON body without the guard that some services put before it."""
    return F.regexp_replace(raw, r"^while\(1\);", "")


def next_page(link_header: Column) -> Column:
    """The URL that a Link header calls next, else null."""
    parts = F.filter(F.split(link_header, ","), lambda p: p.rlike(r';\s*rel="next"'))
    return F.nullif(F.regexp_extract(F.get(parts, F.lit(0)), r"<([^>]+)>", 1), F.lit(""))


def share_extension(url: Column) -> Column:
    """The file type that a sharing link's one-letter token tells, else empty."""
    token = F.lower(F.regexp_extract(url, r"(?i)sharepoint\.com/:([a-z]):/", 1))
    known = F.create_map(*[F.lit(x) for kv in SHARE_TOKENS.items() for x in kv])
    return F.coalesce(F.element_at(known, token), F.lit(""))


def disposition_name(header: Column) -> Column:
    """The file name of a Content-Disposition header; the extended form wins; null if there is none."""
    star = F.try_url_decode(F.replace(F.regexp_replace(F.trim(F.regexp_extract(header, r"(?i)filename\*=UTF-8''([^;]+)", 1)), r'^"|"$', ""), F.lit("+"), F.lit("%2B")))
    plain = F.trim(F.regexp_extract(header, r'(?i)filename="?([^";]+)"?', 1))
    return F.coalesce(F.nullif(star, F.lit("")), F.nullif(plain, F.lit("")))


def folder_name(code: Column, course_id: Column, overrides: Mapping[str, str] | None = None) -> Column:
    """A course's folder: the override, else its code with dashes for white space, else its id."""
    chosen = [F.element_at(F.create_map(*[F.lit(x) for kv in overrides.items() for x in kv]), code)] if overrides else []
    return F.coalesce(*chosen, F.nullif(F.regexp_replace(code, r"(?U)\s+", "-"), F.lit("")), course_id.cast("string"))


def relative_path(folder: Column, target: Column) -> Column:
    """The POSIX path from a folder to a file, both absolute; starts with a dot."""
    a = F.filter(F.split(folder, "/"), lambda x: x != "")
    b = F.filter(F.split(target, "/"), lambda x: x != "")
    most = F.least(F.size(a), F.size(b) - 1)
    same = F.size(F.filter(F.sequence(F.lit(0), most), lambda k: (k > 0) & (F.slice(a, 1, F.greatest(k, F.lit(1))) == F.slice(b, 1, F.greatest(k, F.lit(1))))))
    steps = F.concat(F.array_repeat(F.lit(".."), F.size(a) - same), F.slice(b, same + 1, F.size(b)))
    path = F.array_join(steps, "/")
    return F.when(path.startswith("."), path).otherwise(F.concat(F.lit("./"), path))
