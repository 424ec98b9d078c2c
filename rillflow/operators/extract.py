"""Landed texts of files by their kind: a dispatcher, and parts (pages, slides, sheets, paragraphs) by separators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import text as T

# Kinds of files with a converter: the front matter's name of their count, and the remark around name and count.
KINDS = {
    "pdf": ("pages", "Extracted text from `", "` (", " pages). Figures/diagrams are in the original."),
    "pptx": ("slides", "Slide text extracted from `", "` (", " slides). Images/layout are in the original."),
    "xlsx": ("sheets", "Sheets from `", "` (", " sheet(s)) as tables."),
    "docx": ("paragraphs", "Text extracted from `", "` (", " paragraphs). Exact layout is in the original."),
}
#: What separates the parts of a landed text, by kind: form feeds, group separators, blank lines.
SEPARATORS = {"pdf": "\f", "pptx": "\f", "xlsx": "\x1d", "docx": "\n\n"}


@F.udtf(returnType="ordinal: int, part: string")
class FileParts:
    """The parts of a text that aren't blank, numbered from 1; none for a kind without a converter."""

    def eval(self, ext: str | None, text: str | None) -> Iterator[tuple[int, str]]:
        separator = SEPARATORS.get((ext or "").lower())
        if separator and text:
            n = 0
            for part in text.split(separator):
                if part.strip():
                    n += 1
                    yield n, part


def parts(files: DataFrame, ext: Column | str = "ext", text: Column | str = "text") -> DataFrame:
    """``files`` with a row for each part of each text: ``ordinal`` (in the text) and ``part``, by a lateral join."""
    name = lambda c: F.col(c) if isinstance(c, str) else c
    return files.lateralJoin(FileParts(name(ext).outer(), name(text).outer()))


def extracted(files: DataFrame) -> DataFrame:
    """``files(id, name, text)`` -> ``id, extracted, remark, field, n``: what a file's note holds.

    The kind is the extension. ``n`` counts the parts; their texts are cleaned and joined by a
    blank line. Files of other kinds, and those without any text, keep their row with nulls.
    """
    d = files.select("id", "name", "text", T.extension(F.col("name")).alias("ext"))
    each = parts(d.select("id", "ext", "text")).groupBy("id").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "part"))), lambda p: p["part"]), "\n\n").alias("joined"))
    each = each.withColumn("extracted", F.nullif(T.clean_text(F.col("joined")), F.lit(""))).where("extracted is not null").drop("joined")
    of = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in KINDS.items() for x in (k, v[i])]), F.col("ext"))
    remark = F.concat(of(1), F.col("name"), of(2), F.col("n").cast("string"), of(3))
    return d.join(each, "id", "left").select("id", "extracted", F.when(F.col("n").isNotNull(), remark).alias("remark"), F.when(F.col("n").isNotNull(), of(0)).alias("field"), "n")
