"""Incremental rules beyond the stamp: files with their notes, downloads that are never downgraded, notes made again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.operators.state import unchanged

# How the remark of an extracted note begins, before the file's name.
EXTRACTED = ("Extracted text from", "Slide text extracted from", "Sheets from", "Text extracted from")


def file_status(updated: Column, seen: Column, original_there: Column, had_note: Column, note_there: Column, url: Column) -> Column:
    """``skipped``: unchanged, original and (if one was written) note in place; ``issue``: no address; else ``fetch``."""
    in_place = original_there & (~F.coalesce(had_note, F.lit(False)) | note_there)
    return F.when(unchanged(updated, seen, in_place), F.lit("skipped")).when(F.coalesce(url, F.lit("")) == "", F.lit("issue")).otherwise(F.lit("fetch"))


def share_status(url: Column, existing: Column, fetched: Column, incremental: Column) -> Column:
    """A share's outcome: what an earlier run downloaded stays, whether or not it can be fetched now; a link only if there is nothing."""
    return (
        F.when(F.coalesce(url, F.lit("")) == "", F.lit("issue"))
        .when(incremental & existing.isNotNull(), F.lit("skipped"))
        .when(fetched, F.lit("downloaded"))
        .when(existing.isNotNull(), F.lit("kept"))
        .otherwise(F.lit("linked"))
    )


def missing_only(wanted: DataFrame, present: DataFrame, keys: list[str], there_by: list[str] | None = None) -> DataFrame:
    """Files that aren't there yet (by ``there_by``, or else ``keys``), each once: existence decides, also when a run is forced."""
    by = there_by or keys
    return wanted.dropDuplicates(keys).join(present.select(*by).distinct(), by, "left_anti")


def removes(configured: bool, prune: bool, no_prune: bool) -> bool:
    """Whether orphans are removed rather than reported: asked for, and not forbidden."""
    return (configured or prune) and not no_prune


def split_note(note: Column) -> dict[str, Column]:
    """A generated note's ``front``, ``head``, ``remark`` and ``body``, by where its lines end; null where it isn't one.

    The front matter goes from a first line of dashes to the next one, the heading is the line
    after it and a blank one, and the remark is a quoted line before another blank one.
    """
    line_end = lambda c: F.instr(c, "\n")
    from_ = lambda c, at: F.substring(c, at, F.length(c))
    closed = F.locate("\n---\n", note, 5)
    front = F.when(note.startswith("---\n") & (closed > 0), F.left(note, closed + 4))
    rest = from_(note, F.length(front) + 1)
    head = F.when(rest.startswith("# ") & (F.substring(rest, line_end(rest) + 1, F.lit(1)) == "\n"), F.left(rest, line_end(rest) + 1))
    rest = from_(rest, F.length(head) + 1)
    remark = F.when(rest.startswith("> ") & (F.substring(rest, line_end(rest) + 1, F.lit(1)) == "\n"), F.left(rest, line_end(rest) - 1))
    return {"front": front, "head": head, "remark": remark, "body": from_(rest, F.length(remark) + 3)}


def with_field(front: Column, name: str, value: Column) -> Column:
    """Front matter whose line of ``name`` says ``value``; one without such a line, or a null value, changes nothing."""
    begin = f'{name}: "'
    lines = F.transform(F.split(front, "\n", -1), lambda x: F.when(x.startswith(begin) & x.endswith('"'), F.concat(F.lit(begin), value, F.lit('"'))).otherwise(x))
    return F.coalesce(F.array_join(lines, "\n"), front)


def reconverted(notes: DataFrame, extracted: DataFrame, key: str = "original") -> DataFrame:
    """Notes made again from their originals: ``status`` and ``new``.

    ``notes``: ``path, original, note``; ``extracted``: ``remark, text`` and ``pages`` (a count that the
    front matter holds, null if none) by ``key``. A note is provably made from its original if its
    front matter names it and its remark, perhaps after other words, begins like an extraction's.
    Others are ``skipped``; ``failed`` are those without text now, and ``unchanged`` and ``updated`` tell
    whether anything differs. Line ends are made LF first.
    """
    d = notes.withColumn("note", F.replace("note", F.lit("\r\n"), F.lit("\n")))
    d = d.select("path", "original", "note", F.struct(*[c.alias(n) for n, c in split_note(F.col("note")).items()]).alias("p"))
    said = F.array_min(F.filter(F.array(*[F.instr("p.remark", f"{e} `") for e in EXTRACTED]), lambda at: at > 0))
    names_it = F.array_contains(F.split("p.front", "\n"), F.concat(F.lit('source_file: "'), T.yaml_escaped(F.col("original")), F.lit('"')))
    d = d.withColumn("kept", F.when(names_it, F.left("p.remark", said - 1)))  # null: not made from it
    d = d.join(extracted.withColumnRenamed("remark", "new_remark"), key, "left")
    front = F.when(F.col("pages").isNull(), F.col("p.front")).otherwise(with_field(F.col("p.front"), "pages", F.col("pages").cast("string")))
    new = F.concat(front, "p.head", "kept", "new_remark", F.lit("\n\n"), "text", F.lit("\n"))
    status = F.when(F.col("kept").isNull(), "skipped").when(new.isNull(), "failed").when(new == F.col("note"), "unchanged").otherwise("updated")
    return d.select("path", "original", status.alias("status"), F.coalesce(F.when(F.col("kept").isNotNull(), new), "note").alias("new"))
