"""Counters per group with a grand total, inventories, fetch outcomes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import text as T

# Statuses and message parts of failures that pass.
TRANSIENT_STATUS = (408, 425, 429, 500, 502, 503, 504)
SECTIONS = ("syllabus", "announcements", "pages", "files")
TRANSIENT_MESSAGE = ("econnreset", "econnrefused", "econnaborted", "etimedout", "epipe", "eai_again", "socket hang up", "timeout exceeded", "timed out")


def tally(df: DataFrame, group: str, counters: Mapping[str, Column], total: str = "(all)") -> DataFrame:
    """A row per group and one named ``total``: how many rows meet each counter's condition. One shuffle."""
    sums = [F.sum(F.when(c, 1).otherwise(0)).cast("long").alias(n) for n, c in counters.items()]
    out = df.rollup(group).agg(F.grouping(group).alias("is_total"), *sums)
    return out.withColumn(group, F.when(F.col("is_total") == 1, F.lit(total)).otherwise(F.col(group))).drop("is_total")


def merged(tallies: Sequence[DataFrame], group: str) -> DataFrame:
    """Tallies of different counters as one: a row per group and ``metric``, equal ones added."""
    long = [t.unpivot(group, [c for c in t.columns if c != group], "metric", "n") for t in tallies]
    every = long[0]
    for t in long[1:]:
        every = every.unionByName(t)
    return every.groupBy(group, "metric").agg(F.sum("n").alias("n"))


def summary(counts: DataFrame, group: str, total: str = "(all)") -> DataFrame:
    """The lines that a summary shows: zero counters only in the total, so what moved in a group stands out."""
    return counts.where((F.col("n") != 0) | (F.col(group) == total))


def section_outcome(section: Column, error: Column, off: Sequence[str] = ("files",)) -> Column:
    """A section's outcome: ``off`` by choice, ``done``, ``disabled`` where the service has none (404), else ``error``."""
    return F.when(section.isin(*off), F.lit("off")).when(error.isNull(), F.lit("done")).when(error.contains("404"), F.lit("disabled")).otherwise(F.lit("error"))


def course_inventory(items: DataFrame, course: str) -> DataFrame:
    """``what, course, label, n``: items by type, files by extension, external links by host; per course and in all."""
    kind = F.coalesce(F.nullif(F.col("type"), F.lit("")), F.lit("(untyped)"))
    label = lambda what, c: F.struct(F.lit(what).alias("what"), c.alias("label"))
    said = F.array(
        label("type", kind),
        F.when(kind == "File", label("extension", T.extension_label(F.col("title")))),
        F.when(kind.isin("ExternalUrl", "ExternalTool"), label("host", T.host_label(F.col("external_url")))),
    )
    each = items.select(F.col(course).cast("string").alias("course"), F.explode(F.array_compact(said)).alias("x")).select("course", "x.*")
    sets = each.groupingSets([["what", "label", "course"], ["what", "label"]], "what", "label", "course")
    return sets.agg(F.grouping("course").alias("g"), F.count("*").alias("n")).select("what", F.when(F.col("g") == 1, F.lit("(all)")).otherwise(F.col("course")).alias("course"), "label", "n")


def inventory(df: DataFrame, label: Column, name: str, missing: str) -> DataFrame:
    """Rows per label, null and empty ones under ``missing``."""
    return df.groupBy(F.coalesce(F.nullif(label, F.lit("")), F.lit(missing)).alias(name)).agg(F.count("*").alias("n"))


def transient(status: Column, message: Column) -> Column:
    """Whether a failure is worth another attempt."""
    said = F.lower(F.coalesce(message, F.lit("")))
    found = said.contains(TRANSIENT_MESSAGE[0])
    for part in TRANSIENT_MESSAGE[1:]:
        found = found | said.contains(part)
    return F.coalesce(status.isin(*TRANSIENT_STATUS), F.lit(False)) | found


def backoff_ms(attempt: Column, base: int = 1000, most: int = 15_000) -> Column:
    """The wait before the next attempt, without jitter."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2), attempt - 1)).cast("long")


def retry_after_ms(header: Column, now: Column) -> Column:
    """A Retry-After header (seconds or an HTTP date) in milliseconds from ``now``, not below 0; null if neither."""
    seconds = header.try_cast("double")
    date = F.try_to_timestamp(F.regexp_extract(header, r"^\w+,\s*(.*?)\s*GMT$", 1), F.lit("d MMM yyyy HH:mm:ss"))
    wait = F.coalesce(seconds * 1000, (F.unix_millis(date) - F.unix_millis(now)).cast("double"))
    return F.when(wait.isNotNull(), F.greatest(F.lit(0.0), wait)).cast("long")
