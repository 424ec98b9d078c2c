"""Images of notes: their references, and their addresses made local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import links as L
from rillflow.functions import text as T


def file_ref(url: Column, base_host: str) -> Column:
    """The id of a file on the base host that a URL names, with or without its course; else null."""
    absolute = url.rlike(r"^(?i:[a-z][a-z0-9+.-]*:)?//")
    own = ~absolute | (F.lower(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)) == base_host.lower())
    path = F.regexp_replace(F.regexp_replace(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//[^/?#]*", ""), r"[?#].*$", "")
    return F.when(own, F.nullif(F.regexp_extract(path, r"/files/([0-9]+)", 1), F.lit("")))


def localised(notes: DataFrame, files: DataFrame, base_host: str, *, id_col: str = "note_id", text_col: str = "markdown") -> DataFrame:
    """Images of known files point at ``assets/<id>.<extension>``; others stay as they are.

    ``files``: ``file_id, name``. A note falls into images and what stands between them; only its
    distinct addresses are joined, and each image is rewritten where it stands, so an address that
    begins another can't damage it. Returns id, ``markdown``, ``localised`` (distinct addresses).
    """
    parts = notes.select(F.col(id_col).alias("note"), F.col(text_col).alias("text"), L.scanner(images=True)(F.col(text_col)).alias("found")).select("note", "text", "found.gaps", "found.hits")
    urls = parts.select("note", F.explode(F.array_distinct(F.transform("hits", lambda h: h["url"]))).alias("url")).withColumn("file_id", file_ref(F.col("url"), base_host)).where("file_id is not null")
    ext = T.extension(F.col("name"))
    local = F.concat(F.lit("assets/"), "file_id", F.when(ext == "", F.lit("")).otherwise(F.concat(F.lit("."), ext)))
    found = urls.join(files.select("file_id", "name").dropDuplicates(["file_id"]), "file_id").groupBy("note").agg(F.map_from_entries(F.collect_list(F.struct("url", local.alias("to")))).alias("to"))
    written = lambda h: F.concat(F.lit("!["), h["label"], F.lit("]("), F.coalesce(F.element_at("to", h["url"]), h["url"]), F.coalesce(h["title"], F.lit("")), F.lit(")"))
    back = F.array_join(F.concat(F.flatten(F.zip_with(F.slice("gaps", 1, F.size("hits")), F.col("hits"), lambda g, h: F.array(g, written(h)))), F.array(F.element_at("gaps", -1))), "")
    return parts.join(found, "note", "left").select(F.col("note").alias(id_col), F.when(F.col("to").isNull(), F.col("text")).otherwise(back).alias("markdown"), F.when(F.col("to").isNull(), 0).otherwise(F.size("to")).cast("long").alias("localised"))


def existing(wanted: DataFrame, listing: DataFrame, base: str = "base") -> DataFrame:
    """``wanted`` with ``existing``: the first listed name (``dir, name``) in its ``dir`` that is its base, a dot and more, and no note.

    Every beginning of a name that ends before a dot is a key, so a prefix match is an equal join.
    """
    dots = F.filter(F.sequence(F.lit(1), F.length("name")), lambda i: F.substr("name", i, F.lit(1)) == ".")
    keyed = listing.where(~F.lower("name").endswith(".md")).select("dir", "name", F.explode(F.transform(dots, lambda i: F.substr("name", F.lit(1), i - 1))).alias(base))
    return wanted.join(keyed.groupBy("dir", base).agg(F.min("name").alias("existing")), ["dir", base], "left")
