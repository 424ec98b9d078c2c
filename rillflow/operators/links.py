"""Link operators: extract, resolve, rewrite, follow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import links as L
from rillflow.functions import text as T
from rillflow.operators.rounds import cut


def extracted(df: DataFrame, id_col: str, text_col: str, pattern: str = L.ANCHOR, url_group: int = 1, label_group: int = 2) -> DataFrame:
    """A row per link: id, ``pos`` (from 0), ``url``, ``label`` (of anchors without the markup in it)."""
    one = lambda g: F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(g))
    return df.select(id_col, F.posexplode(F.arrays_zip(one(url_group).alias("url"), one(label_group).alias("label"))).alias("pos", "x")).select(id_col, "pos", "x.url", (F.regexp_replace("x.label", "<[^>]*>", "") if pattern == L.ANCHOR else F.col("x.label")).alias("label"))


def resolved(links: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Links with what the index says of their key; unresolved ones keep nulls."""
    return links.join(index, key, "left")


def rewritten(notes: DataFrame, index: DataFrame, base_host: str, *, id_col: str = "note_id", text_col: str = "markdown", folder_col: str = "folder") -> DataFrame:
    """Each internal link as a wikilink to its note, other text untouched.

    ``index(key, basename, full_path)``. A label with an image makes a relative Markdown link; an
    empty label or one equal to the note's name is left out; in a table row the separator is
    escaped. The text falls into fragments between links; only links are exploded and joined, and
    the parts are interleaved again by position. Notes without links skip the join.
    Returns id, ``markdown``, ``rewritten`` (links), ``unresolved`` (keys of pages and files not in the index).
    """
    text = F.col(text_col)
    notes = notes.select(F.col(id_col).alias("note"), text.alias("text"), F.col(folder_col).alias("folder"), L.scanner()(text).alias("found")).select("note", "text", "folder", "found.gaps", "found.hits")
    # A link's line starts with a pipe if what stands since the last line break before it does: of each
    # piece of text only the first character after its last break counts, so a link carries one flag.
    start = F.struct(F.lit("").alias("at"), F.array().cast("array<boolean>").alias("rows"))

    def next_line(a: Column, p: Column) -> Column:
        since = F.when(p["gap"].contains("\n"), F.substring_index(p["gap"], "\n", -1)).otherwise(F.concat(a["at"], p["gap"]))
        first = F.left(F.concat(since, p["whole"]), F.lit(1))
        after = F.when(p["whole"].contains("\n"), F.left(F.substring_index(p["whole"], "\n", -1), F.lit(1))).otherwise(first)
        return F.struct(after.alias("at"), F.concat(a["rows"], F.array(first == "|")).alias("rows"))

    pieces = F.zip_with(F.slice("gaps", 1, F.size("hits")), "hits", lambda g, h: F.struct(g.alias("gap"), h["whole"].alias("whole")))
    rows = F.aggregate(pieces, start, next_line, lambda a: a["rows"])
    one = notes.where(F.size("hits") > 0).select("note", "folder", F.posexplode(F.zip_with("hits", rows, lambda h, r: F.struct(h.alias("h"), r.alias("in_row")))).alias("pos", "x"))
    one = one.select("note", "folder", "pos", "x.h.*", "x.in_row")
    one = one.withColumn("key", L.url_key(F.col("url"), base_host)).join(index, "key", "left")
    label = T.trimmed(F.col("label"))
    in_row = F.col("in_row")
    new = (
        F.when(F.col("basename").isNull(), F.col("whole"))
        .when(label.contains("!["), F.concat(F.lit("["), F.col("label"), F.lit("](<"), T.relative_path(F.col("folder"), F.col("full_path")), F.lit(">"), F.coalesce("title", F.lit("")), F.lit(")")))
        .when((label == "") | (label == F.col("basename")), F.concat(F.lit("[["), F.col("basename"), F.lit("]]")))
        .otherwise(F.concat(F.lit("[["), F.col("basename"), F.when(in_row, F.lit("\\|")).otherwise(F.lit("|")), label, F.lit("]]")))
    )
    lost = F.when(F.col("basename").isNull() & F.col("key").rlike("^(page|file):"), F.col("key"))
    parts = one.groupBy("note").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", new.alias("new")))), lambda x: x["new"]).alias("new"),
        F.count("basename").alias("rewritten"),
        F.array_sort(F.collect_set(lost)).alias("unresolved"),
    )
    back = F.array_join(F.concat(F.flatten(F.zip_with(F.slice("gaps", 1, F.size("new")), F.col("new"), lambda g, n: F.array(g, n))), F.array(F.element_at("gaps", -1))), "")
    return notes.join(parts, "note", "left").select(F.col("note").alias(id_col), F.when(F.col("new").isNull(), F.col("text")).otherwise(back).alias("markdown"), F.coalesce("rewritten", F.lit(0).cast("long")).alias("rewritten"), F.coalesce("unresolved", F.array().cast("array<string>")).alias("unresolved"))


def followed(start: DataFrame, edges: DataFrame, rounds: int = 3) -> DataFrame:
    """Nodes reached from ``start(node)`` over ``edges(src, dst)`` in at most ``rounds`` rounds, with the round.

    Each round takes the frontier's targets that no earlier round had; it is written, so none is planned twice.
    """
    done = frontier = cut(start.select("node", F.lit(0).alias("round")).distinct())
    for r in range(1, rounds + 1):
        new = frontier.select(F.col("node").alias("src")).join(edges, "src").select(F.col("dst").alias("node")).distinct()
        frontier = cut(new.join(done, "node", "left_anti").select("node", F.lit(r).alias("round")))
        done = cut(done.unionByName(frontier))
    return done


def followed_pages(scraped: DataFrame, bodies: DataFrame, links: Callable[[Column], Column], rounds: int = 3) -> DataFrame:
    """Pages that scraped content links to and no one planned, and those that these link to, round by round.

    ``scraped`` and ``bodies``: ``key, body``; ``links``: body -> array of the keys it links to. A round's
    batch are the keys linked from the bodies just reached that are neither scraped nor were tried
    before; only their bodies are fetched (joined) and read, and each joins the index, so no later
    round asks for it again, found or not. Returns ``key, round, linked_by`` (the least key that links
    it in that round) and ``fetched`` (whether there is a body; of several the least counts).

    Every round is written and its lineage cut, so its plan is as large as the first one's, and of
    a body only its links are kept. Bodies without a key can only link; null links are left out.
    """
    front = cut(scraped.select("key", F.lit(0).alias("depth"), F.array_distinct(links(F.col("body"))).alias("links")))
    tried = cut(front.select("key").where("key is not null").distinct())
    out = None
    for n in range(1, rounds + 1):
        each = front.select(F.col("key").alias("by"), F.explode("links").alias("key")).where("key is not null")
        batch = each.groupBy("key").agg(F.min("by").alias("linked_by")).join(tried, "key", "left_anti")
        body = bodies.join(batch.select("key"), "key", "left_semi").groupBy("key").agg(F.min("body").alias("body"))
        read = body.select("key", F.array_distinct(links(F.col("body"))).alias("links"), F.lit(True).alias("fetched"))
        front = cut(batch.join(read, "key", "left").select("key", F.lit(n).alias("round"), "linked_by", F.coalesce("fetched", F.lit(False)).alias("fetched"), "links"))
        if front.isEmpty() and out is not None:
            break
        tried = cut(tried.unionByName(front.select("key")))
        reached = front.drop("links")
        out = reached if out is None else out.unionByName(reached)
    return out
