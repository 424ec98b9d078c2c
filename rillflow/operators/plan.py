"""Planning: which courses, in which order and folder, which handler for each item."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.functions.links import decoded_slug
from rillflow.operators.rounds import cut

# Item types and the handlers they go to.
HANDLERS = {
    "Page": "page",
    "Assignment": "assignment",
    "Quiz": "quiz",
    "Discussion": "discussion",
    "File": "file",
    "ExternalTool": "link_note",
    "SubHeader": "heading",
}


def active_roles(enrollments: Column) -> Column:
    """Lower-case types of the active enrollments; a missing state is active, a missing type is a question mark."""
    held = F.filter(enrollments, lambda e: F.coalesce(e["enrollment_state"], F.lit("active")) == "active")
    return F.transform(held, lambda e: F.lower(F.coalesce(e["type"], F.lit("?"))))


def is_current(start: Column, end: Column, now: Column) -> Column:
    """Inclusive bounds; a null one is open, but not both."""
    return (start.isNull() | (now >= start)) & (end.isNull() | (now <= end)) & (start.isNotNull() | end.isNotNull())


def numbered(items: DataFrame, group: Sequence[str], position: Column, *last: Column, into: str = "number") -> DataFrame:
    """1-based numbers within each group by position (null: 0), ties by the ``last`` keys."""
    return items.withColumn(into, F.row_number().over(Window.partitionBy(*group).orderBy(F.coalesce(position, F.lit(0)), *last)))


def numbered_title(number: Column, title: Column, kind: str) -> Column:
    """``NN - title``, where a null title is the kind and its number."""
    return F.concat(T.pad2(number), F.lit(" - "), F.coalesce(title, F.concat(F.lit(f"{kind} "), number.cast("string"))))


def planned(courses: DataFrame, modules: DataFrame, items: DataFrame, subfolder: str = "Content", overrides: Mapping[str, str] | None = None) -> DataFrame:
    """Every item of every module of every course, with the note it is going to be.

    ``courses``: ``course_id, course_code``; ``modules``: ``course_id, module_id, name, position``;
    ``items``: ``module_id, type, title, position, page_url, content_id`` and what else they carry;
    both with ``api_ordinal``, which decides between equal positions. Modules and items are numbered
    from 1, headings included. Adds ``module_name``, ``number``, ``basename``, ``folder``, ``path`` and
    ``key`` (what links to the item's content are resolved by, null for kinds whose note isn't known
    before it is fetched).
    """
    m = numbered(modules, ["course_id"], F.col("position"), F.col("api_ordinal"), into="module_number")
    m = m.withColumn("module_name", F.coalesce("name", F.concat(F.lit("Module "), F.col("module_number").cast("string")))).drop("name", "position", "api_ordinal")
    i = numbered(items, ["module_id"], F.col("position"), F.col("api_ordinal"))
    d = i.join(m, "module_id").join(courses.select("course_id", "course_code"), "course_id")
    place = F.concat_ws("/", T.folder_name(F.col("course_code"), F.col("course_id"), overrides), F.lit(subfolder), F.concat(T.pad2(F.col("module_number")), F.lit(" - "), T.safe_name(F.col("module_name"))))
    base = F.concat(T.pad2(F.col("number")), F.lit(" - "), T.safe_name(F.col("title")))
    d = d.withColumn("folder", place).withColumn("basename", base).withColumn("path", F.concat("folder", F.lit("/"), "basename", F.lit(".md")))
    ident = F.when(F.col("type") == "Page", decoded_slug(F.col("page_url"))).when(F.col("type").isin("Assignment", "Quiz", "Discussion"), F.col("content_id").cast("string"))
    return d.withColumn("key", F.concat(F.lower("type"), F.lit(":"), F.col("course_id").cast("string"), F.lit(":"), F.nullif(ident, F.lit(""))))


def with_content(items: DataFrame, entities: DataFrame) -> DataFrame:
    """Every item with the entity that it shows: pages by their slug, all others by their id; ``found`` tells whether there is one.

    ``items``: ``course_id, type, page_url, content_id``; ``entities``: ``course_id, type, ref`` (a page's slug or
    an id) and what they carry. Slugs are compared decoded and without case. Of several entities
    with one reference the least counts, so no item is doubled; items without a reference find none.
    """
    page = F.col("type") == "Page"
    own = F.when(page, decoded_slug(F.col("page_url"))).otherwise(F.col("content_id").cast("string"))
    ref = F.when(page, decoded_slug(F.col("ref"))).otherwise(F.col("ref").cast("string"))
    carried = [c for c in entities.columns if c not in ("course_id", "type", "ref")]
    known = entities.withColumn("_ref", ref).where("_ref <> ''").groupBy("course_id", "type", "_ref").agg(F.min(F.struct(*carried)).alias("_x"))
    d = items.withColumn("_ref", own).join(known, ["course_id", "type", "_ref"], "left")
    return d.select(*items.columns, F.col("_x").isNotNull().alias("found"), *[F.col(f"_x.{c}").alias(c) for c in carried])


def handler(kind: Column, url: Column, share_host: str = "sharepoint") -> Column:
    """The handler of an item: by type; external URLs by whether their host is a share; others unknown."""
    known = F.create_map(*[F.lit(x) for kv in HANDLERS.items() for x in kv])
    share = F.when(T.host(url).contains(share_host), F.lit("share_download")).otherwise(F.lit("link_note"))
    return F.when(kind == "ExternalUrl", share).otherwise(F.coalesce(F.element_at(known, kind), F.lit("unknown")))


def listed(courses: DataFrame, keep: Column, last: Column) -> DataFrame:
    """Courses in the order of a listing, with their ``place``: kept ones first, then by ``last``.

    Places come from one sort by range, not from one task that sees all rows. The sorted rows are written:
    each use of a plan samples its own bounds of ranges, so counts and places must come from one sort.
    """
    d = courses.withColumn("sort_key", F.struct((~keep).alias("rest"), last.alias("last"))).repartitionByRange("sort_key").sortWithinPartitions("sort_key")
    d = d.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    d = cut(d.drop("sort_key"))
    sizes = d.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.alias("a").join(sizes.alias("b"), F.col("b.part") < F.col("a.part"), "left").groupBy(F.col("a.part").alias("part")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))  # a row per partition
    return d.join(F.broadcast(before), "part").withColumn("place", F.col("before") + F.col("nth") + 1).drop("part", "nth", "before")


def in_locale_order(courses: DataFrame, code: str, *last: Column) -> DataFrame:
    """Courses with their ``place`` by code in the order of a dictionary (a missing code is empty), then by ``last``.

    The order is that of Unicode's collation: letters first, then accents, then case, so ``e`` stands
    before ``é`` and both before ``f``. Sorted by range, like ``listed``.
    """
    return listed(courses, F.lit(True), F.struct(F.collate(F.coalesce(code, F.lit("")), "UNICODE").alias("code"), *last))


def last_by_key(rows: DataFrame, keys: Sequence[str | Column], at: Column, *values: Column) -> DataFrame:
    """One row per key with the values of the last row by ``at``."""
    last = F.max_by(F.struct(*values), at).alias("last")
    return rows.groupBy(*keys).agg(last).select("*", "last.*").drop("last")
