"""Sources over landed files: API responses, binary files, notes and manifests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.operators.rounds import ranked

# Schemas of the entities that responses hold; all fields may be missing.
SCHEMAS = {
    "module": "id STRING, name STRING, position INT, items_count INT",
    "module_item": "id STRING, title STRING, position INT, indent INT, type STRING, content_id STRING, html_url STRING, url STRING, page_url STRING, external_url STRING",
    "page": "title STRING, body STRING, html_url STRING, updated_at STRING",
    "file": "id STRING, display_name STRING, filename STRING, url STRING, size BIGINT, updated_at STRING",
}
MANIFEST = "course_id STRING, item_id STRING, updated_at STRING, has_md BOOLEAN"
PAIRED = ("pdf", "pptx", "xlsx", "docx")


def responses(spark: SparkSession, path: str, entity: str, *, many: bool = True) -> DataFrame:
    """Landed JSON bodies (one file each, a guard before them allowed) as rows of an entity.

    Lists keep their order in ``api_ordinal``; ``landed_from`` tells the file. A body that doesn't
    parse gives no rows.
    """
    schema = SCHEMAS[entity]
    raw = spark.read.text(path, wholetext=True).select(T.guarded_json(F.col("value")).alias("body"), F.col("_metadata.file_path").alias("landed_from"))
    parsed = F.from_json("body", f"array<struct<{schema.replace(' STRING', ':STRING').replace(' INT', ':INT').replace(' BIGINT', ':BIGINT')}>>" if many else schema)
    if not many:
        return raw.select("landed_from", parsed.alias("x")).where("x is not null").select("landed_from", "x.*")
    return raw.select("landed_from", F.posexplode(parsed).alias("api_ordinal", "x")).select("landed_from", "api_ordinal", "x.*")


def files(spark: SparkSession, path: str) -> DataFrame:
    """Landed files: path, length, modification time, extension; contents are read only if selected."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return f.withColumn("ext", T.extension(F.col("path")))


def note_pairs(listing: DataFrame) -> DataFrame:
    """Originals beside the note that was made from them (``<original>.md``): ``original, note``."""
    notes = listing.where(F.lower("path").endswith(".md")).select(F.col("path").alias("note"))
    originals = listing.where(T.extension(F.col("path")).isin(*PAIRED)).select(F.col("path").alias("original"))
    return originals.join(notes, F.concat("original", F.lit(".md")) == F.col("note"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last manifest, or an empty one where there is none."""
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


#: One landed answer of the service: what was asked for, and what came.
ANSWER = "url STRING, status INT, content_type STRING, link STRING, body STRING"


def answers(spark: SparkSession, path: str, *, many: bool = True) -> DataFrame:
    """Landed answers (JSON files of ``ANSWER``) as ``url, next, state, detail, body``: a row for each, also for bad ones.

    ``state``: ``ok``; ``failed`` for a status that isn't 2xx; ``not_json`` for another content type, or
    none (a login page, as a rule); ``unparsed`` for a body that is no JSON; ``not_list`` where a list is
    due (``many``) and something else came; ``unreadable`` for a file that is no answer. ``detail`` says
    what was found, ``next`` is the address of the next page, and a body that isn't ok is null.
    """
    raw = spark.read.schema(f"{ANSWER}, _corrupt STRING").option("multiLine", "true").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    raw = raw.select("*", F.col("_metadata.file_path").alias("file"))
    body = T.guarded_json(F.col("body"))
    parsed = F.try_parse_json(body)
    kind = F.schema_of_variant(parsed)
    state = (
        F.when(F.col("_corrupt").isNotNull() | F.col("url").isNull(), "unreadable")
        .when(F.coalesce(~F.col("status").between(200, 299), F.lit(True)), "failed")
        .when(~F.coalesce("content_type", F.lit("")).contains("json"), "not_json")
        .when(parsed.isNull(), "unparsed")
        .when(F.lit(many) & ~kind.startswith("ARRAY"), "not_list")
        .otherwise("ok")
    )
    detail = F.when(state == "failed", F.concat(F.lit("HTTP "), F.coalesce(F.col("status").cast("string"), F.lit("?")))).when(state == "not_json", F.coalesce("content_type", F.lit("no content type"))).when(state == "not_list", kind).when(state == "unreadable", F.col("file"))
    d = raw.select("url", T.next_page(F.col("link")).alias("next"), state.alias("state"), detail.alias("detail"), body.alias("body"))
    return d.withColumn("body", F.when(F.col("state") == "ok", F.col("body")))


def in_list_order(landed: DataFrame, entity: str) -> DataFrame:
    """Items of lists that came in pages, in the order of the pages' next links: ``list``, ``ended``, ``api_ordinal`` and the entity's fields.

    ``landed``: what ``answers`` gives. Pages are put in order by list ranking over their next links
    alone, however their files are named; ``list`` is the address of a list's last page that came, and
    ``ended`` is ``complete``, or ``missing`` where a page it names did not come or was bad. Pages on a cycle
    have no order: their items come with ``cycle`` and without an ordinal.
    """
    good = landed.where("state = 'ok'").groupBy("url").agg(F.min_by(F.struct("next", "body"), F.struct("next", "body")).alias("x")).select("url", "x.*")
    order = ranked(good.select(F.col("url").alias("node"), "next"))
    fields = SCHEMAS[entity].replace(" STRING", ":STRING").replace(" INT", ":INT").replace(" BIGINT", ":BIGINT")
    items = good.join(order, F.col("url") == F.col("node")).select(F.col("last").alias("list"), F.col("state").alias("ended"), "ordinal", F.posexplode(F.from_json("body", f"array<struct<{fields}>>")).alias("pos", "x"))
    place = F.row_number().over(Window.partitionBy("list", "ended").orderBy("ordinal", "pos")) - 1
    return items.withColumn("api_ordinal", F.when(F.col("ended") != "cycle", place)).select("list", "ended", "api_ordinal", "x.*")
