"""The operators as stages over a documents table: each returns its input's columns, decisions applied."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encode
from .common import WORD, cut, pick, table
from .jaccard import jaccard_classes
from .mixing import mix
from .secrets import scan
from .toxicity import toxicity

REDACTED = "[REDACTED]"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(f: Stage) -> Stage:
    """Lets a stage see the columns of documents by name and all others by place; names come back after it.

    So further columns, whatever they are called, neither clash nor change.
    """

    @wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = docs.columns
        own = {names.index(c): c for c in COLUMNS if c in names}
        out = f(spark, docs.toDF(*[own.get(i, f"extra_{i}") for i in range(len(names))]), sf_dir)
        return out.toDF(*names)

    return run


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity classifier doesn't reject (score below 0.3); ``labels`` come from ``sf_dir``."""
    return toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select(*docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that links of 5-word shingles at Jaccard 0.8 join: that of the smallest id.

    Rows are told apart by id and text, so rows without an id, or with one id and different texts,
    are decided each for itself; null ids come last. Rows without words are no copies of one another
    and stay.
    """
    has_words = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("text_hash"))
    keyed = docs.where(has_words).withColumn("row_key", key)
    heads = jaccard_classes(keyed, id_col="row_key").where("doc_id = component_id").select(F.col("doc_id").alias("row_key")).distinct()
    found = keyed.join(heads, "row_key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("row_key").orderBy("n_chars", "source", "lang"))
    one = found.withColumn("nth", nth).where("nth = 1").select(*docs.columns)
    return one.unionByName(docs.where(~has_words))


def redacted(text: Column, found: Column) -> Column:
    """``text`` with each run of overlapping or touching spans replaced by a marker."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.substr(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        marker = F.when((s["start"] > a["at"]) | (a["at"] == 0), F.concat(gap, F.lit(REDACTED))).otherwise(F.lit(""))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], marker).alias("out"))

    return F.aggregate(found, start, step, lambda a: F.concat(a["out"], F.substr(text, a["at"] + 1)))


@stage
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row; base spans and owner-specific opaque runs are replaced in ``text``, ``n_chars`` follows."""
    held = scan(docs).where(F.size("found") > 0).groupBy(F.col("doc_id").alias("held_id"), F.col("text_hash").alias("held_hash")).agg(F.first("found").alias("found"))
    same = docs["doc_id"].eqNullSafe(held["held_id"]) & (F.xxhash64(docs["text"]) == held["held_hash"])
    new = F.when(F.col("found").isNotNull(), redacted(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    out = docs.join(held, same, "left").withColumn("new_text", new)
    change = {"text": F.col("new_text"), "n_chars": F.when(F.col("found").isNotNull(), F.length("new_text").cast("long")).otherwise(F.col("n_chars"))}
    return out.select(*[change.get(c, F.col(c)).alias(c) for c in docs.columns])


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: once for each epoch that takes at least half of its words.

    Rows that the mix doesn't take, also those without words, are left out.
    """
    of_epoch = lambda e: F.aggregate(F.filter("draws", lambda x: x["epoch"] == e), F.lit(0).cast("long"), lambda a, x: a + x["words"])
    epochs = F.array_distinct(F.transform("draws", lambda x: x["epoch"]))
    copies = F.size(F.filter(epochs, lambda e: of_epoch(e) * 2 >= F.col("size")))
    key = lambda text_hash: F.struct("doc_id", F.col("source").cast("string").alias("source"), text_hash.alias("text_hash"))
    # Rows equal in id, source and text are interchangeable: the mix's counts are dealt to them one by one.
    mixed = mix(docs).where("size > 0").select(key(F.col("text_hash")).alias("row_key"), copies.alias("copies"))
    each = F.reverse(F.array_sort(F.collect_list(F.when(F.col("copies") > 0, F.col("copies")))))
    taken = cut(mixed.groupBy("row_key").agg(F.count("*").alias("rows"), each.alias("each")).where(F.size("each") > 0))
    keyed = docs.withColumn("row_key", key(F.xxhash64("text")))
    one = keyed.join(taken.where("rows = 1"), "row_key").withColumn("nth", F.lit(0))
    nth = F.row_number().over(Window.partitionBy("row_key").orderBy("n_chars", "lang")) - 1
    more = keyed.join(taken.where("rows > 1"), "row_key").withColumn("nth", nth)
    out = one.unionByName(more).withColumn("copies", F.get("each", F.col("nth"))).where("copies > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row: doc_id, source, n_tokens, ids (little-endian u32) and their digest, and whether they decode to the text."""
    t = encode(pick(docs, doc_id="doc_id", text="text", source="source"))
    same = F.col("tokens.decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return t.select("doc_id", "source", (F.length("tokens.ids") / 4).cast("long").alias("n_tokens"), "tokens.ids", F.sha2("tokens.ids", 256).alias("ids_sha256"), same.alias("round_trip"))
