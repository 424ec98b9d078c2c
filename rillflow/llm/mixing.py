"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, cut, pick, table

DRAWS = "array<struct<epoch:bigint,block:bigint,shard:int,words:bigint,place:bigint>>"
BUCKETS = 1024  # parts of a source's permutation: no source, however hot, is ordered in one task


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: float) -> DataFrame:
    """``(skey, source, total)`` -> with ``target``: shares by weight of the sum of all sizes.

    Weights repeat over the sources by code point, null last. A target stops at ``max_repeats``
    times its source's size and the excess is reshared by weight until none is above, which is the
    level at which ``sum(min(weight * level, cap))`` is the whole. One row per source.
    """
    every = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    by_ratio = every.orderBy("ratio", "rank")
    return (
        sizes.withColumn("rank", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())) - 1)
        .withColumn("weight", w)
        .withColumn("cap", F.col("total") * float(max_repeats))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("whole", F.sum("total").over(every))
        .withColumn("capped", F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("open", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("whole") - F.coalesce("capped", F.lit(0.0))) / F.col("open"))
        .withColumn("level", F.min_by(F.when(F.col("level") <= F.col("ratio"), F.col("level")), F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank"))).over(every))
        .withColumn("target", F.least(F.col("weight") * F.coalesce("level", F.lit(float("inf"))), F.col("cap")))
        .select("skey", "source", "total", "target", F.col("whole"))
    )


def shard_quotas(blocks: DataFrame, levels: int, seed: int) -> DataFrame:
    """``(skey, blocks)`` -> ``(skey, bounds)``: the shards' shares of each source's blocks.

    The splitting tree: at each node half of the node's blocks go left, drawn without
    replacement, so the sources' counts on the left are multivariate hypergeometric and both
    halves keep exact totals. Only counts are kept: ``bounds`` are their running sums in shard
    order, so shards take disjoint ranges of the source's permuted blocks.
    """
    one = blocks.where("blocks > 0").select("skey", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("node"))
    for level in range(levels):
        node = Window.partitionBy("node")
        drawn = F.row_number().over(node.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "skey", "block"), "skey", "block"))
        one = one.withColumn("right", drawn * 2 > F.count("*").over(node) + F.col("node") % 2).select("skey", "block", (F.col("node") * 2 + F.col("right").cast("int")).alias("node"))
    counts = one.groupBy("skey", "node").agg(F.count("*").alias("n"))
    by_shard = F.map_from_entries(F.collect_list(F.struct("node", "n")))
    upto = lambda m: F.transform(F.sequence(F.lit(0), F.lit((1 << levels) - 1)), lambda k: F.aggregate(F.sequence(F.lit(0), k), F.lit(0).cast("long"), lambda a, j: a + F.coalesce(F.element_at(m, j), F.lit(0).cast("long"))))
    return counts.groupBy("skey").agg(by_shard.alias("m")).select("skey", upto(F.col("m")).alias("bounds"))


def draws(lo: Column, size: Column, total: Column, target: Column, block: Column, bounds: Column, seed: int) -> Column:
    """What the mix takes of a document that stands at words ``lo .. lo + size`` of its source's permutation.

    Only blocks that the tree dealt to a shard are taken; ``place`` orders a shard's pieces at random.
    """

    def of_epoch(e: Column) -> Column:
        start = e * total + lo
        end = F.least(start + size, target, F.element_at(bounds, -1) * block)
        shard = lambda b: F.size(F.filter(bounds, lambda x: x <= b))
        piece = lambda b: F.struct(e.alias("epoch"), b.alias("block"), shard(b).alias("shard"), (F.least(end, (b + 1) * block) - F.greatest(start, b * block)).alias("words"), F.xxhash64(F.lit(seed), shard(b), e, b, lo).alias("place"))
        return F.when(end > start, F.transform(F.sequence(F.expr("0L") + F.floor(start / block), F.floor((end - 1) / block)), piece)).otherwise(F.array().cast(DRAWS))

    epochs = F.sequence(F.lit(0).cast("long"), F.floor(target / total))
    return F.when((size > 0) & (target > 0), F.flatten(F.transform(epochs, of_epoch))).otherwise(F.array().cast(DRAWS))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", max_repeats: float = 3, shard_levels: int = 4, n_blocks: int = 4096, seed: int = 17) -> DataFrame:
    """Mixes all documents to the sources' target weights. DataFrame functions only.

    Each source is permuted by hash (in ``BUCKETS`` parts with running offsets, so a hot source is
    spread), cut into blocks of equally many words, repeated whole as often as its target asks, and
    its blocks are dealt to ``2**shard_levels`` output shards by the splitting tree. A document may
    be taken in part at a block's or the target's edge.

    Returns a row per input row: id, ``size`` (words), ``text_hash`` (xxhash64), ``source``, ``source_size``, ``target``,
    ``taken`` and ``draws`` (epoch, block, shard, words, place). Null or empty texts have size 0 and are
    never taken; a null source is a source of its own; repeated rows are rows of their own; equal
    inputs give equal results, ties in the hash go by id, size and text (rows equal in all of these are
    interchangeable); an empty table gives an empty result; other columns are ignored.
    """
    d = pick(docs, doc_id=id_col, text=text_col, source=source_col)
    d = cut(
        d.select(
            "doc_id",
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64("text").alias("text_hash"),
        )
        .withColumn("skey", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
        .withColumn("h", F.xxhash64(F.lit(seed), "skey", "doc_id"))
        .withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    )
    parts = d.groupBy("skey", "bucket").agg(F.sum("size").alias("words"), F.first("source").alias("source"))
    before = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut(parts.withColumn("offset", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long"))))
    sources = parts.groupBy("skey").agg(F.first("source").alias("source"), F.sum("words").alias("total"))
    sources = (
        source_targets(sources, weights, max_repeats)
        .withColumn("to_take", F.round("target").cast("long"))
        .withColumn("block", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("whole") / n_blocks)))
        .withColumn("blocks", F.ceil(F.col("to_take") / F.col("block")))
    )
    sources = cut(sources)
    sources = sources.join(shard_quotas(sources, shard_levels, seed), "skey", "left").drop("source")
    inside = Window.partitionBy("skey", "bucket").orderBy("h", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = d.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))
    placed = placed.join(parts.select("skey", "bucket", "offset"), ["skey", "bucket"]).join(cut(sources), "skey")
    return placed.withColumn("draws", draws(F.col("offset") + F.col("within"), F.col("size"), F.col("total"), F.col("to_take"), F.col("block"), F.col("bounds"), seed)).select(
        "doc_id", "source", "size", "text_hash", F.col("total").alias("source_size"), F.round("target", 6).alias("target"), F.aggregate("draws", F.lit(0).cast("long"), lambda a, x: a + x["words"]).alias("taken"), "draws"
    )


def shards(mixed: DataFrame) -> DataFrame:
    """A row per drawn piece: ``shard``, its place in the shard's shuffled order, id, epoch, block, words."""
    return mixed.select("doc_id", F.explode("draws").alias("x")).select("x.shard", "x.place", "doc_id", "x.epoch", "x.block", "x.words")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all ``documents``: doc_id, size, source_size, target, taken; also the pieces as ``shard:place:words``."""
    m = mix(table(spark, sf_dir, "documents"))
    return m.select("doc_id", "size", "source_size", "target", "taken", F.array_join(F.transform("draws", lambda x: F.concat_ws(":", x["shard"].cast("string"), x["place"].cast("string"), x["words"].cast("string"))), ",").alias("pieces"))
