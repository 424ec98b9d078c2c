"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``edges(a, b)`` -> ``(v, root)``: for every vertex the smallest vertex of its component.

    Each round points every vertex's larger neighbours, then its smaller ones, at the smallest of
    its neighbourhood, until nothing moves (about log n rounds). Every round is written to the
    shared folder; nothing of it reaches the driver but a count and a checksum. Edges that move
    after ``max_rounds`` rounds raise an error rather than give a part of the answer.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        e = e.join(least, "a").select(F.col("b").alias("x"), "m").where("x <> m").union(least).toDF("a", "b").distinct()
        e = cut(e)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError(f"components still move after {max_rounds} rounds")
    roots = e.select("b").distinct().select(F.col("b").alias("v"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("v"), F.col("b").alias("root")).union(roots).distinct()
