"""Names that clash: suffixes that make them unique, and a report of those that stay ambiguous."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def suffixed(df: DataFrame, group: Sequence[str], name: str, *last: Column, into: str = "unique_name") -> DataFrame:
    """``df`` with ``into``: names that are unique in their group without case.

    The first of equal names (by ``last``) keeps it. The others get a blank and a number from 2 up
    in parentheses, leaving out numbers that make a name which stands in the group already, so
    no suffixed name takes another's. Adding rows after the present ones changes none of their
    names unless a new name equals a suffixed one. A null name is empty.
    """
    key = F.lower(F.coalesce(name, F.lit("")))
    place = F.row_number().over(Window.partitionBy(*group, "_key").orderBy(*last))
    d = df.withColumn("_key", key).withColumn("_nth", place)
    # Which numbers are taken: names that are themselves another name with a number.
    taken = d.where("_nth = 1").select(*group, F.regexp_extract("_key", r"^(.*) \(([1-9][0-9]{0,8})\)$", 1).alias("_base"), F.regexp_extract("_key", r" \(([1-9][0-9]{0,8})\)$", 1).alias("_n"))
    taken = taken.where("_n <> ''").groupBy(*group, F.col("_base").alias("_key")).agg(F.array_sort(F.collect_set(F.col("_n").cast("int"))).alias("_taken"))
    free = F.aggregate(F.filter(F.coalesce("_taken", F.array().cast("array<int>")), lambda t: t > 1), F.col("_nth"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    new = F.when(F.col("_nth") == 1, F.coalesce(name, F.lit(""))).otherwise(F.concat(F.coalesce(name, F.lit("")), F.lit(" ("), free.cast("string"), F.lit(")")))
    same = [F.col(f"d.{g}").eqNullSafe(F.col(f"t.{g}")) for g in group]
    on = F.col("d._key") == F.col("t._key")
    for s in same:
        on = on & s
    joined = d.alias("d").join(taken.alias("t"), on, "left")
    return joined.select("d.*", "t._taken").withColumn(into, new).drop("_key", "_nth", "_taken")


def ambiguous(notes: DataFrame, name: str, path: str) -> DataFrame:
    """Names that several paths share without case, so a link by name alone may mean any of them: ``name, paths, first_path``."""
    g = notes.groupBy(F.lower(name).alias("name")).agg(F.countDistinct(path).alias("paths"), F.min(path).alias("first_path"))
    return g.where("paths > 1")
