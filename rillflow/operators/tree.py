"""Trees of paths: what of a folder tree nobody vouches for, with guards where something went wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chain(path: Column) -> Column:
    """A path's folders from the top and itself, without case: ``A/b/C`` -> ``a, a/b, a/b/c``. Empty parts don't count."""
    parts = F.filter(F.split(F.lower(path), "/"), lambda x: x != "")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def swept(present: DataFrame, vouched: DataFrame, issues: DataFrame, *, courses: int = 1) -> DataFrame:
    """``present(path)`` with ``state`` and ``root``: ``kept``, ``guarded`` or ``orphan``, and for orphans the highest path to remove.

    A path is kept if it or something beneath it is ``vouched(path)``, in any case of letters; so
    is what stands at the ``courses`` uppermost levels. Of what isn't kept the highest such folder
    goes as a whole. It is guarded if ``issues(folder)`` names a folder above it, or one anywhere
    beneath the folder that it stands in: a failed module holds back its own files and, since it
    may itself not have been seen, the unseen modules of its course, but not other modules' files.

    Folders, not files, are compared with the sets of keys: each distinct folder's few ancestors
    are looked up once, and its files join the outcome. Repeated paths come back as often; null
    paths are left out.
    """
    keys = lambda df, c: df.select(F.explode(chain(F.col(c))).alias("key")).distinct()
    own = F.element_at(chain(F.col("path")), -1)
    files = present.where("path is not null").select("path", own.alias("own")).withColumn("folder", F.regexp_extract("own", "^(.*)/[^/]*$", 1))
    keep = keys(vouched.where("path is not null"), "path")
    holds = keys(issues.where("folder is not null"), "folder").withColumn("holds", F.lit(True))
    failed = issues.where("folder is not null").select(F.element_at(chain(F.col("folder")), -1).alias("key")).distinct().withColumn("failed", F.lit(True))
    folders = files.select("folder").distinct()
    each = folders.select("folder", F.posexplode(chain(F.col("folder"))).alias("level", "key"))
    nodes = each.select("key").distinct().join(keep.withColumn("kept", F.lit(True)), "key", "left").join(holds, "key", "left").join(failed, "key", "left")
    flag = lambda n: F.coalesce(n, F.lit(False)).alias(n)
    told = each.join(nodes, "key").groupBy("folder").agg(F.array_sort(F.collect_list(F.struct("level", "key", flag("kept"), flag("holds"), flag("failed")))).alias("up"))
    # The highest folder without anything vouched for; what comes before it is its parent and its parent's parents.
    lost = F.get(F.filter("up", lambda u: ~u["kept"] & (u["level"] >= courses)), F.lit(0))
    told = told.withColumn("lost", lost).withColumn("above", F.filter("up", lambda u: F.col("lost").isNull() | (u["level"] < F.col("lost.level"))))
    guard = F.coalesce(F.element_at("above", -1)["holds"], F.lit(False)) | F.exists("above", lambda u: u["failed"])
    told = told.select("folder", F.col("lost.key").alias("lost"), guard.alias("guard"))
    d = files.join(told, "folder").join(keep.withColumnRenamed("key", "own").withColumn("kept", F.lit(True)), "own", "left")
    state = F.when(F.coalesce("kept", F.lit(False)) | (F.size(F.split("own", "/")) <= courses), "kept").when(F.col("guard"), "guarded").otherwise("orphan")
    return d.select("path", state.alias("state"), F.when(state == "orphan", F.coalesce("lost", "own")).alias("root"))
