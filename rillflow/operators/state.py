"""Incremental state: what is unchanged, what is orphaned, what the next manifest holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unchanged(updated: Column, seen: Column, exists: Column) -> Column:
    """Known stamp, equal to the last one, output in place. A missing stamp is never unchanged."""
    return F.coalesce((F.nullif(updated, F.lit("")) == seen) & exists, F.lit(False))


def compared(now: DataFrame, manifest: DataFrame, keys: Sequence[str], stamp: str = "updated_at") -> DataFrame:
    """``now`` with ``seen_at`` (the manifest's stamp), ``known`` (in the manifest) and ``skip``."""
    before = manifest.select(*keys, F.col(stamp).alias("seen_at"), F.lit(True).alias("known"))
    both = now.join(before, list(keys), "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return both.withColumn("skip", unchanged(F.col(stamp), F.col("seen_at"), F.col("known")))


def orphans(present: DataFrame, vouched: DataFrame, issues: DataFrame, key: str, group: str) -> DataFrame:
    """What is present and vouched for by nobody, unless its group had an issue: then nothing of it goes."""
    return present.join(vouched.select(key).distinct(), key, "left_anti").join(issues.select(group).distinct(), group, "left_anti")


def upserted(manifest: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The next manifest: new rows win, others stay; rows are never removed."""
    return manifest.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)
