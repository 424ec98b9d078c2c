"""Helpers that the operators of this package share: column picking, written cuts, bounded bitmaps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words of the corpus contracts: ASCII space and \x09-\x0D separate words.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``, by a path that only Spark needs to understand."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, as ``new=old``.

    Matching is exact first, then without case, and by position, so other columns (also such as
    differ from these only by case, or repeat a name) can neither clash nor be read.
    """
    names = df.columns
    lower = [n.lower() for n in names]
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = []
    for new, old in columns.items():
        at = names.index(old) if old in names else lower.index(old.lower())
        out.append(F.col(f"c{at}").alias(new))
    return flat.select(*out)


def added(df: DataFrame, source: str, **new: Callable[[Column], Column]) -> DataFrame:
    """``df`` with columns made from its column ``source`` (exact match first), by position.

    Other columns pass through, also such as repeat a name or differ by case; one that has the
    name of a new column gives way to it.
    """
    names = df.columns
    at = names.index(source) if source in names else [n.lower() for n in names].index(source.lower())
    keep = [i for i, n in enumerate(names) if n.lower() not in {k.lower() for k in new}]
    flat = df.toDF(*[f"c{i}" for i in range(len(names))])
    out = flat.select(*[F.col(f"c{i}") for i in keep], *[f(F.col(f"c{at}")).alias(f"n{j}") for j, f in enumerate(new.values())])
    return out.toDF(*[names[i] for i in keep], *new)


def shared_dir(spark: SparkSession) -> str:
    """The folder for cuts that driver and executors share: spark.checkpoint.dir where it is set."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:  # only without a cluster, as in tests
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-cuts-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, any executor may go."""
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined_by_few(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for each ``key`` and in ``n`` how many left rows hold it.

    Keys of more than one left row in 1,024 are at most 1,024, so they are broadcast: rows of a key
    that a third of all rows hold stay where they are. The other keys are joined as usual.
    """
    total = right.agg(F.sum(n)).scalar()
    hot = right.where(F.col(n) * 1024 > total)
    one = left.join(F.broadcast(hot.select(F.col(key), F.lit(True).alias("is_hot"))), key, "left")
    rest = one.where("is_hot is null").drop("is_hot").join(right.drop(n), key)
    return left.join(F.broadcast(hot.drop(n)), key).unionByName(rest)


def bitmap(keys: DataFrame, key: Column, bits_log2: int = 23) -> np.ndarray:
    """A bitmap of the 64-bit ``key`` values, taken modulo ``2**bits_log2``, on the driver.

    Its size is fixed (1 MiB by default) however many keys there are: it is aggregated on the
    executors and a full one only means that the test that follows lets more through.
    """
    n = 1 << bits_log2
    rows = (
        keys.select((F.pmod(key, F.lit(n)) + 1).alias("p"))
        .groupBy(F.expr("bitmap_bucket_number(p)").alias("b"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p))").alias("m"))
        .collect()
    )
    out = np.zeros(n // 8, dtype=np.uint8)
    for r in rows:  # Spark's bucket b holds positions (b - 1) * 32768 + 1 .. b * 32768
        part = np.frombuffer(bytes(r["m"]), dtype=np.uint8)
        out[(r["b"] - 1) * 4096 :][:4096] = part[: n // 8]
    return out


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each uint64 key may be among those that made the bitmap."""
    p = keys & np.uint64(len(bits) * 8 - 1)
    return (bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
