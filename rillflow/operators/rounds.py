"""Operators that go in rounds: written cuts, connected components, list ranking. Each round's plan is as large as the first's."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder that spark.checkpoint.dir names and read back: lineage ends, executors may be lost.

    Without that setting a local session takes a temporary folder, which goes when the driver ends; a cluster is refused.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-rounds-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/round-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """``edges(a, b)`` -> ``node, root``: the least node of each one's component; nodes are those of the edges.

    In every round each node's parent becomes the least parent among its neighbours', and then its
    parent's parent, so labels travel twice as far each time. Long chains take about log n rounds;
    no round holds a whole component in one task. Null ends are left out.
    """
    e = edges.where("a is not null and b is not null").select("a", "b")
    e = cut(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    for _ in range(most):
        near = e.join(label, e["b"] == label["node"]).groupBy("a").agg(F.min("root").alias("near"))
        hook = label.join(near, label["node"] == near["a"]).select("root", F.least("root", "near").alias("to"))
        own = label.join(near, label["node"] == near["a"]).select("node", F.least("root", "near").alias("root"))
        least = hook.groupBy("root").agg(F.min("to").alias("to")).select(F.col("root").alias("of"), "to")  # a whole tree moves with its root
        moved = own.join(least, own["root"] == least["of"], "left").select("node", F.least("root", F.coalesce("to", "root")).alias("root"))
        above = moved.select(F.col("node").alias("of"), F.col("root").alias("up"))
        new = cut(moved.join(above, moved["root"] == above["of"], "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root")))
        changed = new.join(label.withColumnRenamed("root", "old"), "node").where("root <> old").isEmpty()
        label = new
        if changed:
            return label
    raise RuntimeError(f"components still move after {most} rounds")


def ranked(nodes: DataFrame, most: int = 60) -> DataFrame:
    """``nodes(node, next)`` -> ``node, last, ordinal, state``: each one's place (from 0) in its chain, by pointer doubling.

    A chain ends where ``next`` is null (``complete``) or names no node (``missing``); ``last`` is its last
    node. Nodes on the way to or in a cycle have no last one (``cycle``, ordinal null). Where two chains
    run into one, ordinals count from the longer one's head. Log of the longest chain rounds.
    Nodes are distinct and not null; of repeated ones the one with the least ``next`` counts.
    """
    one = nodes.where("node is not null").groupBy("node").agg(F.min("next").alias("next"))
    here = one.select(F.col("node").alias("n"))
    p = one.join(here, one["next"] == F.col("n"), "left")
    state = F.when(F.col("next").isNull(), "complete").when(F.col("n").isNull(), "missing")
    # ``to`` is the node that ``far`` steps lead to, null once that would be beyond the end; ``last`` and ``state`` are known then.
    p = cut(p.select("node", F.col("n").alias("to"), F.when(F.col("n").isNull(), F.col("node")).alias("last"), state.alias("state"), F.when(F.col("n").isNull(), 0).otherwise(1).cast("long").alias("far")))
    for _ in range(most):
        q = p.select(F.col("node").alias("at"), F.col("to").alias("to2"), F.col("last").alias("last2"), F.col("state").alias("state2"), F.col("far").alias("far2"))
        step = p.join(q, p["to"] == q["at"], "left")
        p = cut(step.select("node", F.col("to2").alias("to"), F.coalesce("last", "last2").alias("last"), F.coalesce("state", "state2").alias("state"), (F.col("far") + F.coalesce("far2", F.lit(0).cast("long"))).alias("far")))
        n, least = p.agg(F.count("*"), F.min(F.when(F.col("to").isNotNull(), F.col("far")))).first()
        if least is None or least > n:  # what is still open has gone further than there are nodes: it runs in a cycle
            break
    else:
        raise RuntimeError(f"chains longer than 2**{most}")
    ends = p.where("last is not null").groupBy("last").agg(F.max("far").alias("length"))
    done = p.where("last is not null").join(ends, "last").select("node", "last", (F.col("length") - F.col("far")).alias("ordinal"), "state")
    none = p.where("last is null").select("node", F.lit(None).cast(p.schema["last"].dataType).alias("last"), F.lit(None).cast("long").alias("ordinal"), F.lit("cycle").alias("state"))
    return done.unionByName(none)
