"""Places by one sort by range, over more than one range."""

import pytest
from pyspark.sql import functions as F

from rillflow.operators import plan


@pytest.fixture
def ranges(spark):
    """Ranges stay apart, as they do on large tables, where each use of a plan samples its own bounds."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_listed_counts_every_row_once(ranges):
    n = 40_000
    d = ranges.range(0, n, 1, 8).select(((F.col("id") * 7919) % n).alias("id")).withColumn("keep", F.col("id") % 3 == 0)
    got = plan.listed(d, F.col("keep"), F.col("id")).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, n + 1))
    assert [r.id for r in got] == [i for i in range(n) if i % 3 == 0] + [i for i in range(n) if i % 3]


def test_locale_order_counts_every_row_once(ranges):
    n, words = 40_000, ["apfel", "äpfel", "eclair", "Eclair", "éclair", "zoo"]
    code = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") * 7919 % 6 + 1).cast("int"))
    d = ranges.range(0, n, 1, 8).select("id", code.alias("code"))
    got = plan.in_locale_order(d, "code", F.col("id")).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, n + 1))
    assert [(r.code, r.id) for r in got] == sorted(((words[i * 7919 % 6], i) for i in range(n)), key=lambda x: (words.index(x[0]), x[1]))
