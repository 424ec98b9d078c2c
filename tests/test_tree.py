"""Sweeps of path trees and locale order on small cases."""

from pyspark.sql import functions as F

from rillflow.operators import plan, tree


def sweep(spark, present, vouched, issues=()):
    one = lambda xs, n: spark.createDataFrame([(x,) for x in xs], f"{n} string")
    return {r.path: (r.state, r.root) for r in tree.swept(one(present, "path"), one(vouched, "path"), one(issues, "folder")).collect()}


FILES = ["C1/M1/a.md", "C1/M1/b.md", "C1/M1/assets/x.png", "C1/M1/assets/old/y.png", "C1/M2/c.md", "C1/Gone/d.md", "C1/Gone/deep/e.md", "C2/M1/f.md", "top.md"]


def test_nested_folders_and_case(spark):
    got = sweep(spark, FILES + [None], ["c1/m1/A.MD", "C1/M1/ASSETS/x.png", "C1/M2", "/C1//M2/"])
    assert got == {
        "C1/M1/a.md": ("kept", None), "C1/M1/b.md": ("orphan", "c1/m1/b.md"), "C1/M1/assets/x.png": ("kept", None), "C1/M1/assets/old/y.png": ("orphan", "c1/m1/assets/old"),
        "C1/M2/c.md": ("orphan", "c1/m2/c.md"), "C1/Gone/d.md": ("orphan", "c1/gone"), "C1/Gone/deep/e.md": ("orphan", "c1/gone"), "C2/M1/f.md": ("orphan", "c2/m1"), "top.md": ("kept", None),
    }


def test_a_failed_module_guards_itself_and_unseen_ones(spark):
    vouched = ["C1/M1/a.md", "C1/M2/z.md"]
    got = {k: v[0] for k, v in sweep(spark, FILES, vouched, ["c1/m2", None]).items()}
    assert got == {"C1/M1/a.md": "kept", "C1/M1/b.md": "orphan", "C1/M1/assets/x.png": "orphan", "C1/M1/assets/old/y.png": "orphan", "C1/M2/c.md": "guarded", "C1/Gone/d.md": "guarded", "C1/Gone/deep/e.md": "guarded", "C2/M1/f.md": "orphan", "top.md": "kept"}
    assert {v[0] for k, v in sweep(spark, FILES, vouched, ["C1"]).items() if k.startswith("C1")} == {"kept", "guarded"}


def test_empty_and_repeated(spark):
    assert sweep(spark, [], ["a/b"]) == {} and sweep(spark, ["a/b"], [])["a/b"] == ("orphan", "a/b")
    one = spark.createDataFrame([("a/b",)] * 3, "path string")
    assert tree.swept(one, one.limit(0), one.limit(0).withColumnRenamed("path", "folder")).count() == 3


def test_locale_order(spark):
    codes = ["zoo", "Éclair", "eclair", "éclair", "Eclair", "f", "", None, "Zebra", "äpfel", "apfel"]
    df = spark.createDataFrame(list(enumerate(codes)), "i int, code string").repartition(3)
    got = [r.code for r in plan.in_locale_order(df, "code", F.col("i")).orderBy("place").collect()]
    assert got == ["", None, "apfel", "äpfel", "eclair", "Eclair", "éclair", "Éclair", "f", "Zebra", "zoo"]
