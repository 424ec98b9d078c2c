"""The sink under failures, and unique names against plain Python."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from rillflow.operators import names
from rillflow.sources import sink

COLUMNS = "path string, content string, course_id string, item_id string, updated_at string, has_md boolean"


def notes(spark, rows, parts=2):
    return spark.createDataFrame([(p, c, "c", i, u, c is not None) for p, c, i, u in rows], COLUMNS).repartitionByRange(parts, "item_id")


def found(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f)).read() for d, _, fs in os.walk(root) for f in fs if "_manifest" not in os.path.relpath(d, root) and not f.endswith(".crc")}


def test_notes_and_manifest(spark, tmp_path):
    root = str(tmp_path / "out")
    sink.write_notes(notes(spark, [("a/b/01 - é.md", "eins", "1", "u1"), ("a/x.pdf", "%PDF", "2", "u1"), ("a/none.md", None, "3", "u1")]), root, "r1", 1)
    sink.write_notes(notes(spark, [("a/b/01 - é.md", "zwei", "1", "u2"), ("top.md", "t", "4", None)]), root, "r2", 2)
    assert found(root) == {"a/b/01 - é.md": "zwei", "a/x.pdf": "%PDF", "top.md": "t"}
    got = {(r.item_id, r.updated_at, r.has_md, r.at) for r in sink.written_manifest(spark, root).collect()}
    assert got == {("1", "u2", True, 2), ("2", "u1", True, 1), ("3", "u1", False, 1), ("4", None, True, 2)}
    assert os.path.exists(f"{root}/_manifest/run=r1/_COMPLETE")
    sink.write_notes(notes(spark, []), root, "r3", 3)
    assert len(found(root)) == 3


def test_a_task_that_dies_midway_leaves_nothing(spark, tmp_path):
    root = str(tmp_path / "out")
    sink.write_notes(notes(spark, [("n1.md", "old", "1", "u0"), ("n9.md", "old", "9", "u0")]), root, "r0", 0)
    rows = [(f"n{i}.md", f"new {i}", str(i), "u1") for i in range(1, 10)]
    die = F.when(F.col("item_id") == "9", F.raise_error(F.lit("killed"))).otherwise(F.col("content"))
    bad = notes(spark, rows, 3).withColumn("content", die)
    with pytest.raises(Exception, match="killed"):
        sink.write_notes(bad, root, "r1", 1)
    got, said = found(root), {r.item_id: (r.at, r.path) for r in sink.written_manifest(spark, root).collect()}
    assert got["n9.md"] == "old" and said["9"] == (0, "n9.md")
    for _ in range(100):  # tasks that outlive the abort clear their own
        if not (left := [d for d in os.listdir(root) if d.startswith(".staging")]):
            break
        time.sleep(0.1)
    assert not left
    assert os.path.exists(f"{root}/_manifest/run=r1/_INCOMPLETE")
    for i in range(1, 10):  # what the manifest says of the failed run is there, and nothing else of it is
        done = said.get(str(i), (None,))[0] == 1
        assert (got.get(f"n{i}.md") == f"new {i}") == done
    sink.write_notes(notes(spark, rows, 3), root, "r2", 2)
    assert found(root) == {f"n{i}.md": f"new {i}" for i in range(1, 10)}


def test_paths_stay_inside(spark, tmp_path):
    for path in ("../x.md", "/etc/x", "a/../../x", "_manifest/x"):
        with pytest.raises(Exception, match="not a path inside"):
            sink.write_notes(notes(spark, [(path, "x", "1", "u")]), str(tmp_path / "out"), "r", 1)


def test_unique_names(spark):
    rng = random.Random(7)
    pool = ["Notes", "notes", "NOTES (2)", "Notes (3)", "Notes (2) (2)", "", None, "x (0)", "x", "X (02)"]
    rows = [(rng.choice(["a", "b", None]), rng.choice(pool), i) for i in range(300)]
    got = {r.at: r.unique_name for r in names.suffixed(spark.createDataFrame(rows, "g string, n string, at int").repartition(3), ["g"], "n", F.col("at")).collect()}
    for g in ("a", "b", None):
        mine = [(n or "", at) for h, n, at in rows if h == g]
        used = {n.lower() for n, _ in mine}
        seen = set()
        for n, at in mine:
            if n.lower() not in seen:
                seen.add(n.lower())
                assert got[at] == n
                continue
            k = next(k for k in range(2, 999) if f"{n} ({k})".lower() not in used)
            used.add(f"{n} ({k})".lower())
            assert got[at] == f"{n} ({k})"
        assert len({got[at].lower() for _, at in mine}) == len(mine)


def test_ambiguous_names(spark):
    df = spark.createDataFrame([("A", "x/a.md"), ("a", "y/a.md"), ("b", "x/b.md"), ("b", "x/b.md")], "n string, p string")
    assert [tuple(r) for r in names.ambiguous(df, "n", "p").collect()] == [("a", 2, "x/a.md")]
