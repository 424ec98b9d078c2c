"""The manifest's digests equal those of a plain recursion, for every shape of tree."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from rillflow.llm import manifest
from helpers import DOCS, SF


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, text, lang, source, n_chars)."""

    def leaf(i, t, lang, s, n):
        return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, lang, n, t)])

    def tree(leaves):
        """Root, and for each leaf its (left, right) level by level."""
        paths, level, under = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
        while len(level) > 1:
            runs = [range(a, min(a + 16, len(level))) for a in range(0, len(level), 16)]
            for r in runs:
                for at in r:
                    step = ("".join(level[r.start : at]), "".join(level[at + 1 : r.stop]))
                    for i in under[at]:
                        paths[i].append(step)
            level, under = [H(*level[r.start : r.stop]) for r in runs], [[i for at in r for i in under[at]] for r in runs]
        return level[0], paths

    small = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    groups = {}
    for r in rows:
        groups.setdefault((r[3] is not None, (r[3] or "").encode()), []).append(r)
    subs = []
    for _, g in sorted(groups.items()):
        g = sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        subs.append((g, *tree([leaf(*r) for r in g])))
    root, above = tree([s[1] for s in subs]) if subs else (None, [])
    out = []
    for (g, sub, paths), up in zip(subs, above):
        for r, path in zip(g, paths):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r[0], r[1].translate(small) if hit and r[1] else r[1], *r[2:])
            for a, b in path + up:
                node = H(a, node, b)
            out.append((r[0], leaf(*r), sub, root, H(*[a + b for a, b in path + up]), node, node == root))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    if extra:
        df = df.withColumns({"leaf": F.lit("x"), "grp": F.lit(1), "pos": F.lit(2), "node": F.lit("y")})
    df.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    got = manifest.op11_manifest(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2], [16], [17], [257, 1, 33], [0]])
def test_shapes(spark, tmp_path, sizes):
    rows = [(s * 1000 + i, f"Text {i}", "en", f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    assert run(spark, tmp_path, rows) == plain(rows)


def test_many_sources_nulls_repeats_and_clashes(spark, tmp_path):
    rows = [(i, "A" * (i % 3) + "ß文\n", None, f"s{i}é", i) for i in range(40)] + [(i, None, "en", None, None) for i in range(20)]
    rows += [(None, "Null id", "en", "", 1)] * 3 + [(5, "Same", "de", "", 4)] * 18 + [(5, t, "de", "", 4) for t in ("", "b", "A")] + [(-7, "LONG " * 30_000, "en", "a:b", 3)]
    assert run(spark, tmp_path, rows, extra=True) == plain(rows)


def test_sql_says_the_same(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = sorted(map(tuple, manifest.op11_manifest(spark, SF).collect()), key=repr)
    assert got == plain(rows) == sorted(con.execute(manifest.OP11_SQL).fetchall(), key=repr)
    assert 0 < sum(not r[-1] for r in got) < len(got)
