"""Rounds against plain Python: page following, components, list ranking."""

import random

from pyspark.sql import functions as F

from rillflow.operators import links, rounds

KEYS = lambda body: F.split(body, " ")


def pages(spark, rows):
    return spark.createDataFrame(rows, "key string, body string")


def test_follow_pages_found_on_the_way(spark):
    scraped = pages(spark, [("a", "b x b"), ("s", "a gone"), (None, "c"), ("e", None)])
    bodies = pages(spark, [("b", "d a b"), ("c", "d"), ("d", "f"), ("f", "h"), ("h", "i"), ("x", "x"), ("a", "zzz"), (None, "q"), ("b", "z late")])
    got = {tuple(r) for r in links.followed_pages(scraped, bodies, KEYS).collect()}
    assert got == {("b", 1, "a", True), ("x", 1, "a", True), ("gone", 1, "s", False), ("c", 1, None, True), ("d", 2, "b", True), ("f", 3, "d", True)}
    none = links.followed_pages(scraped.limit(0), bodies, KEYS)
    assert none.collect() == [] and none.columns == ["key", "round", "linked_by", "fetched"]


def test_a_round_costs_what_the_first_did(spark, monkeypatch):
    sizes = []

    def measured(df):
        if "round" in df.columns:
            sizes.append(len(df._jdf.queryExecution().optimizedPlan().toString().splitlines()))
        return rounds.cut(df)

    monkeypatch.setattr(links, "cut", measured)
    chain = [(f"p{i}", f"p{i + 1}") for i in range(6)]
    got = links.followed_pages(pages(spark, chain[:1]), pages(spark, chain), KEYS, rounds=4)
    assert got.count() == 4 and len(sizes) == 4 and len(set(sizes)) == 1


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 400)] + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(170)] + [(7, 7), (9, 8), (9, 8)] + [(5000, i) for i in range(5001, 5200)]
    rng.shuffle(edges)
    up = {v: v for e in edges for v in e}

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = rounds.components(spark.createDataFrame([*edges, (None, 1), (2, None)], "a long, b long").repartition(5))
    assert dict(got.collect()) == {v: find(v) for v in up}
    assert rounds.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranked_lists(spark):
    names = [f"u{i:03d}" for i in range(200)]
    random.Random(1).shuffle(names)
    chain = list(zip(names[:150], [*names[1:150], None]))
    broken = list(zip(names[150:180], [*names[151:180], "nowhere"]))
    ring = list(zip(names[180:190], [*names[181:190], names[180]])) + [(names[190], names[183])]
    rows = chain + broken + ring + [("one", None), ("self", "self"), (None, "one"), ("one", None)]
    random.Random(2).shuffle(rows)
    got = {r["node"]: (r["last"], r["ordinal"], r["state"]) for r in rounds.ranked(spark.createDataFrame(rows, "node string, next string").repartition(4)).collect()}
    want = {n: (names[149], i, "complete") for i, n in enumerate(names[:150])} | {n: (names[179], i, "missing") for i, n in enumerate(names[150:180])}
    want |= {n: (None, None, "cycle") for n in [*names[180:191], "self"]} | {"one": ("one", 0, "complete")}
    assert got == want
    assert rounds.ranked(spark.createDataFrame([], "node string, next string")).count() == 0
    assert {tuple(r) for r in rounds.ranked(spark.createDataFrame([("a", "c"), ("b", "a"), ("x", "c"), ("c", None)], "node string, next string")).select("node", "ordinal").collect()} == {("b", 0), ("a", 1), ("x", 1), ("c", 2)}
