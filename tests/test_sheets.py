"""Tables of many pages out of one exchange, against plain Python; the helpers on odd arrays."""

import random

import numpy as np
from pyspark.sql import functions as F

from rillflow.operators import layout, sheets


def plain(cells):
    """The box and size of each cell's table: cells that share more than a point of a border are of one."""
    root = {c: c for c in cells}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for a in cells:
        for b in cells:
            beside = {a[0], a[1]} & {b[0], b[1]} and min(a[3], b[3]) - max(a[2], b[2]) > 3
            above = {a[2], a[3]} & {b[2], b[3]} and min(a[1], b[1]) - max(a[0], b[0]) > 3
            if beside or above:
                root[find(a)] = find(b)
    out = {}
    for c in cells:
        own = [d for d in cells if find(d) == find(c)]
        if len(own) > 1:
            out[c] = (min(d[0] for d in own), max(d[1] for d in own), min(d[2] for d in own), max(d[3] for d in own), len(own))
    return out


def test_tables_of_pages_by_one_exchange(spark):
    rng = random.Random(7)
    pages = {p: [(x * 20.0, x * 20.0 + 20, y * 20.0, y * 20.0 + 20) for x in range(8) for y in range(8) if rng.random() < 0.3 + p * 0.02] for p in range(12)}
    pages[12] = [(i * 10.0, i * 10.0 + 10, 0.0, 10.0) for i in range(400)]  # a chain
    df = spark.createDataFrame([(p, *c) for p, cells in pages.items() for c in cells], "page int, x0 double, x1 double, y0 double, y1 double").repartition(5)
    tables = layout.ruled_tables(df)
    plan = tables._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan
    got = {(r.page, r.x0, r.x1, r.y0, r.y1): (r.tx0, r.tx1, r.ty0, r.ty1, r.n_cells) for r in tables.collect()}
    assert got == {(p, *c): t for p, cells in pages.items() for c, t in plain(cells).items()}


def test_snapped_and_runs_like_the_rules():
    rng = np.random.default_rng(5)
    group, v = rng.integers(0, 6, 300), rng.uniform(0, 120, 300).round(1)
    want, last = {}, {}
    for g, x in sorted(set(zip(group.tolist(), v.tolist(), strict=True))):
        last[g] = x if g not in last or x - last[g] > 3 else last[g]
        want[g, x] = last[g]
    assert sheets.snapped(group, v, 3.0).tolist() == [want[g, x] for g, x in zip(group.tolist(), v.tolist(), strict=True)]
    high = v + rng.uniform(0, 4, 300).round(1)
    run, end, n = {}, {}, 0
    for i in sorted(range(300), key=lambda i: (group[i], v[i], high[i])):
        g = group[i]
        n += g not in end or v[i] > end[g] + 1
        end[g] = max(end.get(g, -1), high[i])
        run[i] = n
    got = sheets.runs(group, v, high, 1.0)
    assert len({(run[i], got[i]) for i in range(300)}) == len(set(run.values())) == len(set(got.tolist()))


def snap(values):
    out, last = {}, None
    for x in sorted(set(values)):
        last = x if last is None or x - last > 3 else last
        out[x] = last
    return out


def folded(cells):
    """Rows of ``(page, x0, x1, y1, text, ordinal)`` by the rules of ``table_rows``, a cell at a time."""
    xs = snap([c[1] for c in cells] + [c[2] for c in cells])
    held = [c for c in cells if xs[c[1]] < max(xs.values()) or len(set(xs.values())) == 1]
    tops = {p: snap([c[3] for c in held if c[0] == p]) for p in {c[0] for c in held}}
    slots = {}
    for c in sorted(held, key=lambda c: c[5]):
        if c[4].strip():
            slots.setdefault((c[0], -tops[c[0]][c[3]]), {}).setdefault(xs[c[1]], []).append(c[4].strip())
    rows = [slots[k] for k in sorted(slots)]
    columns = []
    for x in sorted({x for r in rows for x in r}):
        if columns and not any(x in r and any(o in r for o in columns[-1]) for r in rows):
            columns[-1].append(x)
        else:
            columns.append([x])
    return [[next((" ".join(r[x]) for x in c if x in r), "") for c in columns] for r in rows]


def test_matrices_by_one_exchange(spark):
    rng = random.Random(11)
    tables = {}
    for t in range(60):
        n = rng.randrange(1, 40)
        cells = [(rng.randrange(3), float(rng.randrange(0, 60)), 0.0, float(rng.randrange(0, 25)), rng.choice(["", " ", "a", " b ", "c d"]), i) for i in range(n)]
        tables[t] = [(c[0], c[1], c[1] + rng.randrange(1, 30), *c[3:]) for c in cells]
    df = spark.createDataFrame([(t, *c) for t, cells in tables.items() for c in cells], "t int, page int, x0 double, x1 double, y1 double, text string, ordinal int").repartition(5)
    out = layout.table_rows(df.unionByName(df.limit(1).withColumn("t", F.lit(None).cast("int"))), ["t"])
    plan = layout.table_rows(df, ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 1 and "Join" not in plan
    want = {t: folded(cells) for t, cells in tables.items()}
    assert {r.t: r.rows for r in out.collect()} == {t: rows for t, rows in want.items() if rows}


def test_matrix_of_null_edges(spark):
    rows = [("a", None, 40.0, 9.0, "x"), ("a", 0.0, 40.0, None, "below"), ("a", 0.0, 40.0, 9.0, "above"), ("a", 20.0, None, 9.0, "y"), ("none", None, None, 1.0, "z")]
    df = spark.createDataFrame([(t, 1, *c, i) for i, (t, *c) in enumerate(rows)], "t string, page int, x0 double, x1 double, y1 double, text string, ordinal int")
    assert [(r.t, r.rows) for r in layout.table_rows(df, ["t"]).collect()] == [("a", [["above", "y"], ["below", ""]])]
    assert layout.table_rows(df.limit(0), ["t"]).count() == 0
