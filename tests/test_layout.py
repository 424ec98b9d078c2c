"""Layout operators against plain Python on small pages."""

import random

import pytest
from pyspark.sql import functions as F

from rillflow.operators import layout


def test_snapped_keeps_steps_of_chains(spark):
    values = [0.0, 2.0, 4.0, 6.0, 7.0, 7.0, 10.5, 13.5, 13.6, -5.0, -2.0, -1.9, 100.0]
    rows = [(g, v) for g in ("a", "b") for v in values[: len(values) if g == "a" else 3]] + [("a", None), (None, 1.0)]
    want, last = {}, None
    for v in sorted(set(values)):
        last = v if last is None or v - last > 3 else last
        want[v] = last
    got = layout.snapped(spark.createDataFrame(rows, "g string, v double"), ["g"], "v").collect()
    assert len(got) == len(rows)
    assert {r.v: r.snap for r in got if r.g == "a"} == want | {None: None}


def _borders(cells, rng, off=1.4):
    """Each cell's own four borders, a little off, in any order and either direction."""
    h, v = [], []
    for p, x0, x1, y0, y1 in cells:
        j = lambda: rng.uniform(0, off)
        h += [(p, y0 + j(), x1, x0), (p, y1 + j(), x0, x1)]
        v += [(p, x0 + j(), y0, y1), (p, x1 + j(), y1, y0)]
    rng.shuffle(h)
    rng.shuffle(v)
    return h, v


def _frames(spark, h, v):
    return spark.createDataFrame(h, "page long, y double, x0 double, x1 double"), spark.createDataFrame(v, "page long, x double, y0 double, y1 double")


def test_cells_and_tables_are_found_again(spark):
    rng = random.Random(3)
    grid = [(1, x * 50.0, x * 50.0 + 50, y * 30.0, y * 30.0 + 30) for x in range(4) for y in range(5)]
    spans = [(2, 0.0, 200.0, 60.0, 90.0), (2, 0.0, 60.0, 0.0, 60.0), (2, 60.0, 200.0, 30.0, 60.0), (2, 60.0, 130.0, 0.0, 30.0), (2, 130.0, 200.0, 0.0, 30.0)]
    lone = [(3, 10.0, 90.0, 10.0, 40.0), (3, 300.0, 340.0, 10.0, 40.0), (3, 340.0, 380.0, 11.0, 40.0), (3, 0.0, 90.0, 51.0, 80.0)]
    h, v = _borders(grid + spans + lone, rng)
    h += [(1, 700.0, 0.0, 90.0), (4, 5.0, 0.0, 50.0)]  # lines that close nothing
    cells = layout.ruled_cells(*_frames(spark, h, v))
    near = lambda r: tuple(round(c / 10) for c in r)
    want = sorted((c[0], *near(c[1:])) for c in grid + spans + lone)
    assert sorted((r.page, *near((r.x0, r.x1, r.y0, r.y1))) for r in cells.collect()) == want
    tables = layout.ruled_tables(cells).collect()
    assert sorted({(r.page, *near((r.tx0, r.tx1, r.ty0, r.ty1)), r.n_cells) for r in tables}) == [(1, 0, 20, 0, 15, 20), (2, 0, 20, 0, 9, 5), (3, 30, 38, 1, 4, 2)]


def test_drawings_have_no_cells(spark):
    grid = [(1, x * 20.0, x * 20.0 + 20, y * 20.0, y * 20.0 + 20) for x in range(26) for y in range(24)]
    h, v = _borders(grid + [(2, 0.0, 40.0, 0.0, 40.0)], random.Random(1), 0)
    assert {r.page for r in layout.ruled_cells(*_frames(spark, h, v)).collect()} == {2}
    none = _frames(spark, [], [])
    assert layout.ruled_tables(layout.ruled_cells(*none)).count() == 0


def test_lines(spark):
    up = lambda s, x, y, size=10.0, w=20.0: (s, [size, 0.0, 0.0, size, float(x), float(y)], w)
    side = lambda s, x, y, size=10.0, w=20.0: (s, [0.0, size, -size, 0.0, float(x), float(y)], w)
    pages = {
        1: [up("Area", 0, 100), up("2", 21, 104, 6.0, 3.0), up("m", 24, 100), up("next", 0, 88)],  # a raised digit stays on its line
        2: [up("2", 0, 104, 6.0), up("is", 20, 100, 10.0), up("up", 45, 96.5)],  # the larger item sets the height
        3: [up("a", 0, 50), up("b", 20.0, 50), up("c", 50, 50), up(" d", 90, 50), up("e", 60, 50)],  # apart, touching, stepping back
        4: [side("tur", 100, 0), side("ned", 100, 20), up("flat", 100, 40)],
        5: [up("  ", 0, 9), (None, [10.0, 0.0, 0.0, 10.0, 0.0, 90.0], None)],
    }
    rows = [(p, i, *x) for p, items in pages.items() for i, x in enumerate(items)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "page int, ordinal int, str string, transform array<double>, width double")
    got = {}
    for r in layout.text_lines(df, ["page"]).orderBy("page", "nth").collect():
        got.setdefault(r.page, []).append(r.line)
    assert got == {1: ["Area2m", "next"], 2: ["2is up"], 3: ["ab c d", "e"], 4: ["turned", "flat"]}


def test_matrix_folds_columns_that_are_never_both_filled(spark):
    cell = lambda t, p, x, y, s, w=40: (t, p, float(x), float(x + w), float(y), s)
    rows = [
        cell("a", 1, 0, 100, "Name"), cell("a", 1, 50, 101, "Points"), cell("a", 1, 1, 80, "x"), cell("a", 1, 95, 80, "3"),
        cell("a", 2, 0, 100, "Name"), cell("a", 2, 52, 100, "Points"), cell("a", 2, 2, 80, " y "), cell("a", 2, 2, 79, "z"), cell("a", 2, 140, 80, None),
        cell("box", 1, 0, 10, "only"), cell("list", 1, 0, 10, "one"), cell("list", 1, 0, 40, "two"), cell("empty", 1, 0, 10, " "),
    ]
    rows += [cell("wide", 1, 50 * i, 100, str(i)) for i in range(200)] + [cell("wide", 1, 50 * i, 50, str(i)) for i in range(0, 200, 2)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "t string, page int, x0 double, x1 double, y1 double, text string, ordinal int")
    out = layout.table_rows(df, ["t"]).select("t", "rows", layout.rendered(F.col("rows")).alias("md"))
    got = {r.t: r for r in out.collect()}
    assert got["a"].rows == [["Name", "Points"], ["x", "3"], ["Name", "Points"], ["y z", ""]]
    assert got["a"].md.split("\n") == ["| Name | Points |", "| --- | --- |", "| x | 3 |", "| y z |  |"]
    assert got["box"].md == "only" and got["list"].md == "two\none" and "empty" not in got
    assert len(got["wide"].rows[0]) == 200 and got["wide"].rows[1][:4] == ["0", "", "2", ""]


@pytest.mark.parametrize(
    "pages, heads",
    [
        ([(1, 1, 9, 0, [0, 5, 9]), (2, 1, 3, 3, [1, 9]), (3, 1, 0, 0, [0, 7, 9])], {2: 1, 3: 1}),  # 7 is within 3 of 5
        ([(1, 1, 0, 4, [0, 9]), (2, 1, 0, 0, [0, 9]), (3, 1, 4, 0, [0, 9]), (4, 1, 0, 0, [0, 9])], {2: 2, 3: 3, 4: 3}),  # too much text
        ([(1, 1, 0, 0, [0, 9]), (3, 1, 0, 0, [0, 9]), (4, 1, 0, 0, [0, 20, 9]), (5, 1, 0, 0, [0, 30])], {3: 3, 4: 4, 5: 5}),  # a page without tables
        ([(1, 1, 0, 0, [0, 50, 99]), (2, 1, 0, 0, [0, 99]), (3, 1, 0, 0, [0, 50, 99]), (4, 1, 0, 0, [0, 70, 99])], {2: 1, 3: 1, 4: 4}),  # the head's columns count
    ],
)
def test_continued_tables(spark, pages, heads):
    rows = [("d", p, n, b, a, [float(x) for x in xs]) for p, n, b, a, xs in pages] + [("e", 2, 1, 0, 0, [0.0, 9.0])]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "doc string, page int, nth int, before int, after int, xs array<double>")
    got = {r.page: r.head_page for r in layout.continued(df).collect() if r.doc == "d"}
    assert got == {1: 1} | heads


def test_only_the_last_table_of_a_page_goes_on(spark):
    rows = [(1, 1, 0, 0, [0.0, 9.0]), (1, 2, 0, 0, [50.0, 90.0]), (2, 1, 0, 0, [50.0, 90.0]), (2, 2, 0, 0, [0.0, 9.0]), (3, 1, 0, 0, [0.0, 9.0])]
    df = spark.createDataFrame([("d", *r) for r in rows], "doc string, page int, nth int, before int, after int, xs array<double>")
    got = {(r.page, r.nth): (r.head_page, r.head_nth) for r in layout.continued(df).collect()}
    assert got == {(1, 1): (1, 1), (1, 2): (1, 2), (2, 1): (1, 2), (2, 2): (2, 2), (3, 1): (2, 2)}
