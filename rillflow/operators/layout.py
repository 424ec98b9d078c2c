"""Layout: coordinates within a tolerance, ruled grids, tables out of cells, tables that go on over pages, lines of text.

Pages and documents are keys; what a rule must see in order (a line, a table's columns, a document's
tables) is folded in the order of a small array, everything else is joins and windows.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.operators import sheets

# Points within which borders are one, cells beyond which a page is a drawing, lines of text
# that a header or footer may have, and the share of a text's size that tells lines and words apart.
TOLERANCE = 3.0
MOST_CELLS = 600
FURNITURE = 3
SAME_LINE = 0.45
APART = 0.25
SQUARE = 128.0  # side of the grid squares in which borders meet
BORDERS = "array<struct<across:double,low:double,high:double>>"
CELLS = "array<struct<x0:double,x1:double,y0:double,y1:double>>"
TABLES = "array<struct<x0:double,x1:double,y0:double,y1:double,tx0:double,tx1:double,ty0:double,ty1:double,n_cells:bigint>>"


def snapped(df: DataFrame, group: Sequence[str], column: str, into: str = "snap", tolerance: float = TOLERANCE) -> DataFrame:
    """``df`` with ``into``: the kept value of its group that ``column`` is merged with.

    Kept are the least value, then each next one more than the tolerance above the last kept, so a
    chain of near values doesn't run together. Values are made distinct first; islands without near
    neighbours are found by a window, and only an island's few values are folded in order. A null
    value keeps null.
    """
    v = F.col(column)
    one = df.where(v.isNotNull()).select(*group, v.cast("double").alias("v")).distinct()
    w = Window.partitionBy(*group).orderBy("v")
    far = F.coalesce(F.col("v") - F.lag("v").over(w) > tolerance, F.lit(True))
    islands = one.withColumn("far", far).withColumn("island", F.sum(F.col("far").cast("int")).over(w))
    runs = islands.groupBy(*group, "island").agg(F.array_sort(F.collect_list("v")).alias("vs"))
    start = F.array().cast("array<struct<v:double,kept:double>>")

    def keep(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)["kept"]
        return F.concat(done, F.array(F.struct(x.alias("v"), F.when(F.size(done) == 0, x).when(x - last > tolerance, x).otherwise(last).alias("kept"))))

    kept = runs.select(*group, F.explode(F.aggregate("vs", start, keep)).alias("_k")).select(*group, F.col("_k.v").alias("_v"), F.col("_k.kept").alias(into))
    return df.withColumn("_v", v.cast("double")).join(kept, [*group, "_v"], "left").drop("_v")


def merged_borders(borders: DataFrame, across: str, low: str, high: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Border segments of a ``page`` on (nearly) one line that touch or overlap, as one: ``page``, ``id`` (in the page), ``across``, ``low``, ``high``.

    A merged border lies where its least segment does. Segments apart along the line don't draw
    each other to one place, however near the lines are. A page's borders are one array.
    """

    @F.arrow_udf(BORDERS)
    def one(pages: pa.Array) -> pa.Array:
        return sheets.merged(pages, tolerance)

    b = borders.select("page", F.col(across).cast("double").alias("across"), F.least(low, high).cast("double").alias("low"), F.greatest(low, high).cast("double").alias("high")).dropna()
    pages = b.groupBy("page").agg(F.collect_list(F.struct("across", "low", "high")).alias("borders"))
    return pages.select("page", F.posexplode(one("borders")).alias("id", "b")).select("page", "id", F.col("b.across").alias(across), F.col("b.low").alias(low), F.col("b.high").alias(high))


def crossings(h: DataFrame, v: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``page, x, y`` of each crossing with ``h`` and ``v``, the ``id`` of the merged borders that cross there.

    A range join by squares: a horizontal border lies in one row of squares and is listed in each of
    its columns, a vertical one the other way round, so every pair meets in one square only.
    """
    square = lambda c: F.floor(c / SQUARE)
    span = lambda a, b: F.explode(F.sequence(square(F.col(a) - tolerance), square(F.col(b) + tolerance)))
    hs = h.select("page", "y", F.struct("id", "x0", "x1").alias("h"), square(F.col("y")).alias("gy"), span("x0", "x1").alias("gx"))
    vs = v.select("page", "x", F.struct("id", "y0", "y1").alias("v"), square(F.col("x")).alias("gx"), span("y0", "y1").alias("gy"))
    near = lambda c, a, b: (F.col(c) >= F.col(a) - tolerance) & (F.col(c) <= F.col(b) + tolerance)
    return hs.join(vs, ["page", "gx", "gy"]).where(near("x", "h.x0", "h.x1") & near("y", "v.y0", "v.y1")).select("page", "x", "y", F.col("h.id").alias("h"), F.col("v.id").alias("v"))


def ruled_cells(h: DataFrame, v: DataFrame, tolerance: float = TOLERANCE, most: int = MOST_CELLS) -> DataFrame:
    """The smallest closed rectangles that borders make: ``page, x0, x1, y0, y1`` (y grows upwards).

    ``h``: ``page, y, x0, x1``; ``v``: ``page, x, y0, y1``. Borders are merged first, so two crossings
    are connected if they lie on one border. From each crossing, as the upper left corner, the nearest
    crossing below and the nearest on its right are taken whose fourth corner lies on both their
    borders. A page with more than ``most`` of them is a drawing and has none.
    """
    points = crossings(merged_borders(h, "y", "x0", "x1", tolerance), merged_borders(v, "x", "y0", "y1", tolerance), tolerance)
    points = points.groupBy("page").agg(F.collect_list(F.struct("x", "y", "h", "v")).alias("points"))

    @F.arrow_udf(CELLS)
    def found(pages: pa.Array) -> pa.Array:
        return sheets.cells(pages, tolerance, most)

    return points.select("page", F.explode(found("points")).alias("c")).select("page", "c.x0", "c.x1", "c.y0", "c.y1")


def ruled_tables(cells: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (``page, x0, x1, y0, y1``) with their table's box ``tx0, tx1, ty0, ty1`` and ``n_cells``; lone cells are left out.

    Cells share a border where one ends where the other begins and they lie beside each other by
    more than the tolerance. Along each line, such cells are one run of overlapping intervals, so
    each is linked to the run's first one only; tables are the components of these links. A page's
    cells are one array.
    """
    pages = cells.dropna(subset=["x0", "x1", "y0", "y1"]).groupBy("page").agg(F.collect_set(F.struct(*[F.col(c).cast("double").alias(c) for c in ("x0", "x1", "y0", "y1")])).alias("cells"))

    @F.arrow_udf(TABLES)
    def found(pages: pa.Array) -> pa.Array:
        return sheets.tables(pages, tolerance)

    return pages.select("page", F.explode(found("cells")).alias("c")).select("page", "c.*")


def text_lines(items: DataFrame, group: Sequence[str], order: str = "ordinal") -> DataFrame:
    """Positioned items of a page as lines: ``group``, ``nth`` (from 1), ``line``.

    ``items``: ``str``, ``transform`` (six numbers: reading direction, up, origin) and ``width``. In the order
    of the stream, an item goes on with the line if it points the same way, stands as high as the
    line up to a share of the larger size, and doesn't step back by more than its size; a larger
    item sets the line's height and size, so a superscript joins the text that it belongs to. Items
    visibly apart get a blank between them. Empty lines are left out, null texts count as empty.
    """
    m = lambda i: F.coalesce(F.get("transform", F.lit(i)), F.lit(0.0))
    length = lambda a, b: F.when(F.hypot(a, b) == 0, 1.0).otherwise(F.hypot(a, b))
    read, size = length(m(0), m(1)), length(m(2), m(3))
    ux, uy = m(2) / size, m(3) / size
    along = (m(4) * m(0) + m(5) * m(1)) / read
    item = F.struct(
        F.col(order).alias("o"), F.coalesce("str", F.lit("")).alias("s"), ux.alias("ux"), uy.alias("uy"),
        along.alias("along"), (along + F.coalesce("width", F.lit(0.0))).alias("end"), (m(4) * ux + m(5) * uy).alias("up"), size.alias("size"),
    )
    page = items.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias("items"))
    state = "struct<done:array<string>,text:string,ux:double,uy:double,up:double,size:double,along:double,end:double>"

    def step(a: Column, i: Column) -> Column:
        level = F.abs(a["up"] - i["up"]) <= F.greatest(i["size"], a["size"]) * SAME_LINE
        goes_on = (F.abs(a["ux"] - i["ux"]) < 0.01) & (F.abs(a["uy"] - i["uy"]) < 0.01) & level & (i["along"] >= a["along"] - i["size"])
        goes_on = F.coalesce(goes_on, F.lit(False))  # the first item of a page has no line yet
        larger = ~goes_on | (i["size"] > a["size"])
        apart = (i["along"] - a["end"] > i["size"] * APART) & ~a["text"].rlike(r"\s$") & ~i["s"].rlike(r"^\s")
        text = F.when(goes_on, F.concat(a["text"], F.when(apart, F.lit(" ")).otherwise(F.lit("")), i["s"])).otherwise(i["s"])
        return F.struct(
            F.when(goes_on | a["text"].isNull(), a["done"]).otherwise(F.concat(a["done"], F.array(a["text"]))).alias("done"), text.alias("text"),
            F.when(goes_on, a["ux"]).otherwise(i["ux"]).alias("ux"), F.when(goes_on, a["uy"]).otherwise(i["uy"]).alias("uy"),
            F.when(larger, i["up"]).otherwise(a["up"]).alias("up"), F.when(larger, i["size"]).otherwise(a["size"]).alias("size"), i["along"].alias("along"), i["end"].alias("end"),
        )

    first = F.struct(F.array().cast("array<string>").alias("done"), *[F.lit(None).alias(n) for n in ("text", "ux", "uy", "up", "size", "along", "end")]).cast(state)
    lines = F.aggregate("items", first, step, lambda a: F.concat(a["done"], F.array(a["text"])))
    clean = F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    return page.select(*group, F.posexplode(clean).alias("i", "line")).select(*group, (F.col("i") + 1).alias("nth"), "line")


def table_rows(cells: DataFrame, group: Sequence[str], order: str = "ordinal", tolerance: float = TOLERANCE) -> DataFrame:
    """Cells of a table as a matrix of texts: ``group``, ``rows`` (array of arrays, all of one width).

    ``cells``: ``page, x0, x1, y1, text``. Columns are the left edges among all edges merged within the
    tolerance, rows the top edges of a page from above, pages in order; texts of one place are joined.
    Of neighbouring columns those that no row fills both of are folded into one, from the left, each
    next one against all that its column took so far. Empty rows go, and tables without any text.
    A table's cells are one array, as its rows are one in the result, so nothing but cells is shuffled.
    """
    number = lambda c: F.col(c).cast("double").alias(c)
    cell = F.struct("page", F.col(order).alias("o"), F.trim(F.coalesce("text", F.lit(""))).alias("text"), number("x0"), number("x1"), number("y1"))

    @F.arrow_udf("array<array<array<string>>>")
    def found(tables: pa.Array) -> pa.Array:
        return sheets.matrix(tables, tolerance)

    tables = cells.dropna(subset=list(group)).groupBy(*group).agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return tables.select(*group, F.explode(found("cells")).alias("rows"))


def rendered(rows: Column) -> Column:
    """A table's rows as Markdown: a row like the first one is a header that was repeated, and goes.

    What isn't two rows, or has no row with two texts, is a drawing: its texts are lines.
    """
    kept = F.filter(rows, lambda r, i: (i == 0) | (r != F.get(rows, F.lit(0))))
    texts = lambda r: F.filter(r, lambda c: c != "")
    drawing = (F.size(kept) < 2) | ~F.exists(kept, lambda r: F.size(texts(r)) > 1)
    return F.when(drawing, F.array_join(texts(F.flatten(kept)), "\n")).otherwise(T.markdown_table(kept))


def continued(tables: DataFrame, document: str = "doc", tolerance: float = TOLERANCE, furniture: int = FURNITURE) -> DataFrame:
    """``tables`` with ``head_page, head_nth``: the table that each one goes on with, itself if none.

    ``tables``: ``document, page, nth`` (in the page), ``before`` and ``after`` (lines of text before the page's
    first and after its last table), ``xs`` (column edges). A page's first table goes on with the last
    one of the page before if little text stands between, the outer edges agree and each of its
    edges is one of those of the table that the chain began with; chains may run over any number of
    pages. A page without tables ends them. A document's pages are folded in order, small structs each.
    """
    t = F.struct("nth", "before", "after", F.array_sort("xs").alias("xs"))
    pages = tables.groupBy(document, "page").agg(F.min_by(t, "nth").alias("first"), F.max_by(t, "nth").alias("last"))
    pages = pages.groupBy(document).agg(F.array_sort(F.collect_list(F.struct("page", "first", "last"))).alias("pages"))
    near = lambda a, b: F.abs(a - b) <= tolerance

    def step(a: Column, p: Column) -> Column:
        end = F.element_at(a, -1)  # what the last page ends with: the head of its table and the lines after it
        xs, own = p["first"]["xs"], end["xs"]
        outer = near(F.element_at(xs, 1), F.element_at(own, 1)) & near(F.element_at(xs, -1), F.element_at(own, -1))
        inner = F.forall(xs, lambda x: F.exists(own, lambda o: near(x, o)))
        text = (end["after"] <= furniture) & (p["first"]["before"] <= furniture)
        goes_on = F.coalesce((F.size(a) > 0) & (end["page"] == p["page"] - 1) & text & outer & inner, F.lit(False))
        one = goes_on & (p["first"]["nth"] == p["last"]["nth"])
        return F.concat(a, F.array(F.struct(
            p["page"].alias("page"), p["last"]["after"].alias("after"), F.when(one, own).otherwise(p["last"]["xs"]).alias("xs"),
            p["first"]["nth"].alias("nth"), F.when(goes_on, end["chain_page"]).otherwise(p["page"]).alias("head_page"), F.when(goes_on, end["chain_nth"]).otherwise(p["first"]["nth"]).alias("head_nth"),
            F.when(one, end["chain_page"]).otherwise(p["page"]).alias("chain_page"), F.when(one, end["chain_nth"]).otherwise(p["last"]["nth"]).alias("chain_nth"),
        )))

    kinds = {n: tables.schema[n].dataType.simpleString() for n in ("page", "nth", "after", "xs")}
    names = {"page": "page", "after": "after", "xs": "xs", "nth": "nth", "head_page": "page", "head_nth": "nth", "chain_page": "page", "chain_nth": "nth"}
    start = F.array().cast(f"array<struct<{','.join(f'{n}:{kinds[k]}' for n, k in names.items())}>>")
    heads = pages.select(document, F.explode(F.aggregate("pages", start, step)).alias("h")).select(document, "h.page", "h.nth", "h.head_page", "h.head_nth")
    joined = tables.join(heads, [document, "page", "nth"], "left")
    return joined.withColumns({"head_page": F.coalesce("head_page", "page"), "head_nth": F.coalesce("head_nth", "nth")})
