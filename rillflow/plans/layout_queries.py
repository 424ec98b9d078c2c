"""Queries of operators that go in rounds or read layouts, each beside the DuckDB SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillflow.functions import links as L
from rillflow.functions import text as T
from rillflow.operators import extract, layout, links, names, notes, plan, rounds, tree

from .queries import query, table

HREF = r'<a\s[^>]*href="([^"]*)"'


def _hrefs(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), L.decoded_slug)


_ROUND = "t{n} AS (SELECT k AS key, min(src) AS linked_by FROM (SELECT key AS src, unnest(links) AS k FROM {before}) WHERE k NOT IN (SELECT key FROM seen){tried} GROUP BY 1), r{n} AS (SELECT t{n}.key, {n} AS round, linked_by, b.key IS NOT NULL AS fetched, links FROM t{n} LEFT JOIN b ON b.key = t{n}.key)"
_ROUNDS = ", ".join(_ROUND.format(n=n, before=f"r{n - 1}" if n > 1 else "scraped", tried="".join(f" AND k NOT IN (SELECT key FROM t{m})" for m in range(1, n))) for n in (1, 2, 3))


@query(
    rf"""WITH p AS (SELECT page_id, url, list_transform(regexp_extract_all(html, '{HREF}', 1), lambda x: lower(x)) AS links, html FROM pages), k AS (SELECT *, links[1] AS key FROM p),
scraped AS (SELECT * FROM k WHERE url LIKE 'http:%'), seen AS (SELECT DISTINCT key FROM scraped WHERE key IS NOT NULL), b AS (SELECT key, arg_min(links, html) AS links FROM k WHERE key IS NOT NULL GROUP BY key), {_ROUNDS},
r AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3)
SELECT page_id, k.key, CASE WHEN url LIKE 'http:%' THEN 0 ELSE round END AS round, linked_by FROM k LEFT JOIN r ON r.key = k.key UNION ALL SELECT NULL, key, round, linked_by FROM r WHERE NOT fetched"""
)
def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages (known by the first address in their menu) that plainly served ones link to, and on from there in three rounds.

    A row for each page, with the round that reached it (0: known before, null: none), and one for each address without a page.
    """
    p = table(spark, sf_dir, "pages").select("page_id", F.col("url").startswith("http:").alias("known"), F.col("html").alias("body"), F.get(_hrefs(F.col("html")), F.lit(0)).alias("key"))
    reached = rounds.cut(links.followed_pages(p.where("known").select("key", "body"), p.select("key", "body"), _hrefs))
    every = p.drop("body").join(reached, "key", "left").select("page_id", "key", F.when(F.col("known"), 0).otherwise(F.col("round")).alias("round"), "linked_by")
    lost = reached.where("not fetched").select(F.lit(None).cast("long").alias("page_id"), "key", "round", "linked_by")
    return every.unionByName(lost)


@query(
    """WITH e AS (SELECT user_id, event_id, event_id % 97 = 13 AS lost FROM events), g AS (SELECT *, sum(CASE WHEN lost THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS part FROM e), k AS (SELECT * FROM g WHERE NOT lost)
SELECT event_id, CAST(row_number() OVER w - 1 AS BIGINT) AS ordinal, CASE WHEN part < max(part) OVER (PARTITION BY user_id) OR EXISTS (SELECT 1 FROM g WHERE g.user_id = k.user_id AND g.part > k.part) THEN 'missing' ELSE 'complete' END AS state, last_value(event_id) OVER (PARTITION BY user_id, part ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
FROM k WINDOW w AS (PARTITION BY user_id, part ORDER BY event_id)"""
)
def paged_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of lists landed in no order, some of them lost: their places by following each one's next address alone."""
    address = lambda c: F.md5(c.cast("string").cast("binary"))
    e = table(spark, sf_dir, "events").select("event_id", address(F.col("event_id")).alias("node"), address(F.lead("event_id").over(Window.partitionBy("user_id").orderBy("event_id"))).alias("next"))
    landed = e.where("event_id % 97 <> 13")
    r = rounds.ranked(landed.select("node", "next"))
    ids = landed.select("node", "event_id")
    return r.join(ids, "node").join(ids.select(F.col("node").alias("last"), F.col("event_id").alias("last_id")), "last").select("event_id", "ordinal", "state", F.col("last_id").alias("last"))


# A page holds four orders beside each other; an order's lines are the rows of a ruled table with columns at 0, 100, 180
# and 300, of which a row's flag and status join some. Every cell is drawn by itself, and not quite straight.
COLUMNS = "CASE WHEN l_returnflag = 'A' THEN [0.0, 100.0, 180.0, 300.0] WHEN l_returnflag = 'N' THEN [0.0, 100.0, 300.0] WHEN l_linestatus = 'O' THEN [0.0, 300.0] ELSE [0.0, 180.0, 300.0] END"


def _drawn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page, x0, x1, y0, y1`` of the cells, with how far the lower and the right border of each are off."""
    li = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    below = F.sum(F.col("l_quantity") + 10).over(w.rowsBetween(Window.unboundedPreceding, 0))
    last = F.lead("l_linenumber").over(w).isNull()
    d = li.withColumns({"y0": 9000 - below, "y1": 9010 - below + F.col("l_quantity"), "down": F.when(last, 0).otherwise(F.col("l_partkey") % 3)})
    flag, numbers = F.col("l_returnflag"), lambda *x: F.array(*[F.lit(float(v)) for v in x])
    xs = F.when(flag == "A", numbers(0, 100, 180, 300)).when(flag == "N", numbers(0, 100, 300)).when(F.col("l_linestatus") == "O", numbers(0, 300)).otherwise(numbers(0, 180, 300))
    d = d.withColumn("xs", xs).withColumn("i", F.explode(F.sequence(F.lit(1), F.size("xs") - 1)))
    at = lambda i: F.element_at("xs", i) + F.col("l_orderkey") % 4 * 1000
    aside = F.when(F.col("i") == F.size("xs") - 1, 0).otherwise(F.col("l_suppkey") % 3)
    return d.select(F.floor(F.col("l_orderkey") / 4).alias("page"), at(F.col("i")).alias("x0"), at(F.col("i") + 1).alias("x1"), "y0", "y1", "down", aside.alias("aside"))


@query(
    f"""WITH r AS (SELECT l_orderkey, sum(l_quantity + 10) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) AS d, l_quantity, {COLUMNS} AS xs FROM lineitem),
c AS (SELECT l_orderkey, xs[i] + l_orderkey % 4 * 1000 AS x0, xs[i + 1] + l_orderkey % 4 * 1000 AS x1, 9000 - d AS y0, 9010 - d + l_quantity AS y1 FROM (SELECT *, unnest(range(1, len(xs))) AS i FROM r)),
t AS (SELECT *, min(x0) OVER w AS tx0, max(x1) OVER w AS tx1, min(y0) OVER w AS ty0, max(y1) OVER w AS ty1, count(*) OVER w AS n_cells FROM c WINDOW w AS (PARTITION BY l_orderkey))
SELECT CAST(l_orderkey // 4 AS BIGINT) AS page, x0, x1, y0, y1, tx0, tx1, ty0, ty1, n_cells FROM t WHERE n_cells > 1"""
)
def ruled_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells and tables found again from nothing but the borders drawn around each cell."""
    d = _drawn(spark, sf_dir)
    sides = lambda *ends: d.select("page", F.explode(F.array(*ends)).alias("e")).select("page", "e.*")
    across = lambda y: F.struct(y.cast("double").alias("y"), "x0", "x1")
    along = lambda x: F.struct(x.cast("double").alias("x"), "y0", "y1")
    h = sides(across(F.col("y1")), across(F.col("y0") + F.col("down")))
    v = sides(along(F.col("x0")), along(F.col("x1") + F.col("aside")))
    return layout.ruled_tables(layout.ruled_cells(h, v))


@query(
    """WITH RECURSIVE v AS (SELECT DISTINCT l_suppkey, l_extendedprice AS v FROM lineitem), k AS (SELECT l_suppkey, min(v) AS kept FROM v GROUP BY 1 UNION ALL SELECT l_suppkey, (SELECT min(v) FROM v WHERE v.l_suppkey = k.l_suppkey AND v.v > k.kept + 3) FROM k WHERE kept IS NOT NULL),
s AS (SELECT v.l_suppkey, v.v, max(kept) AS kept FROM v JOIN k ON k.l_suppkey = v.l_suppkey AND kept <= v.v GROUP BY 1, 2)
SELECT l.l_suppkey, kept, count(*) AS n, count(DISTINCT l_extendedprice) AS n_values, max(l_extendedprice) AS last FROM lineitem l JOIN s ON s.l_suppkey = l.l_suppkey AND s.v = l_extendedprice GROUP BY 1, 2"""
)
def snapped_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of a supplier as coordinates: near ones merged within the tolerance, chains of them in steps."""
    s = layout.snapped(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "kept")
    return s.groupBy("l_suppkey", "kept").agg(F.count("*").alias("n"), F.countDistinct("l_extendedprice").alias("n_values"), F.max("l_extendedprice").alias("last"))


@query(
    """WITH RECURSIVE e AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn, event_type AS s, 8.0 + event_id % 5 AS size, event_id, value FROM events),
i AS (SELECT user_id, rn, CASE WHEN event_id % 9 = 0 THEN ' ' || s ELSE s END AS s, size, 700.0 - rn // 4 * 14 + rn % 3 * 2 AS up, rn % 4 * 60.0 + value AS along, rn % 4 * 60.0 + value + 5.0 * length(s) AS stop FROM e),
l AS (SELECT user_id, rn, 1 AS line, s AS t, up, size, along, stop FROM i WHERE rn = 1 UNION ALL
SELECT user_id, rn, line + CASE WHEN ok THEN 0 ELSE 1 END, CASE WHEN ok THEN t || CASE WHEN along - stop0 > size * 0.25 AND NOT regexp_matches(t, '\\s$') AND NOT regexp_matches(s, '^\\s') THEN ' ' ELSE '' END || s ELSE s END, CASE WHEN ok AND size <= size0 THEN up0 ELSE up END, CASE WHEN ok AND size <= size0 THEN size0 ELSE size END, along, stop
FROM (SELECT i.*, l.line, l.t, l.up AS up0, l.size AS size0, l.stop AS stop0, abs(l.up - i.up) <= greatest(l.size, i.size) * 0.45 AND i.along >= l.along - i.size AS ok FROM l JOIN i ON i.user_id = l.user_id AND i.rn = l.rn + 1)),
f AS (SELECT user_id, line, trim(regexp_replace(arg_max(t, rn), '\\s+', ' ', 'g')) AS t FROM l GROUP BY 1, 2)
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY line) AS INTEGER) AS nth, t AS line FROM f WHERE t <> ''""".replace("\\\\", "\\")
)
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as text on a page, upright or turned: sizes vary, lines go up and down a little."""
    e = table(spark, sf_dir, "events").withColumn("ordinal", F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")))
    rn, size = F.col("ordinal"), 8.0 + F.col("event_id") % 5
    up, along = 700.0 - F.floor(rn / 4) * 14 + rn % 3 * 2, rn % 4 * 60.0 + F.col("value")
    none = F.lit(0.0)
    turned = F.when(F.col("user_id") % 10 == 0, F.array(none, F.lit(1.0), -size, none, -up, along)).otherwise(F.array(F.lit(1.0), none, none, size, along, up))
    text = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit(" "), "event_type")).otherwise(F.col("event_type"))
    items = e.select("user_id", "ordinal", text.alias("str"), turned.alias("transform"), (5.0 * F.length("event_type")).alias("width"))
    return layout.text_lines(items, ["user_id"])


@query(
    """WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem),
c AS (SELECT l_orderkey, rn, 0 AS x, CAST(l_linenumber AS VARCHAR) AS t FROM r UNION ALL SELECT l_orderkey, rn, 100 + 40 * (l_partkey % 4), l_returnflag FROM r WHERE l_quantity > 3 UNION ALL SELECT l_orderkey, rn, 300 + 30 * (l_suppkey % 3), l_linestatus FROM r WHERE l_quantity > 25),
k AS (SELECT l_orderkey, x, list(rn) AS f, row_number() OVER (PARTITION BY l_orderkey ORDER BY x) AS i FROM c GROUP BY 1, 2),
g AS (SELECT l_orderkey, x, i, f, 0 AS col FROM k WHERE i = 1 UNION ALL SELECT k.l_orderkey, k.x, k.i, CASE WHEN list_has_any(g.f, k.f) THEN k.f ELSE list_concat(g.f, k.f) END, g.col + CASE WHEN list_has_any(g.f, k.f) THEN 1 ELSE 0 END FROM g JOIN k ON k.l_orderkey = g.l_orderkey AND k.i = g.i + 1),
w AS (SELECT l_orderkey, max(col) AS m FROM g GROUP BY 1),
d AS (SELECT l_orderkey, rn, list_transform(range(m + 1), lambda j: coalesce(list_filter(ts, lambda e: e.col = j)[1].t, '')) AS row FROM (SELECT c.l_orderkey, rn, list({'col': col, 't': t}) AS ts FROM c JOIN g ON g.l_orderkey = c.l_orderkey AND g.x = c.x GROUP BY 1, 2) JOIN w USING (l_orderkey)),
h AS (SELECT l_orderkey, list(row ORDER BY rn) AS rows FROM d GROUP BY 1), u AS (SELECT l_orderkey, list_filter(rows, lambda x, j: j = 1 OR x <> rows[1]) AS rows FROM h),
z AS (SELECT *, len(rows) < 2 OR len(list_filter(rows, lambda x: len(list_filter(x, lambda y: y <> '')) > 1)) = 0 AS drawing FROM u)
SELECT l_orderkey, CASE WHEN drawing THEN array_to_string(list_filter(flatten(rows), lambda y: y <> ''), chr(10)) ELSE array_to_string(list_prepend('| ' || array_to_string(rows[1], ' | ') || ' |', list_prepend('|' || repeat(' --- |', len(rows[1])), list_transform(rows[2:], lambda x: '| ' || array_to_string(x, ' | ') || ' |'))), chr(10)) END AS md FROM z"""
)
def cell_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tables on two pages whose columns are drawn in several places: cells, folded rows, Markdown."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    li = table(spark, sf_dir, "lineitem").withColumn("rn", F.row_number().over(w))
    cell = lambda n, x, off, text: F.struct(F.lit(n).alias("ordinal"), x.cast("double").alias("x0"), (x + 30).cast("double").alias("x1"), (700.0 - F.col("rn") * 20 + off).alias("y1"), text.cast("string").alias("text"))
    flag = cell(2, 100 + 40 * (F.col("l_partkey") % 4), F.col("l_suppkey") % 3, F.when(F.col("l_quantity") > 3, F.col("l_returnflag")))
    status = cell(3, 300 + 30 * (F.col("l_suppkey") % 3), F.lit(0), F.when(F.col("l_quantity") > 25, F.col("l_linestatus")))
    each = F.array(cell(1, 50 + F.col("l_partkey") % 2 * 2, F.lit(1), F.col("l_linenumber")), flag, status)
    cells = li.select("l_orderkey", F.floor(F.col("l_linenumber") / 4).alias("page"), F.explode(each).alias("c")).select("l_orderkey", "page", "c.*")
    return layout.table_rows(cells, ["l_orderkey"]).select("l_orderkey", layout.rendered(F.col("rows")).alias("md"))


@query(
    """WITH RECURSIVE o AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page FROM orders), p AS (SELECT *, o_orderkey % 7 AS before, o_orderkey // 7 % 5 AS after, o_orderkey % 5 = 0 AS two, [50.0 + o_orderkey % 3] || CASE WHEN o_orderkey % 3 > 0 THEN [150.0 + o_orderkey % 2] ELSE [] END || CASE WHEN o_orderkey % 9 = 4 THEN [225.0] ELSE [] END || [300.0 + o_orderkey % 4 // 3 * 4] AS xs FROM o),
c AS (SELECT o_custkey, page, after, false AS goes, page AS hp, CAST(1 AS BIGINT) AS hn, CASE WHEN two THEN [10.0, 20.0] ELSE xs END AS own, page AS cp, CASE WHEN two THEN 2 ELSE 1 END AS cn, o_orderkey % 11 = 0 AS bare FROM p WHERE page = 1 UNION ALL
SELECT o_custkey, page, after, ok, CASE WHEN ok THEN cp ELSE page END, CASE WHEN ok THEN cn ELSE 1 END, CASE WHEN two THEN [10.0, 20.0] WHEN ok THEN own ELSE xs END, CASE WHEN ok AND NOT two THEN cp ELSE page END, CASE WHEN two THEN 2 WHEN ok THEN cn ELSE 1 END, o_orderkey % 11 = 0
FROM (SELECT p.*, c.own, c.cp, c.cn, NOT c.bare AND p.o_orderkey % 11 <> 0 AND c.after <= 3 AND p.before <= 3 AND abs(p.xs[1] - c.own[1]) <= 3 AND abs(p.xs[-1] - c.own[-1]) <= 3 AND len(list_filter(p.xs, lambda x: len(list_filter(c.own, lambda y: abs(x - y) <= 3)) = 0)) = 0 AS ok FROM c JOIN p ON p.o_custkey = c.o_custkey AND p.page = c.page + 1)),
t AS (SELECT c.o_custkey, c.page, CAST(1 AS BIGINT) AS nth, hp AS head_page, CAST(hn AS BIGINT) AS head_nth FROM c WHERE NOT bare UNION ALL SELECT p.o_custkey, p.page, 2, p.page, 2 FROM p WHERE two AND o_orderkey % 11 <> 0)
SELECT o_custkey, CAST(page AS INTEGER) AS page, CAST(nth AS INTEGER) AS nth, CAST(head_page AS INTEGER) AS head_page, CAST(head_nth AS INTEGER) AS head_nth FROM t"""
)
def continued_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as pages of a document, most with a table, some with two or none: which go on with which."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("page", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))).where(k % 11 != 0)
    at = lambda v: F.array(v.cast("double"))
    none = F.array().cast("array<double>")
    xs = F.concat(at(50 + k % 3), F.when(k % 3 > 0, at(150 + k % 2)).otherwise(none), F.when(k % 9 == 4, at(F.lit(225))).otherwise(none), at(300 + F.floor(k % 4 / 3) * 4))
    one = lambda n, edges: F.struct(F.lit(n).alias("nth"), edges.alias("xs"))
    each = F.when(k % 5 == 0, F.array(one(1, xs), one(2, F.array(F.lit(10.0), F.lit(20.0))))).otherwise(F.array(one(1, xs)))
    t = o.select("o_custkey", "page", (k % 7).alias("before"), (F.floor(k / 7) % 5).alias("after"), F.explode(each).alias("t")).select("o_custkey", "page", "before", "after", "t.*")
    return layout.continued(t, "o_custkey").select("o_custkey", "page", "nth", "head_page", "head_nth")


@query(
    r"""WITH p AS (SELECT p_partkey, p_brand AS folder, CASE WHEN p_partkey % 7 = 0 THEN upper(split_part(p_name, ' ', 1)) WHEN p_partkey % 11 = 0 THEN split_part(p_name, ' ', 1) || ' (2)' WHEN p_partkey % 13 = 0 THEN split_part(p_name, ' ', 1) || ' (3)' ELSE split_part(p_name, ' ', 1) END AS name FROM part), k AS (SELECT *, lower(name) AS k, row_number() OVER (PARTITION BY folder, lower(name) ORDER BY p_partkey) AS nth FROM p),
t AS (SELECT folder, regexp_extract(k, '^(.*) \(([1-9][0-9]*)\)$', 1) AS k, list_sort(list_distinct(list(CAST(regexp_extract(k, ' \(([1-9][0-9]*)\)$', 1) AS BIGINT)))) AS taken FROM k WHERE nth = 1 AND regexp_matches(k, ' \([1-9][0-9]*\)$') GROUP BY 1, 2),
n AS (SELECT p_partkey, k.folder, name, nth, list_reduce(list_prepend(nth, list_filter(coalesce(taken, []), lambda x: x > 1)), lambda a, x: CASE WHEN x <= a THEN a + 1 ELSE a END) AS free FROM k LEFT JOIN t ON t.folder = k.folder AND t.k = k.k)
SELECT p_partkey, folder, CASE WHEN nth = 1 THEN name ELSE name || ' (' || free || ')' END AS unique_name FROM n"""
)
def unique_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files of their brand's folder, names equal but for case and names that look like numbered ones among them."""
    k, name = F.col("p_partkey"), F.split_part("p_name", F.lit(" "), F.lit(1))
    said = F.when(k % 7 == 0, F.upper(name)).when(k % 11 == 0, F.concat(name, F.lit(" (2)"))).when(k % 13 == 0, F.concat(name, F.lit(" (3)"))).otherwise(name)
    d = names.suffixed(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("folder"), said.alias("name")), ["folder"], "name", k)
    return d.select("p_partkey", "folder", "unique_name")


@query(
    "SELECT lower(p_name) AS name, count(DISTINCT p_brand || '/' || p_partkey % 40) AS paths, min(p_brand || '/' || p_partkey % 40) AS first_path FROM part GROUP BY 1 HAVING count(DISTINCT p_brand || '/' || p_partkey % 40) > 1"
)
def ambiguous_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of parts that stand in several places, so a link by the name alone may mean any of them."""
    path = F.concat_ws("/", "p_brand", (F.col("p_partkey") % 40).cast("string"))
    return names.ambiguous(table(spark, sf_dir, "part").select("p_name", path.alias("path")), "p_name", "path")


_TREE = "p_brand || '/' || replace(p_type, ' ', '/') || '/' || p_name || '.md'"
_UP = "list_transform(range(1, len(string_split({0}, '/')) + 1), lambda i: array_to_string(string_split({0}, '/')[:i], '/'))"


@query(
    f"""WITH p AS (SELECT p_partkey, lower({_TREE}) AS own, lower(p_brand || '/' || split_part(p_type, ' ', 1)) AS module FROM part), v AS (SELECT DISTINCT unnest({_UP.format('own')}) AS key FROM p WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)),
bad AS (SELECT DISTINCT module AS key FROM p WHERE p_partkey % 211 = 5), holds AS (SELECT DISTINCT unnest({_UP.format('key')}) AS key FROM bad),
u AS (SELECT p_partkey, own, unnest({_UP.format('own')}) AS key, unnest(range(1, len(string_split(own, '/')) + 1)) AS level FROM p),
lost AS (SELECT p_partkey, own, coalesce(min(level) FILTER (level > 1 AND key NOT IN (SELECT key FROM v)), 0) AS lost FROM u GROUP BY 1, 2),
g AS (SELECT u.p_partkey, bool_or(u.level = lost - 1 AND u.key IN (SELECT key FROM holds) OR u.level < lost AND u.key IN (SELECT key FROM bad)) AS guard, max(CASE WHEN u.level = lost THEN u.key END) AS root FROM u JOIN lost ON lost.p_partkey = u.p_partkey GROUP BY 1)
SELECT p_partkey, CASE WHEN lost = 0 THEN 'kept' WHEN guard THEN 'guarded' ELSE 'orphan' END AS state, CASE WHEN lost > 0 AND NOT guard THEN root END AS root FROM lost JOIN g USING (p_partkey)"""
)
def swept_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files in their brand's and type's folders, vouched for in capitals where they sold well, with some modules failed."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.col("p_brand"), F.lit("/"), F.replace("p_type", F.lit(" "), F.lit("/")), F.lit("/"), F.col("p_name"), F.lit(".md")).alias("path"), F.concat_ws("/", F.lower("p_brand"), F.split_part("p_type", F.lit(" "), F.lit(1))).alias("module"))
    sold = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct()
    states = tree.swept(p.select("path"), p.join(sold, "p_partkey", "left_semi").select(F.upper("path").alias("path")), p.where("p_partkey % 211 = 5").select(F.col("module").alias("folder")))
    return p.join(states.distinct(), "path").select("p_partkey", "state", "root")


@query(
    r"""SELECT doc_id, coalesce(regexp_extract(text, '^\S+'), '') AS code, CAST(row_number() OVER (ORDER BY coalesce(regexp_extract(text, '^\S+'), '') COLLATE en, doc_id) AS INTEGER) AS place FROM documents"""
)
def course_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by their first word in the order of a dictionary: accents and capitals decide after the letters."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(F.regexp_extract("text", r"^\S+", 0), F.lit("")).alias("code"))
    return plan.in_locale_order(d, "code", F.col("doc_id")).select("doc_id", "code", F.col("place").cast("int").alias("place"))


@query(
    """WITH f AS (SELECT DISTINCT conv_id % 50 AS id FROM conversations WHERE conv_id % 2 = 0), c AS (SELECT conv_id, turn, role, text, f.id AS got, conv_id % 50 AS want, turn % 3 = 2 AS lost FROM conversations LEFT JOIN f ON f.id = conv_id % 50)
SELECT conv_id, turn, '## ' || role || chr(10) || chr(10) || 'See ' || CASE WHEN lost THEN '[this one](/courses/' || conv_id || '/pages/none-' || turn || ')' ELSE '[[' || printf('%02d', turn) || ' - ' || role || '|this one]]' END || ' and ![x](' || CASE WHEN got IS NULL THEN '/files/' || want ELSE 'assets/' || want || '.png' END || ')' AS markdown,
CAST(CASE WHEN got IS NULL THEN 0 ELSE 1 END AS BIGINT) AS localised, CAST(CASE WHEN lost THEN 0 ELSE 1 END AS BIGINT) AS rewritten, CASE WHEN lost THEN 'page:' || conv_id || ':none-' || turn ELSE '' END AS unresolved FROM c"""
)
def finished_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML bodies with a link and an image each, as they stand in notes."""
    c = table(spark, sf_dir, "conversations")
    s = lambda n: F.col(n).cast("string")
    base = F.concat(T.pad2(F.col("turn")), F.lit(" - "), F.col("role"))
    to = F.concat(F.when(F.col("turn") % 3 == 2, F.lit("none-")).otherwise(F.lit("Turn%2D")), s("turn"))
    file = (F.col("conv_id") % 50).cast("string")
    body = F.concat(F.lit("<h2>"), "role", F.lit('</h2><div style="display:none">no</div><p>See <a href="/courses/'), s("conv_id"), F.lit("/pages/"), to, F.lit('">this one</a> and <img src="/files/'), file, F.lit('" alt="x"></p><script>no()</script>'))
    bodies = c.select(F.struct("conv_id", "turn").alias("note_id"), body.alias("body"), F.lit("/notes").alias("folder"))
    index = c.select(F.concat_ws(":", F.lit("page"), s("conv_id"), F.concat(F.lit("turn-"), s("turn"))).alias("key"), base.alias("basename"), F.concat(F.lit("/notes/"), base, F.lit(".md")).alias("full_path"))
    files = c.where("conv_id % 2 = 0").select(file.alias("file_id"), F.lit("A picture.PNG").alias("name"))
    out = notes.finished(bodies, files, index, "lms.example")
    return out.select("note_id.conv_id", "note_id.turn", "markdown", "localised", "rewritten", F.array_join("unresolved", ",").alias("unresolved"))


@query(
    r"""WITH d AS (SELECT doc_id, ['pdf', 'pptx', 'xlsx', 'docx', 'zip'][doc_id % 5 + 1] AS ext, text FROM documents), p AS (SELECT doc_id, ext, list_filter(string_split(text, '. '), lambda x: regexp_matches(x, '\S')) AS parts FROM d),
c AS (SELECT doc_id, ext, CAST(len(parts) AS BIGINT) AS n, regexp_replace(regexp_replace(array_to_string(parts, chr(10) || chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM p)
SELECT doc_id, CASE WHEN ok THEN md5(t) END AS text_md5, CASE WHEN ok THEN CASE ext WHEN 'pdf' THEN 'Extracted text from `' WHEN 'pptx' THEN 'Slide text extracted from `' WHEN 'xlsx' THEN 'Sheets from `' ELSE 'Text extracted from `' END || doc_id || '.' || upper(ext) || '` (' || n || CASE ext WHEN 'pdf' THEN ' pages). Figures/diagrams are in the original.' WHEN 'pptx' THEN ' slides). Images/layout are in the original.' WHEN 'xlsx' THEN ' sheet(s)) as tables.' ELSE ' paragraphs). Exact layout is in the original.' END END AS remark, CASE WHEN ok THEN n END AS n
FROM (SELECT *, ext <> 'zip' AND n > 0 AS ok FROM c)"""
)
def extracted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as landed texts of files of four kinds, and of one without a converter; their sentences are the parts."""
    d = table(spark, sf_dir, "documents")
    at = F.col("doc_id") % 5
    ext = F.element_at(F.array(*[F.lit(x) for x in ("PDF", "PPTX", "XLSX", "DOCX", "ZIP")]), (at + 1).cast("int"))
    separator = F.element_at(F.array(*[F.lit(x) for x in ("\f", "\f", "\x1d", "\n\n", "|")]), (at + 1).cast("int"))
    files = d.select(F.col("doc_id").alias("id"), F.concat(F.col("doc_id").cast("string"), F.lit("."), ext).alias("name"), F.replace("text", F.lit(". "), separator).alias("text"))
    return extract.extracted(files).select(F.col("id").alias("doc_id"), F.md5(F.col("extracted").cast("binary")).alias("text_md5"), "remark", "n")


_KIND3 = "['Page', 'Quiz', 'File'][turn % 3 + 1]"


@query(
    f"""WITH i AS (SELECT conv_id, turn, {_KIND3} AS type, CASE WHEN turn % 3 > 0 THEN CASE WHEN turn % 4 > 0 THEN CAST(turn AS VARCHAR) END ELSE 'turn-' || turn END AS ref FROM conversations), e AS (SELECT conv_id, {_KIND3} AS type, CASE WHEN turn % 3 > 0 THEN CAST(turn AS VARCHAR) ELSE 'turn-' || turn END AS ref, min({{'role': role, 'body': md5(text)}}) AS x FROM conversations WHERE conv_id % 4 <> 0 GROUP BY 1, 2, 3)
SELECT i.conv_id, turn, i.type, e.ref IS NOT NULL AS found, x.role AS role, x.body AS body FROM i LEFT JOIN e ON e.conv_id = i.conv_id AND e.type = i.type AND e.ref = i.ref"""
)
def items_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as items that name what they show by slug or id, and the bodies that were fetched for most of them."""
    c = table(spark, sf_dir, "conversations")
    kind = F.element_at(F.array(*[F.lit(k) for k in ("Page", "Quiz", "File")]), (F.col("turn") % 3 + 1).cast("int"))
    slug = lambda begin: F.concat(F.lit(begin), F.col("turn").cast("string"))
    items = c.select("conv_id", "turn", F.col("conv_id").alias("course_id"), kind.alias("type"), slug("Turn%2D").alias("page_url"), F.when(F.col("turn") % 4 > 0, F.col("turn")).alias("content_id"))
    ref = F.when(F.col("turn") % 3 == 0, slug("tURN-")).otherwise(F.col("turn").cast("string"))
    entities = c.where("conv_id % 4 <> 0").select(F.col("conv_id").alias("course_id"), kind.alias("type"), ref.alias("ref"), "role", F.md5(F.col("text").cast("binary")).alias("body"))
    return plan.with_content(items, entities).select("conv_id", "turn", "type", "found", "role", "body")
