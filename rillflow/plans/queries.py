"""The engine's queries over the given tables, each beside the DuckDB SQL of the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions import links as L
from rillflow.functions import text as T
from rillflow.functions.markdown import html_to_markdown
from rillflow.operators import links, plan, state, tally, words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_HOST = r"lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))"
HREFS = r"SELECT page_id, unnest(range(len(u))) AS pos, unnest(u) AS url, unnest(l) AS label FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*href=\"([^\"]*)\"[^>]*>([^<]*)</a>', 1) AS u, regexp_extract_all(html, '<a\s[^>]*href=\"([^\"]*)\"[^>]*>([^<]*)</a>', 2) AS l FROM pages)".replace('\\"', '"')


@query(f"SELECT {URL_HOST} AS host, count(*) AS n_pages, CAST(sum(len(regexp_extract_all(html, '<a\\s[^>]*href='))) AS BIGINT) AS n_links FROM pages GROUP BY 1")
def host_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.groupBy(T.host(F.col("url")).alias("host")).agg(F.count("*").alias("n_pages"), F.sum(F.regexp_count("html", F.lit(r"<a\s[^>]*href="))).cast("long").alias("n_links"))


@query("SELECT coalesce(nullif(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END, ''), '(no type)') AS kind, count(*) AS n FROM events GROUP BY 1")
def type_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("event_type", F.when(F.col("event_id") % 11 != 0, F.col("event_type")))
    return tally.inventory(e, F.col("event_type"), "kind", "(no type)").orderBy(F.desc("n"), "kind")


@query(f"SELECT page_id, CAST(pos AS INTEGER) AS pos, url, label FROM ({HREFS})")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.extracted(table(spark, sf_dir, "pages"), "page_id", "html")


@query(f"SELECT l.page_id, CAST(l.pos AS INTEGER) AS pos, l.url, i.basename FROM ({HREFS}) l LEFT JOIN (SELECT DISTINCT url, substr(url, 2) AS basename FROM ({HREFS}) WHERE length(url) % 2 = 0) i ON l.url = i.url")
def link_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.extracted(table(spark, sf_dir, "pages"), "page_id", "html")
    index = found.where(F.length("url") % 2 == 0).select("url", F.substr("url", F.lit(2)).alias("basename")).distinct()
    return links.resolved(found, index, "url").select("page_id", "pos", "url", "basename")


@query(f"SELECT h AS host, url, count(*) AS n FROM (SELECT {URL_HOST} AS h, page_id AS p FROM pages) JOIN ({HREFS}) ON p = page_id WHERE length(url) % 2 = 1 GROUP BY 1, 2")
def unresolved_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").withColumn("host", T.host(F.col("url")))
    found = links.extracted(pages.select("html", F.struct("page_id", "host").alias("at")), "at", "html")
    index = found.where(F.length("url") % 2 == 0).select("url").distinct()
    return found.join(index, "url", "left_anti").groupBy(F.col("at.host").alias("host"), "url").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def unfiled_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    filed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").join(filed, "p_partkey", "left_anti").select("p_partkey", "p_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def covered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    scraped = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return table(spark, sf_dir, "supplier").join(scraped, "s_nationkey", "left_semi").select("s_suppkey", "s_name")


@query("SELECT conv_id, turn, printf('%02d', row_number() OVER w) || ' - ' || coalesce(CASE WHEN turn % 3 = 1 THEN NULL ELSE role END, 'Item ' || row_number() OVER w) AS title FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY coalesce(turn, 0), text)")
def item_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    title = F.when(F.col("turn") % 3 != 1, F.col("role"))
    return plan.numbered(c, ["conv_id"], F.col("turn"), F.col("text")).select("conv_id", "turn", plan.numbered_title(F.col("number"), title, "Item").alias("title"))


@query(
    """WITH terms AS (SELECT o_custkey AS id, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE min(o_orderdate) END AS s, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE max(o_orderdate) END AS e FROM orders GROUP BY o_custkey)
SELECT c_custkey, c_name, replace(c_name, '#', '-') AS folder FROM customer JOIN terms ON id = c_custkey
WHERE c_custkey % 97 = 0 OR ((s IS NULL OR TIMESTAMP '1995-06-17' >= s) AND (e IS NULL OR TIMESTAMP '1995-06-17' <= e) AND (s IS NOT NULL OR e IS NOT NULL) AND c_mktsegment = 'BUILDING')"""
)
def active_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-added ones, or those of the role whose term is current; open bounds where the key says so."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    o = o.select("o_custkey", F.when(F.col("o_custkey") % 3 != 0, F.col("s")).alias("s"), F.when(F.col("o_custkey") % 5 != 0, F.col("e")).alias("e"))
    c = table(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"))
    now = F.lit("1995-06-17 00:00:00").cast("timestamp_ntz")
    chosen = (F.col("c_custkey") % 97 == 0) | (plan.is_current(F.col("s"), F.col("e"), now) & (F.col("c_mktsegment") == "BUILDING"))
    return c.where(chosen).select("c_custkey", "c_name", T.folder_name(F.replace("c_name", F.lit("#"), F.lit(" ")), F.col("c_custkey")).alias("folder"))


TYPES = ("Page", "Quiz", "ExternalUrl", "SubHeader", "Mystery")


@query(
    """WITH items AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'Page' WHEN 'signup' THEN 'Quiz' WHEN 'click' THEN 'ExternalUrl' WHEN 'purchase' THEN 'SubHeader' ELSE 'Mystery' END AS type, CASE WHEN event_id % 2 = 0 THEN 'https://Uni.SharePoint.com/:w:/x' ELSE 'https://other.example/x' END AS url FROM events)
SELECT event_id, type, CASE WHEN type = 'ExternalUrl' THEN CASE WHEN url LIKE '%SharePoint%' THEN 'share_download' ELSE 'link_note' END WHEN type = 'Page' THEN 'page' WHEN type = 'Quiz' THEN 'quiz' WHEN type = 'SubHeader' THEN 'heading' ELSE 'unknown' END AS handler, CASE WHEN url LIKE '%SharePoint%' THEN 'docx' ELSE '' END AS ext FROM items"""
)
def handler_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in (("view", "Page"), ("signup", "Quiz"), ("click", "ExternalUrl"), ("purchase", "SubHeader"))], F.lit("Mystery"))
    url = F.when(F.col("event_id") % 2 == 0, F.lit("https://Uni.SharePoint.com/:w:/x")).otherwise(F.lit("https://other.example/x"))
    e = e.select("event_id", kind.alias("type"), url.alias("url"))
    return e.select("event_id", "type", plan.handler(F.col("type"), F.col("url")).alias("handler"), T.share_extension(F.col("url")).alias("ext"))


@query(
    r"""WITH names AS (SELECT page_id AS id, '  ' || url || chr(9) || chr(1) || regexp_extract(html, '<title>([^<]*)', 1) AS raw FROM pages UNION ALL SELECT p_partkey + 1000000, CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 7 = 1 THEN ' ? ' ELSE p_name || '.PPTX' END FROM part),
safe AS (SELECT id, raw, trim(left(trim(regexp_replace(regexp_replace(raw, '[<>:"/\\|?*\x00-\x1F]', '', 'g'), '\s+', ' ', 'g')), 120)) AS s FROM names)
SELECT id, coalesce(nullif(s, ''), 'untitled') AS name, lower(regexp_extract(coalesce(raw, ''), '(?i)\.([a-z0-9]{1,6})$', 1)) AS ext FROM safe"""
)
def safe_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.concat(F.lit("  "), "url", F.lit("\t\x01"), F.regexp_extract("html", "<title>([^<]*)", 1)).alias("raw"))
    q = table(spark, sf_dir, "part").select((F.col("p_partkey") + 1000000).alias("id"), F.when(F.col("p_partkey") % 7 == 1, F.lit(" ? ")).when(F.col("p_partkey") % 7 != 0, F.concat("p_name", F.lit(".PPTX"))).alias("raw"))
    return p.unionByName(q).select("id", T.safe_name(F.col("raw")).alias("name"), T.extension(F.col("raw")).alias("ext"))


@query(
    r"""SELECT doc_id, '---' || chr(10) || 'title: "' || replace(replace(replace('a\b "q" ' || text, '\', '\\'), '"', '\"'), chr(10), ' ') || '"' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'lang: "' || lang || '"' || chr(10) END || 'source: "' || source || '"' || chr(10) || '---' || chr(10) AS front FROM documents"""
)
def frontmatter_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front matter with a document's whole text as the title."""
    d = table(spark, sf_dir, "documents")
    title = F.concat(F.lit('a\\b "q" '), "text")
    fields = [("title", title), ("lang", F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("lang"))), ("none", F.lit(None).cast("string")), ("source", F.col("source"))]
    return d.select("doc_id", T.frontmatter(fields).alias("front"))


DAMAGED = "chr(65279) || 'a' || chr(13) || chr(10) || 'b' || chr(0) || chr(12) || repeat(chr(10), CAST(doc_id % 5 AS INTEGER)) || text || chr(13) || repeat(chr(127), CAST(doc_id % 3 AS INTEGER)) || ' ' || chr(10)"


def _damaged() -> Column:
    n = lambda k: (F.col("doc_id") % k).cast("int")
    return F.concat(F.lit("\ufeffa\r\nb\x00\f"), F.repeat(F.lit("\n"), n(5)), "text", F.lit("\r"), F.repeat(F.lit("\x7f"), n(3)), F.lit(" \n"))


@query(
    rf"""WITH d AS (SELECT doc_id, {DAMAGED} AS t FROM documents), c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '\r\n?', chr(10), 'g'), '\f', chr(10), 'g'), '[\x00-\x08\x0B\x0E-\x1F\x7F\x{{FEFF}}]', '', 'g') AS t FROM d)
SELECT doc_id, md5(regexp_replace(regexp_replace(t, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')) AS clean_md5 FROM c"""
)
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(T.clean_text(_damaged()).cast("binary")).alias("clean_md5"))


@query(f"SELECT doc_id, CAST(4 + 1 + doc_id % 3 AS BIGINT) AS noise FROM (SELECT doc_id, {DAMAGED} AS t FROM documents)")
def noise_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.noise_count(_damaged()).alias("noise"))


@query("SELECT doc_id, md5('it' || chr(8217) || 's ' || CASE WHEN doc_id % 2 = 0 THEN chr(8212) ELSE chr(8230) || ' ' END || text) AS fixed_md5 FROM documents")
def mojibake_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    hurt = F.concat(F.lit("it‚Äôs "), F.when(F.col("doc_id") % 2 == 0, F.lit("‚Äî")).otherwise(F.lit("‚Ä¶¬†")), "text")
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.mojibake_repaired(hurt).cast("binary")).alias("fixed_md5"))


@query(
    r"""SELECT doc_id, md5(replace(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), '<br>'), '|', '\|')) AS cell_md5 FROM documents"""
)
def escape_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.escaped_cell(F.col("text")).cast("binary")).alias("cell_md5"))


@query(
    """SELECT l_orderkey, '| Line | Flag | Note |' || chr(10) || '| --- | --- | --- |' || chr(10) || string_agg('| ' || l_linenumber || ' | ' || l_returnflag || ' | ' || CASE WHEN l_linenumber % 2 = 0 THEN 'a\\|b<br>c' ELSE '' END || ' |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS md
FROM lineitem GROUP BY l_orderkey""".replace("\\\\", "\\")
)
def markdown_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per order; odd rows are short, so they are padded; an empty row is dropped."""
    li = table(spark, sf_dir, "lineitem")
    note = F.array(F.col("l_linenumber").cast("string"), "l_returnflag", F.lit("a|b\r\n\n c"))
    row = F.when(F.col("l_linenumber") % 2 == 0, note).otherwise(F.slice(note, 1, 2))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("r")))), lambda x: x["r"])
    g = li.groupBy("l_orderkey").agg(rows.alias("rows"))
    return g.select("l_orderkey", T.markdown_table(F.concat(F.array(F.array(F.lit("Line"), F.lit("Flag"), F.lit("Note")), F.array(F.lit(" "))), "rows")).alias("md"))


@query("SELECT o_orderkey, array_to_string(list_filter(['**Due:** ' || CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END, '**Points:** ' || CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderkey || '.5' END END], lambda x: x IS NOT NULL), '  |  ') AS meta FROM orders")
def meta_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    due = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    worth = F.when(F.col("o_orderkey") % 3 != 0, T.points(F.col("o_orderkey") + F.when(F.col("o_orderkey") % 2 == 0, 0.0).otherwise(0.5)))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.meta_line([("Due", due), ("Points", worth)]).alias("meta"))


@query(
    """WITH now AS (SELECT user_id, event_type, max(CAST(event_id AS VARCHAR)) AS u FROM events GROUP BY ALL), old AS (SELECT user_id, event_type, max(CAST(event_id AS VARCHAR)) AS u FROM events WHERE event_id % 10 < 7 AND user_id % 5 <> 0 GROUP BY ALL)
SELECT now.user_id, now.event_type, coalesce(now.user_id % 7 <> 0 AND now.u = old.u, false) AS skip, old.u IS NOT NULL AS known FROM now LEFT JOIN old ON now.user_id = old.user_id AND now.event_type = old.event_type"""
)
def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    stamp = F.max(F.col("event_id").cast("string")).alias("updated_at")
    keys = ["user_id", "event_type"]
    now = e.groupBy(*keys).agg(stamp).withColumn("updated_at", F.when(F.col("user_id") % 7 != 0, F.col("updated_at")))
    old = e.where("event_id % 10 < 7 and user_id % 5 <> 0").groupBy(*keys).agg(stamp)
    return state.compared(now, old, keys).select(*keys, "skip", "known")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30) AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def orphans_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    vouched = table(spark, sf_dir, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("o_orderkey"))
    return state.orphans(o.select("o_orderkey", "o_custkey"), vouched, o.where("o_orderstatus = 'P'"), "o_orderkey", "o_custkey").select("o_orderkey", "o_custkey")


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'new' ELSE p_brand END AS seen FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0")
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    old = p.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_brand").alias("seen"))
    return state.upserted(old, p.where("p_partkey % 3 = 0").select("p_partkey", F.lit("new").alias("seen")), ["p_partkey"])


@query("SELECT coalesce(event_type, '(all)') AS event_type, count(*) FILTER (value > 10) AS written, count(*) FILTER (value <= 10) AS skipped, count(*) FILTER (event_id % 13 = 0) AS issues FROM events GROUP BY ROLLUP (event_type)")
def tally_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = {"written": F.col("value") > 10, "skipped": F.col("value") <= 10, "issues": F.col("event_id") % 13 == 0}
    return tally.tally(table(spark, sf_dir, "events"), "event_type", counters)



@query(
    """WITH n AS (SELECT count(*) AS c FROM supplier), e AS (SELECT DISTINCT l_suppkey AS src, l_partkey % (SELECT c FROM n) AS dst FROM lineitem),
r0 AS (SELECT min(src) AS node, 0 AS round FROM e), r1 AS (SELECT DISTINCT dst AS node, 1 AS round FROM r0 JOIN e ON node = src WHERE dst NOT IN (SELECT node FROM r0)),
d1 AS (SELECT * FROM r0 UNION ALL SELECT * FROM r1), r2 AS (SELECT DISTINCT dst AS node, 2 AS round FROM r1 JOIN e ON node = src WHERE dst NOT IN (SELECT node FROM d1)),
d2 AS (SELECT * FROM d1 UNION ALL SELECT * FROM r2), r3 AS (SELECT DISTINCT dst AS node, 3 AS round FROM r2 JOIN e ON node = src WHERE dst NOT IN (SELECT node FROM d2))
SELECT CAST(node AS BIGINT) AS node, CAST(round AS INTEGER) AS round FROM (SELECT * FROM d2 UNION ALL SELECT * FROM r3)"""
)
def linked_rounds_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes reached in three rounds over the edges of every lineitem row."""
    n = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    e = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % n).alias("dst")).distinct()
    return links.followed(e.agg(F.min("src").alias("node")), e)


@query("SELECT user_id, min(props) AS props, CAST(min(event_id) AS BIGINT) AS first_event FROM events GROUP BY user_id, props")
def dedup_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's distinct assets, the first wins."""
    return table(spark, sf_dir, "events").groupBy("user_id", "props").agg(F.min("event_id").alias("first_event"))


WHOLE_WORDS = r"unnest(regexp_extract_all(lower(text), '\p{L}+'))"


@query(
    f"""WITH w AS (SELECT {WHOLE_WORDS} AS word FROM documents), d AS (SELECT word, CASE WHEN count(*) > 100 THEN 10 WHEN count(*) > 10 THEN 35 ELSE 70 END AS tier FROM w GROUP BY 1),
hurt AS (SELECT DISTINCT replace(word, 'th', chr(65533)) AS word FROM d WHERE word LIKE '%th%' AND length(word) - length(replace(word, 'th', '')) <= 6),
g AS (SELECT unnest(['ti','tti','ft','tt','fi','fl','ff','ffi','ffl','tf','th']) AS g, unnest(range(11)) AS i),
s AS (SELECT word, string_split(word, chr(65533)) AS s FROM hurt),
c AS (SELECT word, s[1] || a.g || s[2] AS cand, a.i AS pos FROM s, g a WHERE len(s) = 2
UNION ALL SELECT word, s[1] || a.g || s[2] || b.g || s[3], a.i * 11 + b.i FROM s, g a, g b WHERE len(s) = 3
UNION ALL SELECT word, s[1] || a.g || s[2] || b.g || s[3] || c.g || s[4], (a.i * 11 + b.i) * 11 + c.i FROM s, g a, g b, g c WHERE len(s) = 4),
t AS (SELECT c.word, cand, pos, coalesce(a.tier, b.tier) AS tier FROM c LEFT JOIN d a ON a.word = cand LEFT JOIN d b ON cand LIKE '%s' AND b.word = left(cand, -1))
SELECT word, arg_min(cand, tier * 10000 + pos) AS fixed FROM t WHERE tier IS NOT NULL GROUP BY word"""
)
def best_candidate_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with up to three lost places and the most common listed filling; the corpus is its own dictionary."""
    d = _whole_dictionary(spark, sf_dir)
    hurt = d.where(F.col("word").contains("th")).select(F.replace("word", F.lit("th"), F.lit(words.LOST)).alias("word")).distinct()
    return words.best_candidates(hurt, d)


def _whole_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return w.groupBy("word").agg(F.when(F.count("*") > 100, 10).when(F.count("*") > 10, 35).otherwise(70).alias("tier"))


@query()
def ligature_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with every lost ``th`` marked, and what the corpus as dictionary repairs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("th"), F.lit(words.LOST)).alias("text"))
    return words.repaired(docs, _whole_dictionary(spark, sf_dir), "doc_id", "text").select("doc_id", "marked", "doubled", F.md5(F.col("text").cast("binary")).alias("text_md5"))




PAGES = "(SELECT greatest(50, count(*) // 1200) FROM lineitem)"
EVERY_CELL = f"SELECT l_orderkey % {PAGES} AS page, CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS line, l_partkey, l_suppkey, l_quantity * 10.0 AS x0, l_quantity * 10.0 + 60.0 AS x1, l_partkey % 40 * 10.0 AS y0, l_partkey % 40 * 10.0 + 45.0 AS y1 FROM lineitem"
EVERY_ITEM = f"SELECT event_id % {PAGES} AS page, event_id AS item, user_id % 60 * 10.0 + 5.0 AS x, event_id % 43 * 10.0 + 1.0 AS y FROM events"


@query(
    f"""WITH i AS ({EVERY_ITEM}), c AS ({EVERY_CELL}), f AS (SELECT i.page, item, line, l_partkey, l_suppkey, row_number() OVER (PARTITION BY i.page, item ORDER BY line, l_partkey, l_suppkey) AS nth FROM i JOIN c ON i.page = c.page AND x > x0 AND x < x1 AND y > y0 AND y < y1)
SELECT CAST(page AS BIGINT) AS page, item, line, l_partkey, l_suppkey FROM f WHERE nth = 1"""
)
def item_in_cell_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text items in the first layout cell that holds them, every lineitem row a cell: a range join on a grid.

    Pages grow with the table, so each holds about 1,200 cells.
    """
    c = table(spark, sf_dir, "lineitem")
    pages = c.agg(F.greatest(F.lit(50).cast("long"), F.floor(F.count("*") / 1200)).alias("n"))
    at = F.col("l_partkey") % 40 * 10.0
    # An order's lines can share a number; with part and supplier a cell is unique.
    cell = F.struct((F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("long").alias("line"), "l_partkey", "l_suppkey")
    cells = c.select((F.col("l_orderkey") % pages.scalar()).alias("page"), cell.alias("cell"), (F.col("l_quantity") * 10.0).alias("x0"), (F.col("l_quantity") * 10.0 + 60.0).alias("x1"), at.alias("y0"), (at + 45.0).alias("y1"))
    e = table(spark, sf_dir, "events")
    items = e.select((F.col("event_id") % pages.scalar()).alias("page"), F.col("event_id").alias("item"), (F.col("user_id") % 60 * 10.0 + 5.0).alias("x"), (F.col("event_id") % 43 * 10.0 + 1.0).alias("y"))
    return words.first_cell(items, cells, "page", 100.0).select("page", "item", "cell.*")


@query(
    """WITH f AS (SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 503 WHEN event_id % 4 = 1 THEN 404 ELSE NULL END AS status, CASE WHEN event_id % 6 = 2 THEN 'read ECONNRESET' WHEN event_id % 6 = 5 THEN 'Socket hang up!' ELSE 'not found' END AS message FROM events)
SELECT event_id, (coalesce(status = 503, false) OR message LIKE '%ECONN%' OR message LIKE 'Socket%') AS transient, CAST(least(15000, 1000 * pow(2, event_id % 6)) AS BIGINT) AS wait_ms FROM f"""
)
def fetch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    status = F.when(i % 4 == 0, 503).when(i % 4 == 1, 404)
    message = F.when(i % 6 == 2, "read ECONNRESET").when(i % 6 == 5, "Socket hang up!").otherwise("not found")
    return table(spark, sf_dir, "events").select("event_id", tally.transient(status, message).alias("transient"), tally.backoff_ms(i % 6 + 1).alias("wait_ms"))


@query("SELECT event_id, 'https://h.example/p?page=' || (event_id + 1) AS next, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'notes ' || event_id || '.pdf' AS file FROM events")
def landed_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses: next page from the Link header, guarded JSON body, file name from the disposition."""
    i = F.col("event_id").cast("string")
    link = F.concat(F.lit('<https://h.example/p?page=1>; rel="first",<https://h.example/p?page='), (F.col("event_id") + 1).cast("string"), F.lit('>; rel="next"'))
    body = F.from_json(T.guarded_json(F.concat(F.lit("while(1);"), "props")), "k long")
    sent = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("attachment; filename=\"x\"; filename*=UTF-8''notes%20"), i, F.lit(".pdf"))).otherwise(F.concat(F.lit('attachment; filename="notes '), i, F.lit('.pdf"')))
    return table(spark, sf_dir, "events").select("event_id", T.next_page(link).alias("next"), body["k"].alias("k"), T.disposition_name(sent).alias("file"))


@query(
    """SELECT conv_id, turn, 'See ' || CASE WHEN turn % 3 = 0 THEN '[[' || printf('%02d', turn) || ' - ' || role || '|this one]]' WHEN turn % 3 = 1 THEN '[[' || printf('%02d', turn) || ' - ' || role || ']]' ELSE '[this one](/courses/' || conv_id || '/pages/none-' || turn || ')' END || chr(10) || '| a | ' || CASE WHEN turn % 3 = 2 THEN '[x](https://else.example/courses/1/pages/p)' ELSE '[[' || printf('%02d', turn) || ' - ' || role || '\\|x]]' END || ' |' AS markdown,
CAST(CASE WHEN turn % 3 = 2 THEN 0 ELSE 2 END AS BIGINT) AS rewritten, CASE WHEN turn % 3 = 2 THEN 'page:' || conv_id || ':none-' || turn ELSE '' END AS unresolved FROM conversations""".replace("\\\\", "\\")
)
def relink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes that link to themselves by URL, by title and in a table row, or to pages nobody has."""
    c = table(spark, sf_dir, "conversations")
    third, base = F.col("turn") % 3, F.concat(T.pad2(F.col("turn")), F.lit(" - "), F.col("role"))
    url = F.concat(F.lit("/courses/"), F.col("conv_id").cast("string"), F.lit("/pages/"), F.when(third == 2, F.concat(F.lit("none-"), F.col("turn").cast("string"))).otherwise(F.concat(F.lit("Turn%2D"), F.col("turn").cast("string"), F.lit("?x=1"))))
    label = F.when(third == 1, base).otherwise(F.lit("this one"))
    other = F.when(third == 2, F.lit("https://else.example/courses/1/pages/p")).otherwise(F.concat(F.lit("https://LMS.example"), url, F.lit(' "Title"')))
    md = F.concat(F.lit("See ["), label, F.lit("]("), url, F.lit(")\n| a | [x]("), other, F.lit(") |"))
    notes = c.select(F.struct("conv_id", "turn").alias("note_id"), md.alias("markdown"), F.lit("/notes").alias("folder"))
    index = c.select(F.concat_ws(":", F.lit("page"), F.col("conv_id").cast("string"), F.concat(F.lit("turn-"), F.col("turn").cast("string"))).alias("key"), base.alias("basename"), F.concat(F.lit("/notes/"), base, F.lit(".md")).alias("full_path"))
    out = links.rewritten(notes, index, "lms.example")
    return out.select("note_id.conv_id", "note_id.turn", "markdown", "rewritten", F.array_join("unresolved", ",").alias("unresolved"))


@query()
def html_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as notes: front matter, heading, the page's HTML as Markdown."""
    p = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    body = html_to_markdown(F.col("html"))
    head = T.frontmatter([("title", T.safe_name(title)), ("type", F.lit("Page")), ("url", F.col("url"))])
    return p.select("page_id", F.concat(head, F.lit("\n# "), title, F.lit("\n\n"), F.when(body == "", F.lit("_(empty page)_")).otherwise(body)).alias("note"))


@query(
    """WITH k AS (SELECT l_orderkey, count(*) AS n, string_agg('| ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' | ' || replace(l_returnflag || '|' || l_linestatus, '|', '\\|') || ' | ' || CAST(l_linenumber AS VARCHAR) || ' |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus) AS t FROM lineitem GROUP BY 1)
SELECT l_orderkey, '## Rubric' || chr(10) || chr(10) || '### Order (' || n || ' pts)' || chr(10) || chr(10) || '| Points | Rating | Detail |' || chr(10) || '| --- | --- | --- |' || chr(10) || t AS md FROM k""".replace("\\\\", "\\")
)
def rubric_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rubric per order: its lines are the ratings."""
    rating = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").alias("points"), F.concat_ws("|", "l_returnflag", "l_linestatus").alias("text"))
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(rating)).alias("ratings"))
    line = lambda r: F.concat(F.lit("| "), T.points(r["points"]), F.lit(" | "), F.replace(r["text"], F.lit("|"), F.lit("\\|")), F.lit(" | "), r["l_linenumber"].cast("string"), F.lit(" |"))
    md = F.concat(F.lit("## Rubric\n\n### Order ("), F.col("n").cast("string"), F.lit(" pts)\n\n| Points | Rating | Detail |\n| --- | --- | --- |\n"), F.array_join(F.transform("ratings", line), "\n"))
    return g.select("l_orderkey", md.alias("md"))


# These once read a part of their tables; now both names stand for the whole.
for _name in ("frontmatter", "linked_rounds", "best_candidate", "item_in_cell"):
    QUERIES[_name], ORACLE_SQL[_name] = QUERIES[f"{_name}_whole"], ORACLE_SQL[f"{_name}_whole"]
