"""Queries of planning, notes and incremental rules over the given tables, each beside the DuckDB SQL of the same rows.

Courses are customers, modules their orders, items the orders' lines, and what an item shows is its part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.operators import assets, notes, plan, rules, tally

from .queries import query, table

DATE = "2026-01-01"
KINDS = ("Page", "Assignment", "Quiz", "Discussion", "File", "ExternalUrl", "ExternalTool", "SubHeader")

# The same tables in SQL.
_KIND = "CASE l_partkey % 8 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KINDS)) + " END"
PLANNED = f"""courses AS (SELECT c_custkey AS course_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment || ' ' || c_custkey END AS course_code FROM customer),
modules AS (SELECT o_custkey AS course_id, o_orderkey AS module_id, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 7 END, 0), o_orderkey) AS mn, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderpriority END AS name FROM orders),
items AS (SELECT l_orderkey AS module_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS number, {_KIND} AS type, l_partkey, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE p_name END AS title, CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_partkey END AS content_id, p_name, p_type, p_brand, p_size FROM lineitem JOIN part ON p_partkey = l_partkey),
planned AS (SELECT items.*, course_id, course_code, coalesce(name, 'Module ' || mn) AS module_name, 'https://lms.example/i/' || l_partkey AS html_url, coalesce(replace(course_code, ' ', '-'), CAST(course_id AS VARCHAR)) || '/Content/' || printf('%02d', mn) || ' - ' || coalesce(name, 'Module ' || mn) AS folder, printf('%02d', number) || ' - ' || coalesce(title, 'untitled') AS basename FROM items JOIN modules USING (module_id) JOIN courses USING (course_id))"""


def _front(fields: list[tuple[str, str]]) -> str:
    lines = " || ".join(f"""CASE WHEN coalesce({v}, '') = '' THEN '' ELSE '{k}: "' || {v} || '"' || chr(10) END""" for k, v in fields)
    return f"'---' || chr(10) || {lines} || '---' || chr(10)"


_ITEM = _front([("title", "title"), ("course", "course_code"), ("module", "module_name"), ("type", "type"), ("canvas_url", "html_url"), ("scraped", f"'{DATE}'")])


def _extra(*fields: tuple[str, str]) -> str:
    return _front([("course", "course_code"), ("scraped", f"'{DATE}'"), *fields])


def _sql_note(front: str, *blocks: str) -> str:
    """Blocks after the front matter, two line breaks between; a null block is left out."""
    return f"{front} || '# ' || array_to_string(list_filter([{', '.join(blocks)}], lambda b: b IS NOT NULL), chr(10) || chr(10)) || chr(10)"


def _courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    code = F.when(F.col("c_custkey") % 11 != 0, F.concat("c_mktsegment", F.lit(" "), F.col("c_custkey").cast("string")))
    return c.select(F.col("c_custkey").alias("course_id"), code.alias("course_code"), "c_name")


def _planned(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    modules = o.select(F.col("o_custkey").alias("course_id"), F.col("o_orderkey").alias("module_id"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderpriority")).alias("name"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey") % 7).alias("position"), F.col("o_orderkey").alias("api_ordinal"))
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("l_partkey") % 8 + 1).cast("int"))
    content = F.when(F.col("l_partkey") % 13 != 0, F.col("l_partkey"))
    items = li.select(
        F.col("l_orderkey").alias("module_id"), "l_partkey", F.col("l_linenumber").alias("position"), F.struct("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("api_ordinal"), kind.alias("type"), F.when(F.col("l_partkey") % 9 != 0, F.col("p_name")).alias("title"),
        content.alias("content_id"), F.concat(F.lit("P%2d"), content.cast("string")).alias("page_url"), F.concat(F.lit("https://lms.example/i/"), F.col("l_partkey").cast("string")).alias("html_url"), "p_name", "p_type", "p_brand", "p_size",
    )
    return plan.planned(_courses(spark, sf_dir), modules, items)


@query(
    f"""WITH {PLANNED} SELECT course_id, module_id, number, folder || '/' || basename || '.md' AS path, lower(type) || ':' || course_id || ':' || CASE type WHEN 'Page' THEN 'p-' || content_id WHEN 'Assignment' THEN CAST(content_id AS VARCHAR) WHEN 'Quiz' THEN CAST(content_id AS VARCHAR) WHEN 'Discussion' THEN CAST(content_id AS VARCHAR) END AS key FROM planned"""
)
def planned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses, their modules, their items: numbers, paths and the keys that links resolve by."""
    return _planned(spark, sf_dir).select("course_id", "module_id", "number", "path", "key")


def _of_kind(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    body = F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("<p>"), "p_type", F.lit("</p>")))
    due = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("day "), F.col("p_size").cast("string")))
    return _planned(spark, sf_dir).where(F.col("type") == kind).select("*", F.col("p_brand").alias("name"), body.alias("body"), due.alias("due_at"), due.alias("posted_at"), F.when(F.col("p_size") % 4 != 0, F.col("p_size") * 0.5).alias("points"))


_BODY = "CASE WHEN p_size % 5 = 0 THEN '{}' ELSE p_type END"
_DUE = "nullif(array_to_string(list_filter([CASE WHEN p_size % 3 = 0 THEN NULL ELSE '**Due:** day ' || p_size END, CASE WHEN p_size % 4 = 0 THEN NULL WHEN p_size % 2 = 0 THEN '**Points:** ' || CAST(p_size // 2 AS VARCHAR) ELSE '**Points:** ' || CAST(p_size * 0.5 AS DOUBLE) END], lambda x: x IS NOT NULL), '  |  '), '')"
_NOTE = ["module_id", "number", "issue", "note"]


@query(
    f"""WITH {PLANNED} SELECT module_id, number, content_id IS NULL AS issue, CASE WHEN content_id IS NOT NULL THEN {_sql_note(_ITEM, "coalesce(title, p_brand)", _BODY.format(notes.EMPTY_PAGE))} END AS note FROM planned WHERE type = 'Page'"""
)
def page_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes.page_notes(_of_kind(spark, sf_dir, "Page"), DATE).select(*_NOTE)


_RUBRIC = """criteria AS (SELECT l_partkey AS content_id, l_returnflag AS nth, count(*) AS points FROM lineitem GROUP BY ALL),
ratings AS (SELECT l_partkey AS content_id, l_returnflag AS criterion, string_agg('| ' || CAST(p AS BIGINT) || ' | ' || l_linestatus || '\\|x | ' || CASE WHEN l_linestatus = 'O' THEN 'long ' || l_partkey ELSE '' END || ' |', chr(10) ORDER BY l_linestatus) AS t FROM (SELECT l_partkey, l_returnflag, l_linestatus, max(l_quantity) AS p FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL) GROUP BY ALL),
rubrics AS (SELECT c.content_id, '## Rubric' || chr(10) || chr(10) || string_agg('### ' || CASE WHEN nth = 'R' THEN 'Criterion' ELSE nth END || ' (' || points || ' pts)' || coalesce(chr(10) || chr(10) || '| Points | Rating | Detail |' || chr(10) || '| --- | --- | --- |' || chr(10) || t, ''), chr(10) || chr(10) ORDER BY nth) AS rubric FROM criteria c LEFT JOIN ratings r ON c.content_id = r.content_id AND nth = criterion GROUP BY c.content_id)"""


@query(
    f"""WITH {PLANNED}, {_RUBRIC} SELECT module_id, number, planned.content_id IS NULL AS issue, CASE WHEN planned.content_id IS NOT NULL THEN {_sql_note(_ITEM, "coalesce(title, p_brand)", _DUE, _BODY.format(notes.NO_DESCRIPTION), "rubric")} END AS note FROM planned LEFT JOIN rubrics ON planned.content_id = rubrics.content_id WHERE type = 'Assignment'"""
)
def assignment_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments with rubrics: a part's return flags are criteria, their line states ratings."""
    li = table(spark, sf_dir, "lineitem")
    criteria = li.groupBy(F.col("l_partkey").alias("content_id"), F.col("l_returnflag").alias("nth")).agg(F.count("*").alias("points"))
    criteria = criteria.select("*", F.when(F.col("nth") != "R", F.col("nth")).alias("description"), F.lit(None).cast("string").alias("long_description"))
    ratings = li.where("l_returnflag <> 'N'").groupBy(F.col("l_partkey").alias("content_id"), F.col("l_returnflag").alias("criterion"), F.col("l_linestatus").alias("nth")).agg(F.max("l_quantity").alias("points"))
    long = F.when(F.col("nth") == "O", F.concat(F.lit("<p>long</p><p>"), F.col("content_id").cast("string"), F.lit("</p>")))
    ratings = ratings.select("*", F.concat("nth", F.lit("|x")).alias("description"), long.alias("long_description"))
    return notes.assignment_notes(_of_kind(spark, sf_dir, "Assignment"), notes.rubric_sections(criteria, ratings), DATE).select(*_NOTE)


_QUESTIONS = """asked AS (SELECT l_partkey AS content_id, l_linenumber AS id, count(*) AS points, string_agg(DISTINCT '- ' || l_linestatus, chr(10) ORDER BY '- ' || l_linestatus) AS a FROM lineitem GROUP BY ALL),
in_order AS (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY coalesce(CASE WHEN id = 3 THEN NULL ELSE id END, 0), id) AS n FROM asked),
questions AS (SELECT content_id, '## Questions' || chr(10) || chr(10) || string_agg('### ' || n || '. ' || CASE WHEN id % 2 = 1 THEN 'Question ' || n ELSE 'Line ' || id END || ' (' || points || ' pts)' || CASE WHEN id % 3 = 0 THEN '' ELSE ' _[multiple choice]_' END || CASE WHEN id % 4 = 0 THEN '' ELSE chr(10) || chr(10) || 'why ' || id END || chr(10) || chr(10) || a, chr(10) || chr(10) ORDER BY n) AS q FROM in_order GROUP BY content_id)"""


@query(
    f"""WITH {PLANNED}, {_QUESTIONS} SELECT module_id, number, planned.content_id IS NULL AS issue, CASE WHEN planned.content_id IS NOT NULL THEN {_sql_note(_ITEM, "coalesce(title, p_brand)", _DUE, _BODY.format(notes.NO_DESCRIPTION), "q")} END AS note FROM planned LEFT JOIN questions ON planned.content_id = questions.content_id WHERE type = 'Quiz'"""
)
def quiz_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quizzes with questions: a part's line numbers are questions, their line states answers."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("content_id"), F.col("l_linenumber").alias("id"), "l_linestatus")
    q = li.groupBy("content_id", "id").agg(F.count("*").alias("points"))
    q = q.select("*", F.when(F.col("id") != 3, F.col("id")).alias("position"), F.col("id").alias("api_ordinal"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("Line "), F.col("id").cast("string"))).alias("name"), F.when(F.col("id") % 3 != 0, F.lit("multiple_choice")).alias("kind"), F.when(F.col("id") % 4 != 0, F.concat(F.lit("<p>why "), F.col("id").cast("string"), F.lit("</p>"))).alias("body"))
    a = li.distinct().select("content_id", "id", F.col("l_linestatus").alias("nth"), F.when(F.col("l_linestatus") == "O", F.lit("<p>O</p>")).alias("html"), F.col("l_linestatus").alias("text"))
    return notes.quiz_notes(_of_kind(spark, sf_dir, "Quiz"), notes.question_sections(q, a), DATE).select(*_NOTE)


@query(
    f"""WITH {PLANNED} SELECT module_id, number, content_id IS NULL AS issue, CASE WHEN content_id IS NOT NULL THEN {_sql_note(_ITEM, "coalesce(title, p_brand)", "CASE WHEN p_size % 3 = 0 THEN NULL ELSE '**Posted:** day ' || p_size END", _BODY.format(notes.NO_PROMPT), f"'{notes.PROMPT_ONLY}'")} END AS note FROM planned WHERE type = 'Discussion'"""
)
def discussion_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notes.discussion_notes(_of_kind(spark, sf_dir, "Discussion"), DATE).select(*_NOTE)


_URL = "coalesce(CASE WHEN type = 'ExternalUrl' THEN 'https://Tool.example/' || l_partkey END, html_url)"


@query(
    f"""WITH {PLANNED}, p AS (SELECT *, {_URL} AS u FROM planned WHERE type IN ('ExternalUrl', 'ExternalTool')) SELECT module_id, number, false AS issue, {_sql_note(_ITEM[: -len(" || '---' || chr(10)")] + " || 'external_host: \"' || lower(regexp_extract(u, '//([^/]+)', 1)) || '\"' || chr(10) || '---' || chr(10)", "coalesce(title, 'External link')", "'[' || u || '](' || u || ')'", f"CASE WHEN type = 'ExternalTool' THEN '{notes.TOOL.replace(chr(39), chr(39) * 2)}' END")} AS note FROM p"""
)
def link_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.when(F.col("type") == "ExternalUrl", F.concat(F.lit("https://Tool.example/"), F.col("l_partkey").cast("string")))
    return notes.link_notes(_planned(spark, sf_dir).where(F.col("type").isin("ExternalUrl", "ExternalTool")).withColumn("external_url", url), DATE).select(*_NOTE)


@query(
    f"""WITH {PLANNED}, p AS (SELECT *, p_name || '.pdf' AS d FROM planned WHERE type = 'File') SELECT module_id, number, content_id IS NULL AS issue, CASE WHEN content_id IS NOT NULL AND p_size % 7 <> 0 THEN {_sql_note(_ITEM[: -len(" || '---' || chr(10)")] + " || 'source_file: \"' || printf('%02d', number) || ' - ' || d || '\"' || chr(10) || '---' || chr(10)", "d", "'> Extracted text from `' || d || '`.'", "p_type")} END AS note FROM p"""
)
def file_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files beside the text that a converter landed; some have none, so only the original stays."""
    d = _planned(spark, sf_dir).where("type = 'File'").withColumn("display_name", F.concat("p_name", F.lit(".pdf")))
    d = d.withColumn("original", F.concat(T.pad2(F.col("number")), F.lit(" - "), T.safe_name(F.col("display_name")))).withColumn("remark", F.concat(F.lit("Extracted text from `"), "display_name", F.lit("`."))).withColumn("extracted", F.when(F.col("p_size") % 7 != 0, F.col("p_type")))
    return notes.file_notes(d, DATE).select(*_NOTE)


@query(
    f"""WITH {PLANNED} SELECT courses.course_id, {_sql_note(_extra(("title", "'Syllabus'"), ("type", "'Syllabus'"), ("canvas_url", "'https://lms.example/courses/' || course_id || '/assignments/syllabus'")), "'Syllabus'", "c_name")} AS note FROM courses JOIN customer ON course_id = c_custkey WHERE c_custkey % 3 = 2"""
)
def syllabus_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("course_id") % 3 == 2, F.concat(F.lit("<p>"), "c_name", F.lit("</p>"))).when(F.col("course_id") % 3 == 1, F.lit(" "))
    c = _courses(spark, sf_dir).select("*", F.col("course_id").alias("id"), body.alias("syllabus_body"))
    return notes.syllabus_notes(c, "https://lms.example", DATE).select("course_id", "note")


@query(
    f"""WITH {PLANNED}, t AS (SELECT course_id, course_code, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS t0, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS posted, o_orderstatus FROM orders JOIN courses ON course_id = o_custkey),
n AS (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY coalesce(posted, ''), o_orderkey) AS n FROM t), m AS (SELECT *, coalesce(t0, 'Announcement ' || n) AS title FROM n)
SELECT o_orderkey, 'Announcements/' || printf('%02d', n) || ' - ' || title || '.md' AS path, {_sql_note(_extra(("title", "title"), ("type", "'Announcement'"), ("canvas_url", "'https://lms.example/a/' || o_orderkey"), ("posted", "posted")), "title", "CASE WHEN posted IS NOT NULL THEN '**Posted:** ' || posted END", f"CASE WHEN o_orderstatus = 'P' THEN '{notes.NO_BODY}' ELSE o_orderstatus END")} AS note FROM m"""
)
def announcement_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(_courses(spark, sf_dir), F.col("o_custkey") == F.col("course_id"))
    posted = F.when(F.col("o_orderkey") % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    topics = o.select("course_id", "course_code", "o_orderkey", F.col("o_orderkey").alias("api_ordinal"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("title"), posted.alias("posted_at"), F.concat(F.lit("https://lms.example/a/"), F.col("o_orderkey").cast("string")).alias("html_url"), F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("<p>"), "o_orderstatus", F.lit("</p>"))).alias("message"))
    return notes.announcement_notes(topics, DATE).select("o_orderkey", "path", "note")


@query(
    f"""WITH {PLANNED}, held AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 45), p AS (SELECT *, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END, 'Page%2d' || o_orderkey) AS title FROM orders JOIN courses ON course_id = o_custkey WHERE o_orderkey % 10 <> 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM held))
SELECT o_orderkey, 'Unfiled Pages/' || title || '.md' AS path, {_sql_note(_extra(("title", "title"), ("type", "'Page'"), ("canvas_url", "'https://lms.example/p/' || o_orderkey")), "title", f"'{notes.NOT_LINKED}'", f"CASE WHEN o_orderstatus = 'P' THEN '{notes.EMPTY_PAGE}' ELSE o_orderstatus END")} AS note FROM p"""
)
def unfiled_page_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that no module holds: slugs differ by case and escapes from those that modules name."""
    key = F.col("o_orderkey").cast("string")
    o = table(spark, sf_dir, "orders").join(_courses(spark, sf_dir), F.col("o_custkey") == F.col("course_id"))
    pages = o.select("course_id", "course_code", "o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.concat(F.lit("Page%2d"), key)).alias("url"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("title"), F.concat(F.lit("https://lms.example/p/"), key).alias("html_url"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("body"))
    held = table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct().join(table(spark, sf_dir, "orders"), "o_orderkey").select(F.col("o_custkey").alias("course_id"), F.concat(F.lit("pAGE-"), F.col("o_orderkey").cast("string")).alias("slug"))
    return notes.unfiled_page_notes(pages, held, DATE).select("o_orderkey", "path", "note")


@query(
    f"""WITH {PLANNED}, free AS (SELECT p_partkey, course_id, course_code, p_name || '.pdf' AS title, p_type, row_number() OVER (PARTITION BY course_id, lower(p_name) ORDER BY p_partkey) AS nth FROM part JOIN courses ON course_id = p_size WHERE p_partkey % 6 <> 0 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AND (p_size, lower(p_name)) NOT IN (SELECT (p_size, lower(p_name)) FROM part WHERE p_partkey % 10 = 1)), f AS (SELECT * FROM free WHERE nth = 1)
SELECT p_partkey, 'Unfiled Files/' || title AS path, CASE WHEN p_partkey % 7 <> 0 THEN {_sql_note(_extra(("title", "title"), ("type", "'File'"), ("source_file", "title")), "title", f"'{notes.NOT_ATTACHED}' || 'Extracted text from `x`.'", "p_type")} END AS note FROM f"""
)
def unfiled_file_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that no module holds and whose names their course has no file of yet, each name once."""
    p = table(spark, sf_dir, "part").withColumn("display_name", F.concat("p_name", F.lit(".pdf"))).withColumn("course_id", F.col("p_size").cast("long"))
    files = p.join(_courses(spark, sf_dir), "course_id").select("course_id", "course_code", F.col("p_partkey").alias("id"), "display_name", F.when(F.col("p_partkey") % 6 != 0, F.lit("u")).alias("url"), F.lit("Extracted text from `x`.").alias("remark"), F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("extracted"))
    held = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct().join(p, "p_partkey").select("course_id", F.col("p_partkey").alias("id"))
    there = p.where("p_partkey % 10 = 1").select("course_id", F.concat(F.lit("Unfiled Files/"), "display_name").alias("path"))
    return notes.unfiled_file_notes(files, held, there, DATE).select(F.col("id").alias("p_partkey"), "path", "note")


@query(
    """WITH f AS (SELECT DISTINCT conv_id % 50 AS id FROM conversations WHERE conv_id % 2 = 0), c AS (SELECT conv_id, turn, f.id AS got, conv_id % 50 AS want FROM conversations LEFT JOIN f ON f.id = conv_id % 50)
SELECT conv_id, turn, 'a ![x](' || CASE WHEN got IS NULL THEN '/courses/1/files/' || want || '/preview' ELSE 'assets/' || want || '.png' END || ' "T") b ![](' || CASE WHEN got IS NULL THEN 'https://LMS.example/files/' || want ELSE 'assets/' || want || '.png' END || ') ![y](https://else.example/files/' || want || ') [z](/files/' || want || ')' AS markdown, CAST(CASE WHEN got IS NULL THEN 0 ELSE 2 END AS BIGINT) AS localised FROM c"""
)
def localised_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images of files on the base host, with and without a course, point at local copies; others and links stay."""
    c = table(spark, sf_dir, "conversations")
    want = (F.col("conv_id") % 50).cast("string")
    md = F.concat(F.lit("a ![x](/courses/1/files/"), want, F.lit('/preview "T") b ![](https://LMS.example/files/'), want, F.lit(") ![y](https://else.example/files/"), want, F.lit(") [z](/files/"), want, F.lit(")"))
    files = c.where("conv_id % 2 = 0").select(want.alias("file_id"), F.lit("A picture.PNG").alias("name"))
    out = assets.localised(c.select(F.struct("conv_id", "turn").alias("note_id"), md.alias("markdown")), files, "lms.example")
    return out.select("note_id.conv_id", "note_id.turn", "markdown", "localised")


@query(
    """WITH m AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1) SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 AND coalesce(n % 3 = p_size % 3, false) AND p_partkey % 7 <> 0 AND (p_partkey % 2 = 0 OR p_partkey % 9 <> 0) THEN 'skipped' WHEN p_partkey % 5 = 0 THEN 'issue' ELSE 'fetch' END AS status FROM part LEFT JOIN m ON k = p_partkey"""
)
def file_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happens to each file: stamps against the manifest's, original and note in place, an address or none."""
    p = table(spark, sf_dir, "part")
    seen = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg((F.count("*") % 3).cast("string").alias("seen"))
    d = p.join(seen, "p_partkey", "left")
    k = F.col("p_partkey")
    status = rules.file_status(F.when(k % 4 != 0, (F.col("p_size") % 3).cast("string")), F.col("seen"), k % 7 != 0, k % 2 != 0, k % 9 != 0, F.when(k % 5 != 0, F.lit("u")))
    return d.select("p_partkey", status.alias("status"))


@query(
    """WITH l AS (SELECT p_size AS d, p_brand AS b, min(p_brand || '.' || p_partkey || '.pdf') AS name FROM part WHERE p_partkey % 3 = 0 GROUP BY 1, 2) SELECT p_partkey, name AS existing, CASE WHEN p_partkey % 11 = 0 THEN 'issue' WHEN name IS NOT NULL AND p_partkey % 2 = 0 THEN 'skipped' WHEN p_partkey % 5 = 0 THEN 'downloaded' WHEN name IS NOT NULL THEN 'kept' ELSE 'linked' END AS status FROM part LEFT JOIN l ON d = p_size AND b = p_brand"""
)
def share_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares against what earlier runs left in their folders: names that begin with the item's and a dot, notes apart."""
    p = table(spark, sf_dir, "part")
    names = F.array(F.concat("p_brand", F.lit("."), F.col("p_partkey").cast("string"), F.lit(".pdf")), F.concat("p_brand", F.lit(".0.md")))
    listing = p.where("p_partkey % 3 = 0").select(F.col("p_size").alias("dir"), F.explode(names).alias("name"))
    d = assets.existing(p.select("p_partkey", F.col("p_size").alias("dir"), F.col("p_brand").alias("base")), listing)
    k = F.col("p_partkey")
    return d.select("p_partkey", "existing", rules.share_status(F.when(k % 11 != 0, F.lit("u")), F.col("existing"), k % 5 == 0, k % 2 == 0).alias("status"))


@query("SELECT DISTINCT l_suppkey AS course_id, l_partkey AS file_id FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48)")
def linked_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that notes link to, each once per course, without those that are there."""
    li = table(spark, sf_dir, "lineitem")
    there = li.where("l_returnflag = 'R' and l_quantity > 48").select(F.col("l_partkey").alias("file_id"))
    wanted = li.select(F.col("l_suppkey").alias("course_id"), F.col("l_partkey").alias("file_id"))
    return rules.missing_only(wanted, there, ["course_id", "file_id"], there_by=["file_id"])


_MADE = "'---' || chr(10) || 'title: \"a\"' || chr(10) || 'pages: \"{}\"' || chr(10) || 'source_file: \"' || f || '\"' || chr(10) || '---' || chr(10) || '# ' || p_name || chr(10) || chr(10) || '> Kept. Extracted text from `{}`.' || chr(10) || chr(10) || {} || chr(10)"


@query(
    f"""WITH p AS (SELECT p_partkey, p_name, p_type, p_size, CASE WHEN p_partkey % 7 = 0 THEN 'other.pdf' ELSE p_name || '.pdf' END AS f FROM part),
s AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 OR p_partkey % 5 = 0 THEN 'skipped' WHEN p_partkey % 4 = 0 THEN 'failed' WHEN p_partkey % 3 = 0 THEN 'unchanged' ELSE 'updated' END AS status, CASE WHEN p_partkey % 5 = 0 THEN 'my own note' ELSE {_MADE.format("1", "old", "p_type")} END AS old, {_MADE.format("' || p_size || '", "new", "p_type || ' again'")} AS new FROM p)
SELECT p_partkey, status, CASE WHEN status = 'updated' THEN new ELSE old END AS new FROM s"""
)
def reconverted_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes made again from their originals: others' notes, lost texts and equal results are left alone."""
    p = table(spark, sf_dir, "part")
    k, own = F.col("p_partkey"), F.concat("p_name", F.lit(".pdf"))
    front = F.concat(F.lit('---\ntitle: "a"\npages: "1"\nsource_file: "'), F.when(k % 7 == 0, F.lit("other.pdf")).otherwise(own), F.lit('"\n---\n# '), "p_name", F.lit("\n\n> Kept. Extracted text from `old`.\r\n\n"), "p_type", F.lit("\n"))
    made = p.select("p_partkey", k.cast("string").alias("path"), F.concat("p_name", F.lit(".pdf")).alias("name"), F.when(k % 5 == 0, F.lit("my own note")).otherwise(front).alias("note"), "p_type", "p_size")
    same = k % 3 == 0
    listing = made.select("path", F.concat("name", F.lit("")).alias("original"), "note", "p_partkey")
    texts = made.where("p_partkey % 4 <> 0").select(F.col("p_partkey"), F.when(same, F.lit("Extracted text from `old`.")).otherwise(F.lit("Extracted text from `new`.")).alias("remark"), F.when(same, F.col("p_type")).otherwise(F.concat("p_type", F.lit(" again"))).alias("text"), F.when(same, 1).otherwise(F.col("p_size")).alias("pages"))
    by_note = rules.reconverted(listing.drop("p_partkey"), texts.select(F.col("p_partkey").cast("string").alias("path"), "remark", "text", "pages"), key="path")
    return by_note.select(F.col("path").cast("long").alias("p_partkey"), "status", "new")


@query(
    """WITH s AS (SELECT CASE WHEN p_partkey % 7 = 0 OR p_partkey % 5 = 0 THEN 'skipped' WHEN p_partkey % 4 = 0 THEN 'failed' WHEN p_partkey % 3 = 0 THEN 'unchanged' ELSE 'updated' END AS status FROM part) SELECT status, count(*) AS n FROM s GROUP BY 1"""
)
def reconvert_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconverted_notes(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


@query(
    f"""WITH {PLANNED}, i AS (SELECT course_id, coalesce(CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE type END, '(untyped)') AS type, coalesce(nullif(lower(regexp_extract(title, '(?i)\\.([a-z0-9]{{1,6}})$', 1)), ''), '(no extension)') AS ext, CASE WHEN l_partkey % 3 = 0 THEN '(no url)' WHEN l_partkey % 3 = 1 THEN '(unparseable)' ELSE 'tool.example' END AS host FROM (SELECT course_id, type, l_partkey, CASE WHEN l_partkey % 4 = 0 THEN title || '.PDF' ELSE title END AS title FROM planned)),
r AS (SELECT 'type' AS what, type AS label, course_id FROM i UNION ALL SELECT 'extension', ext, course_id FROM i WHERE type = 'File' UNION ALL SELECT 'host', host, course_id FROM i WHERE type IN ('ExternalUrl', 'ExternalTool'))
SELECT what, coalesce(CAST(course_id AS VARCHAR), '(all)') AS course, label, count(*) AS n FROM r GROUP BY GROUPING SETS ((what, label, course_id), (what, label))"""
)
def course_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by type, files by extension, external links by host: per course and in all."""
    k = F.col("l_partkey")
    i = _planned(spark, sf_dir).select("course_id", F.when(k % 17 != 0, F.col("type")).alias("type"), F.when(k % 4 == 0, F.concat("title", F.lit(".PDF"))).otherwise(F.col("title")).alias("title"), F.when(k % 3 == 1, F.lit("not a url")).when(k % 3 == 2, F.lit("https://Tool.example/x")).alias("external_url"))
    return tally.course_inventory(i, "course_id")


@query(
    """SELECT course, metric, CAST(sum(v) AS BIGINT) AS n FROM (SELECT coalesce(event_type, '(all)') AS course, unnest(['written', 'skipped', 'issues', 'announcements', 'unfiled']) AS metric, unnest([w, s, i, a, u]) AS v FROM (SELECT event_type, count(*) FILTER (event_id % 2 = 0 AND value > 10) AS w, count(*) FILTER (event_id % 2 = 0 AND value <= 10) AS s, count(*) FILTER (event_id % 26 = 0) AS i, count(*) FILTER (event_id % 2 = 1 AND user_id % 3 = 0) AS a, count(*) FILTER (event_id % 2 = 1 AND user_id % 3 = 1) AS u FROM events GROUP BY ROLLUP (event_type))) WHERE v <> 0 OR course = '(all)' GROUP BY ALL"""
)
def summary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of modules and extras together: a course shows only what moved, the total shows all."""
    e = table(spark, sf_dir, "events")
    main = tally.tally(e.where("event_id % 2 = 0"), "event_type", {"written": F.col("value") > 10, "skipped": F.col("value") <= 10, "issues": F.col("event_id") % 26 == 0})
    extra = tally.tally(e.where("event_id % 2 = 1"), "event_type", {"announcements": F.col("user_id") % 3 == 0, "unfiled": F.col("user_id") % 3 == 1})
    return tally.summary(tally.merged([main, extra], "event_type"), "event_type").select(F.col("event_type").alias("course"), "metric", "n")


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN 'off' WHEN event_id % 3 = 0 THEN 'done' WHEN event_id % 3 = 1 THEN 'disabled' ELSE 'error' END AS outcome FROM events"""
)
def section_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each section of each course by itself: switched off, done, not offered by the service, or failed; one failure stops no other."""
    i = F.col("event_id")
    section = F.element_at(F.array(*[F.lit(s) for s in tally.SECTIONS]), (i % 4 + 1).cast("int"))
    error = F.when(i % 3 == 1, F.lit("GET /pages: HTTP 404")).when(i % 3 == 2, F.lit("HTTP 500"))
    return table(spark, sf_dir, "events").select("event_id", tally.section_outcome(section, error).alias("outcome"))


@query(
    """WITH m AS (SELECT c_custkey, c_name, c_mktsegment, c_custkey % 97 = 0 OR c_acctbal > 5000 AS keep FROM customer) SELECT c_custkey, keep, CAST(row_number() OVER (ORDER BY keep DESC, c_custkey) AS INTEGER) AS place FROM m"""
)
def course_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All courses, those that are kept first."""
    c = table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") % 97 == 0) | (F.col("c_acctbal") > 5000)).alias("keep"))
    return plan.listed(c, F.col("keep"), F.col("c_custkey")).select("c_custkey", "keep", F.col("place").cast("int").alias("place"))


@query(
    r"""SELECT doc_id, md5(regexp_replace(chr(65279) || 'a' || chr(13) || chr(10) || chr(12) || text || chr(127), '[\x00-\x08\x0B-\x1F\x7F\x{FEFF}]', '', 'g')) AS stripped_md5 FROM documents"""
)
def stripped_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.noise_stripped(F.concat(F.lit("﻿a\r\n\f"), "text", F.lit("\x7f"))).cast("binary")).alias("stripped_md5"))


@query(
    """SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN '_(empty sheet)_' ELSE '| ' || max(l_linenumber) || ' |' || chr(10) || '| --- |' END AS md FROM lineitem GROUP BY l_orderkey"""
)
def sheet_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_linenumber").cast("string").alias("n"))
    return g.select("l_orderkey", T.sheet_table(F.array(F.array(F.when(F.col("l_orderkey") % 3 == 0, F.lit(" \n ")).otherwise(F.col("n"))))).alias("md"))


@query("SELECT l_suppkey AS course_id, lower(l_returnflag || l_linestatus) AS slug, max(l_orderkey) AS last_seen FROM lineitem GROUP BY 1, 2")
def distinct_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of a course to pages, without case: the last one counts."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("course_id"), F.concat("l_returnflag", "l_linestatus").alias("slug"), F.col("l_orderkey").alias("at"))
    return plan.last_by_key(li, ["course_id", F.lower("slug").alias("slug")], F.col("at"), F.col("at").alias("last_seen"))


@query(
    f"""WITH {PLANNED} SELECT course_id, count(DISTINCT module_id) AS modules, count(*) AS items, count(*) FILTER (type IN ('Page', 'Assignment', 'Quiz', 'Discussion') AND content_id IS NULL) AS issues FROM planned GROUP BY 1"""
)
def plan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run is about to do in each course, and which items lack their identifier."""
    issue = F.col("type").isin("Page", "Assignment", "Quiz", "Discussion") & F.col("content_id").isNull()
    return _planned(spark, sf_dir).groupBy("course_id").agg(F.count_distinct("module_id").alias("modules"), F.count("*").alias("items"), F.count_if(issue).alias("issues"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(event_id % 100 * 1000 AS BIGINT) WHEN 1 THEN CAST(greatest(event_id % 50 - 10, 0) * 1000 AS BIGINT) END AS wait_ms FROM events")
def retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retry-After headers: seconds, HTTP dates (some past), and what is neither."""
    i = F.col("event_id")
    date = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + i % 50), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    header = F.when(i % 3 == 0, (i % 100).cast("string")).when(i % 3 == 1, date).otherwise(F.lit("soon"))
    return table(spark, sf_dir, "events").select("event_id", tally.retry_after_ms(header, F.timestamp_seconds(F.lit(1_700_000_010))).alias("wait_ms"))
