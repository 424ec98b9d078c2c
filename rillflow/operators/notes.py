"""Notes: what each kind of content becomes. Every function takes planned rows and returns them with a ``note`` column.

Bodies are HTML columns; they become Markdown in one Arrow pass. Items without the identifier that
their kind needs are kept with ``issue`` set and no note, so a caller can count them and hold back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.functions.markdown import html_to_markdown

# What a note says where it has nothing to say, and the remarks of some kinds.
EMPTY_PAGE = "_(empty page)_"
NO_DESCRIPTION = "_(no description)_"
NO_PROMPT = "_(no prompt text)_"
NO_BODY = "_(no body)_"
NO_LINK = "_(no link recorded on this item)_"
PROMPT_ONLY = "> Topic prompt only — replies are not scraped."
TOOL = "> External tool (LTI) — content lives outside Canvas and isn't scraped."
NOT_LINKED = "> Not linked from any module."
NOT_ATTACHED = "> Not attached to any module. "


def item_fields(scraped: str) -> list[tuple[str, Column]]:
    """Front matter of an item's note; ``scraped`` is the run's date, so that a run is repeatable."""
    c = F.col
    return [("title", c("title")), ("course", c("course_code")), ("module", c("module_name")), ("type", c("type")), ("canvas_url", c("html_url")), ("scraped", F.lit(scraped))]


def extra_fields(scraped: str, *fields: tuple[str, Column]) -> list[tuple[str, Column]]:
    """Front matter of a note outside modules: course and date come first."""
    return [("course", F.col("course_code")), ("scraped", F.lit(scraped)), *fields]


def written(fields: Sequence[tuple[str, Column]], heading: Column, *blocks: Column) -> Column:
    """Front matter, heading, and the blocks that aren't null, a blank line between each; ends in a line break."""
    return F.concat(T.frontmatter(fields), F.lit("# "), F.array_join(F.array_compact(F.array(heading, *blocks)), "\n\n"), F.lit("\n"))


def finished(bodies: DataFrame, files: DataFrame, index: DataFrame | None, base_host: str, *, id_col: str = "note_id", body_col: str = "body", folder_col: str = "folder") -> DataFrame:
    """HTML bodies as they stand in notes: Markdown, known images local, and links to known notes made wikilinks.

    ``files``: ``file_id, name``; ``index``: ``key, basename, full_path``, or None where links stay as they are
    (announcements and the like). Returns id, ``markdown``, ``localised``, ``rewritten``, ``unresolved``. A null
    or blank body is an empty text.
    """
    from rillflow.operators import assets, links

    md = bodies.select(F.col(id_col).alias("note_id"), F.col(folder_col).alias("folder"), html_to_markdown(F.col(body_col)).alias("markdown"))
    local = assets.localised(md, files, base_host)
    if index is None:
        none = F.array().cast("array<string>")
        return local.select(F.col("note_id").alias(id_col), "markdown", "localised", F.lit(0).cast("long").alias("rewritten"), none.alias("unresolved"))
    done = links.rewritten(local.drop("localised").join(md.select("note_id", "folder"), "note_id"), index, base_host)
    return done.join(local.select("note_id", "localised"), "note_id").select(F.col("note_id").alias(id_col), "markdown", "localised", "rewritten", "unresolved")


def _or(md: Column, otherwise: str) -> Column:
    return F.when(md == "", F.lit(otherwise)).otherwise(md)


def _held(missing: Column, note: Column) -> list[Column]:
    issue = F.coalesce(missing, F.lit(True))
    return [issue.alias("issue"), F.when(~issue, note).alias("note")]


def _no(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("")) == ""


def page_notes(items: DataFrame, scraped: str) -> DataFrame:
    """Pages: heading, then the body. ``items``: planned items with ``page_url``, ``name``, ``body`` (HTML)."""
    d = items.withColumn("md", html_to_markdown(F.col("body")))
    note = written(item_fields(scraped), F.coalesce("title", "name", F.lit("Page")), _or(F.col("md"), EMPTY_PAGE))
    return d.select("*", *_held(_no(F.col("page_url")), note)).drop("md")


def _due(df: DataFrame) -> Column:
    """The line of due date and points, null where an item has neither."""
    line = T.meta_line([("Due", F.nullif(F.col("due_at"), F.lit(""))), ("Points", T.points(F.col("points")))])
    return F.nullif(line, F.lit(""))


def assignment_notes(items: DataFrame, rubrics: DataFrame, scraped: str) -> DataFrame:
    """Assignments: due date and points, description, rubric. ``rubrics``: ``content_id, rubric`` of ``rubric_sections``."""
    d = items.withColumn("md", html_to_markdown(F.col("body"))).join(rubrics, "content_id", "left")
    note = written(item_fields(scraped), F.coalesce("title", "name", F.lit("Assignment")), _due(d), _or(F.col("md"), NO_DESCRIPTION), F.col("rubric"))
    return d.select("*", *_held(_no(F.col("content_id")), note)).drop("md")


def quiz_notes(items: DataFrame, questions: DataFrame, scraped: str) -> DataFrame:
    """Quizzes: due date and points, description, questions. ``questions``: ``content_id, questions`` of ``question_sections``."""
    d = items.withColumn("md", html_to_markdown(F.col("body"))).join(questions, "content_id", "left")
    note = written(item_fields(scraped), F.coalesce("title", "name", F.lit("Quiz")), _due(d), _or(F.col("md"), NO_DESCRIPTION), F.col("questions"))
    return d.select("*", *_held(_no(F.col("content_id")), note)).drop("md")


def discussion_notes(items: DataFrame, scraped: str) -> DataFrame:
    """Discussions: when it was posted and the prompt."""
    d = items.withColumn("md", html_to_markdown(F.col("body")))
    posted = F.when(~_no(F.col("posted_at")), F.concat(F.lit("**Posted:** "), "posted_at"))
    note = written(item_fields(scraped), F.coalesce("title", "name", F.lit("Discussion")), posted, _or(F.col("md"), NO_PROMPT), F.lit(PROMPT_ONLY))
    return d.select("*", *_held(_no(F.col("content_id")), note)).drop("md")


def link_notes(items: DataFrame, scraped: str) -> DataFrame:
    """External links and tools: the address that the item records, else its own page."""
    url = F.coalesce("external_url", "html_url", F.lit(""))
    link = F.when(url == "", F.lit(NO_LINK)).otherwise(F.concat(F.lit("["), url, F.lit("]("), url, F.lit(")")))
    note = written([*item_fields(scraped), ("external_host", T.host(url))], F.coalesce("title", F.lit("External link")), link, F.when(F.col("type") == "ExternalTool", F.lit(TOOL)))
    return items.select("*", F.lit(False).alias("issue"), note.alias("note"))


def file_notes(files: DataFrame, scraped: str) -> DataFrame:
    """Files whose text was extracted: ``display_name``, ``original``, ``remark`` and ``extracted`` (null: no converter, no note)."""
    note = written([*item_fields(scraped), ("source_file", F.col("original"))], T.safe_name(F.col("display_name")), F.concat(F.lit("> "), "remark"), F.col("extracted"))
    return files.select("*", *_held(_no(F.col("content_id")), F.when(F.col("extracted").isNotNull(), note)))


def syllabus_notes(courses: DataFrame, base_url: str, scraped: str) -> DataFrame:
    """One note per course with a syllabus; ``courses``: ``id, course_code, syllabus_body``. Others are left out."""
    d = courses.where(F.trim("syllabus_body") != "").withColumn("md", html_to_markdown(F.col("syllabus_body"))).where("md <> ''")
    url = F.concat(F.lit(base_url), F.lit("/courses/"), F.col("id").cast("string"), F.lit("/assignments/syllabus"))
    fields = extra_fields(scraped, ("title", F.lit("Syllabus")), ("type", F.lit("Syllabus")), ("canvas_url", url))
    return d.select("*", written(fields, F.lit("Syllabus"), F.col("md")).alias("note")).drop("md")


def announcement_notes(topics: DataFrame, scraped: str) -> DataFrame:
    """One note per announcement, ``number`` and ``path`` with it: the oldest of a course is its first.

    ``topics``: ``course_id, course_code, api_ordinal, title, posted_at, html_url, message``.
    """
    from rillflow.operators.plan import numbered

    d = numbered(topics.withColumn("at", F.coalesce("posted_at", F.lit(""))), ["course_id"], F.lit(0), F.col("at"), F.col("api_ordinal"))
    d = d.withColumn("md", html_to_markdown(F.col("message"))).withColumn("title", F.coalesce("title", F.concat(F.lit("Announcement "), F.col("number").cast("string"))))
    fields = extra_fields(scraped, ("title", F.col("title")), ("type", F.lit("Announcement")), ("canvas_url", F.col("html_url")), ("posted", F.col("posted_at")))
    posted = F.when(F.col("at") != "", F.concat(F.lit("**Posted:** "), "at"))
    path = F.concat(F.lit("Announcements/"), T.pad2(F.col("number")), F.lit(" - "), T.safe_name(F.col("title")), F.lit(".md"))
    return d.select("*", path.alias("path"), written(fields, F.col("title"), posted, _or(F.col("md"), NO_BODY)).alias("note")).drop("md", "at")


def unfiled_page_notes(pages: DataFrame, in_modules: DataFrame, scraped: str) -> DataFrame:
    """Pages that no module holds. ``pages``: ``course_id, course_code, url, title, html_url, body``; ``in_modules``: ``course_id, slug``.

    Slugs are compared decoded and without case. A page without a slug is left out.
    """
    from rillflow.functions.links import decoded_slug

    held = in_modules.select("course_id", decoded_slug(F.col("slug")).alias("slug")).distinct()
    d = pages.where(~_no(F.col("url"))).withColumn("slug", decoded_slug(F.col("url"))).join(held, ["course_id", "slug"], "left_anti")
    title = F.coalesce("title", "url")
    d = d.withColumn("md", html_to_markdown(F.col("body")))
    fields = extra_fields(scraped, ("title", title), ("type", F.lit("Page")), ("canvas_url", F.col("html_url")))
    return d.select("*", F.concat(F.lit("Unfiled Pages/"), T.safe_name(title), F.lit(".md")).alias("path"), written(fields, title, F.lit(NOT_LINKED), _or(F.col("md"), EMPTY_PAGE)).alias("note")).drop("md", "slug")


def unfiled_file_notes(files: DataFrame, in_modules: DataFrame, present: DataFrame, scraped: str, *last: Column) -> DataFrame:
    """Files of a course's file area that no module holds and whose path isn't taken; a note where text was extracted.

    ``files``: ``course_id, course_code, id, display_name, url, remark, extracted``; ``in_modules``:
    ``course_id, id``; ``present``: ``course_id, path``. Paths are compared without case. Of several new
    files with one path the first by ``last`` (else by id) takes it and the others are left out, as
    are files without an address.
    """
    name = T.safe_name(F.col("display_name"))
    d = files.where(~_no(F.col("url"))).withColumn("path", F.concat(F.lit("Unfiled Files/"), name)).withColumn("place", F.lower("path"))
    there = present.select("course_id", F.lower("path").alias("place")).distinct()
    d = d.join(in_modules.select("course_id", "id").distinct(), ["course_id", "id"], "left_anti").join(there, ["course_id", "place"], "left_anti")
    first = F.min_by(F.struct(*[c for c in d.columns if c not in ("course_id", "place")]), F.struct(*(last or (F.col("id"),)))).alias("x")
    d = d.groupBy("course_id", "place").agg(first).select("course_id", "x.*")
    fields = extra_fields(scraped, ("title", F.col("display_name")), ("type", F.lit("File")), ("source_file", name))
    note = written(fields, name, F.concat(F.lit(NOT_ATTACHED), "remark"), F.col("extracted"))
    return d.select("*", F.when(F.col("extracted").isNotNull(), note).alias("note"))


def _in_order(order: str, part: Column, into: str, sep: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), part.alias("s")))), lambda x: x["s"]), sep).alias(into)


def rubric_sections(criteria: DataFrame, ratings: DataFrame) -> DataFrame:
    """``content_id, rubric``: a section per criterion, in order, with a table of its ratings.

    ``criteria``: ``content_id, nth, description, points, long_description``; ``ratings``:
    ``content_id, criterion, nth, description, points, long_description`` (``criterion`` is a criterion's nth).
    """
    bars = lambda c: F.replace(c, F.lit("|"), F.lit("\\|"))
    long = F.regexp_replace(html_to_markdown(F.col("long_description")), r"\n+", " ")
    said = F.coalesce("description", F.lit(""))
    row = F.concat(F.lit("| "), F.coalesce(T.points(F.col("points")), F.lit("")), F.lit(" | "), bars(said), F.lit(" | "), bars(F.col("long")), F.lit(" |"))
    rows = ratings.withColumn("long", F.coalesce(long, F.lit(""))).withColumn("row", row)
    tables = rows.groupBy("content_id", F.col("criterion").alias("nth")).agg(_in_order("nth", F.col("row"), "rows", "\n"))
    head = F.concat(F.lit("### "), F.coalesce("description", F.lit("Criterion")), F.coalesce(F.concat(F.lit(" ("), T.points(F.col("points")), F.lit(" pts)")), F.lit("")))
    table = F.concat(F.lit("| Points | Rating | Detail |\n| --- | --- | --- |\n"), "rows")
    each = criteria.withColumn("long", F.nullif(html_to_markdown(F.col("long_description")), F.lit(""))).join(tables, ["content_id", "nth"], "left")
    each = each.withColumn("part", F.array_join(F.array_compact(F.array(head, F.col("long"), table)), "\n\n"))
    return each.groupBy("content_id").agg(_in_order("nth", F.col("part"), "rubric", "\n\n")).withColumn("rubric", F.concat(F.lit("## Rubric\n\n"), "rubric"))


def question_sections(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """``content_id, questions, n_questions``: numbered by position, each with its text and answers.

    ``questions``: ``content_id, id, position, api_ordinal, name, kind, points, body``; ``answers``:
    ``content_id, id, nth, html, text`` (``id`` is a question's). Answers without any text are left out.
    """
    from rillflow.operators.plan import numbered

    answer = F.coalesce(F.nullif(html_to_markdown(F.col("html")), F.lit("")), F.nullif(F.col("text"), F.lit("")))
    said = answers.withColumn("answer", answer).where("answer is not null").withColumn("line", F.concat(F.lit("- "), F.regexp_replace("answer", r"\n+", " ")))
    listed = said.groupBy("content_id", "id").agg(_in_order("nth", F.col("line"), "answers", "\n"))
    q = numbered(questions, ["content_id"], F.col("position"), F.col("api_ordinal")).join(listed, ["content_id", "id"], "left")
    name = F.coalesce("name", F.concat(F.lit("Question "), F.col("number").cast("string")))
    worth = F.coalesce(F.concat(F.lit(" ("), T.points(F.col("points")), F.lit(" pts)")), F.lit(""))
    kind = F.when(~_no(F.col("kind")), F.concat(F.lit(" _["), F.replace("kind", F.lit("_"), F.lit(" ")), F.lit("]_"))).otherwise(F.lit(""))
    head = F.concat(F.lit("### "), F.col("number").cast("string"), F.lit(". "), name, worth, kind)
    part = F.array_join(F.array_compact(F.array(head, F.nullif(html_to_markdown(F.col("body")), F.lit("")), F.col("answers"))), "\n\n")
    each = q.withColumn("part", part)
    return each.groupBy("content_id").agg(_in_order("number", F.col("part"), "questions", "\n\n"), F.count("*").alias("n_questions")).withColumn("questions", F.concat(F.lit("## Questions\n\n"), "questions"))
