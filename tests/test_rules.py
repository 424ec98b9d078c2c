import time

from pyspark.sql import functions as F

from rillflow.functions import text as T
from rillflow.functions.markdown import to_markdown
from rillflow.operators import links, rules, tally


def test_long_table_is_made_once(spark):
    rows = [[str(i), "a|b", None] for i in range(2000)]
    df = spark.createDataFrame([(rows,)], "rows array<array<string>>")
    start = time.time()
    md = df.select(T.markdown_table(F.col("rows")).alias("md")).first().md
    assert time.time() - start < 20 and md.count("\n") == 2000 and md.split("\n")[2] == "| 1 | a\\|b |  |"
    none = spark.createDataFrame([([],), ([[" "]],), (None,)], "rows array<array<string>>")
    assert [r[0] for r in none.select(T.sheet_table(F.col("rows"))).collect()] == ["_(empty sheet)_"] * 3


def test_odd_cells_and_marks():
    table = "<table><tr><td colspan='{}'>a</td></tr><tr><td>b</td></tr></table>"
    assert to_markdown(table.format("²")).startswith("| a |\n| --- |")
    assert to_markdown(table.format("20000000")).split("\n")[0].count("|") == 1001
    assert to_markdown("<ul><li>a\x01b\x02c\x03</ul>") == "- abc"


def test_retry_after_of_nothing(spark):
    df = spark.createDataFrame([("5",), ("x",), (None,)], "h string")
    assert [r[0] for r in df.select(tally.retry_after_ms(F.col("h"), F.timestamp_seconds(F.lit(0)))).collect()] == [5000, None, None]


def test_removal_is_opt_in():
    assert rules.removes(False, True, False) and rules.removes(True, False, False)
    assert not rules.removes(True, True, True) and not rules.removes(False, False, False)


def test_rows_of_tables_over_links(spark):
    md = "| [a](/courses/1/pages/p) | [b](/courses/1/pages/p) |\n[c](/courses/1/pages/p) |\nx | [d](/courses/1/pages/p)\n[e](/courses/1/pages/p)"
    notes = spark.createDataFrame([(1, md, "/n")], "note_id long, markdown string, folder string")
    index = spark.createDataFrame([("page:1:p", "01 - P", "/n/01 - P.md")], "key string, basename string, full_path string")
    got = links.rewritten(notes, index, "lms.example").first()
    assert got.rewritten == 5 and got.markdown == "| [[01 - P\\|a]] | [[01 - P\\|b]] |\n[[01 - P|c]] |\nx | [[01 - P|d]]\n[[01 - P|e]]"
