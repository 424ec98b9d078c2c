import random

import pytest
from pyspark.sql import functions as F

from rillflow.functions import links as L
from rillflow.functions import text as T
from rillflow.functions.markdown import to_markdown
from rillflow.operators import links, plan, state, words


def one(spark, column, **values):
    schema = ", ".join(f"{k} {v[0]}" for k, v in values.items())
    return spark.createDataFrame([tuple(v[1] for v in values.values())], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "f, given, want",
    [
        (T.safe_name, " a<b>:c?\t d ", "abc d"),
        (T.safe_name, None, "untitled"),
        (T.safe_name, "x" * 130, "x" * 120),
        (T.extension, "Notes.PPTX", "pptx"),
        (T.extension, "no", ""),
        (T.host, "https://A.Example:8/x", "a.example"),
        (T.clean_text, "a\r\nb\x00\n\n\n\nc\f ", "a\nb\n\nc"),
        (T.noise_count, "a\r\f\x7f\t\n", 3),
        (T.mojibake_repaired, "it‚Äôs ‚Äúx‚Äù", "it’s “x”"),
        (T.xml_decoded, "&amp;lt; &lt;b&gt;", "&lt; <b>"),
        (T.escaped_cell, " a | b\r\n\n \\| c ", "a \\| b<br>\\| c"),
        (T.guarded_json, "while(1);[1]", "[1]"),
        (T.next_page, '<a>; rel="first", <b>; rel="next"', "b"),
        (T.next_page, '<a>; rel="last"', None),
        (T.share_extension, "https://x.sharepoint.com/:P:/g", "pptx"),
        (T.disposition_name, "attachment; filename*=UTF-8''a%20b%2Bc.pdf", "a b+c.pdf"),
        (T.disposition_name, 'inline; filename="q.doc"', "q.doc"),
        (L.decoded_slug, "A%20b+c", "a b+c"),
        (L.decoded_slug, "bad%zz", "bad%zz"),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f(F.col("a")), a=("string", given)) == want


def test_numbers_and_folders(spark):
    assert [one(spark, T.pad2(F.col("a")), a=("int", n)) for n in (7, 100)] == ["07", "100"]
    assert one(spark, T.folder_name(F.col("a"), F.col("b"), {"X 1": "own"}), a=("string", "X 1"), b=("int", 3)) == "own"
    assert one(spark, T.folder_name(F.col("a"), F.col("b")), a=("string", "SOFTENG 761"), b=("int", 3)) == "SOFTENG-761"
    assert one(spark, T.relative_path(F.col("a"), F.col("b")), a=("string", "/r/c/m1"), b=("string", "/r/c/m2/x.md")) == "../m2/x.md"
    assert one(spark, T.relative_path(F.col("a"), F.col("b")), a=("string", "/r/c"), b=("string", "/r/c/x.md")) == "./x.md"


@pytest.mark.parametrize(
    "url, want",
    [
        ("/courses/1/pages/Week%201", "page:1:week 1"),
        ("https://LMS.example/courses/1/modules/items/7?x=1", "item:1:7"),
        ("https://lms.example/courses/1/files/9/download#y", "file:1:9"),
        ("https://other.example/courses/1/files/9", None),
        ("mailto:/courses/1/files/9", None),
        ("/courses/1", None),
    ],
)
def test_url_keys(spark, url, want):
    assert one(spark, L.url_key(F.col("a"), "lms.example"), a=("string", url)) == want


NOTES = [
    ("n1", "[13](/courses/1/pages/agile) and [Agile](/courses/1/pages/agile \"T\"), ![i](/courses/1/files/2)", "/r/m"),
    ("n2", "| [x](/courses/1/pages/agile) | [13 - Agile](/courses/1/pages/agile) |", "/r/m"),
    ("n3", "[![p](q.png) card](/courses/1/pages/agile \"T\") [f](/courses/1/files/5) [](/courses/1/pages/agile)", "/r/n"),
    ("n4", "no links", "/r/m"),
    ("n5", None, "/r/m"),
    ("n6", "[f](/courses/1/files/5)", "/r/m"),
]


def test_rewrite_and_again(spark):
    notes = spark.createDataFrame(NOTES, "note_id string, markdown string, folder string")
    index = spark.createDataFrame([("page:1:agile", "13 - Agile", "/r/m/13 - Agile.md")], "key string, basename string, full_path string")
    out = {r.note_id: r for r in links.rewritten(notes, index, "lms.example").collect()}
    assert out["n1"].markdown == "[[13 - Agile|13]] and [[13 - Agile|Agile]], ![i](/courses/1/files/2)" and out["n1"].rewritten == 2
    assert out["n2"].markdown == "| [[13 - Agile\\|x]] | [[13 - Agile]] |"
    assert out["n3"].markdown == '[![p](q.png) card](<../m/13 - Agile.md> "T") [f](/courses/1/files/5) [[13 - Agile]]'
    assert out["n3"].unresolved == ["file:1:5"] == out["n6"].unresolved and out["n4"].markdown == "no links" and out["n5"].markdown is None
    again = spark.createDataFrame([(k, v.markdown, "/r/m") for k, v in out.items()], "note_id string, markdown string, folder string")
    assert {r.note_id: r.markdown for r in links.rewritten(again, index, "lms.example").collect()} == {k: v.markdown for k, v in out.items()}


def test_follow_rounds(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(6)] + [(2, 0)], "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    assert {(r.node, r.round) for r in links.followed(start, edges).collect()} == {(0, 0), (1, 1), (2, 2), (3, 3)}


def test_plan_and_state(spark):
    assert one(spark, plan.active_roles(F.col("a")), a=("array<struct<type:string,role:string,enrollment_state:string>>", [("Student", None, None), (None, None, "active"), ("Teacher", None, "deleted")])) == ["student", "?"]
    days = [("2024-01-01", None, True), (None, None, False), (None, "2023-01-01", False), ("2024-02-02", None, True)]
    for s, e, want in days:
        assert one(spark, plan.is_current(F.col("s"), F.col("e"), F.lit("2024-02-02")), s=("string", s), e=("string", e)) is want
    now = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "")], "id int, updated_at string")
    old = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "")], "id int, updated_at string")
    assert {r.id: r.skip for r in state.compared(now, old, ["id"]).collect()} == {1: True, 2: False, 3: False, 4: False}
    assert sorted(map(tuple, state.upserted(old, now.where("id = 2"), ["id"]).collect()), key=str) == [(1, "a"), (2, "b"), (3, None), (4, "")]


def test_ligatures(spark):
    d = spark.createDataFrame([("section", 10), ("after", 10), ("attention", 10), ("alter", 5)], "word string, tier int")
    texts = spark.createDataFrame([(1, "A sec\ufffdon, a\ufffder. \ufffd \ufffdzq"), (2, "a plain section")], "id int, text string")
    got = {r.id: (r.text, r.marked) for r in words.repaired(texts, d, "id", "text").collect()}
    assert got == {1: ("A section, after. \ufffd \ufffdzq", 2), 2: ("a plain section", 0)}


@pytest.mark.parametrize(
    "html, want",
    [
        ("<h2>A&amp;B</h2><p>x <b>y</b> <i>z</i><br>w</p>", "## A&B\n\nx **y** *z*  \nw"),
        ("<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul><ol><li>d</li><li>e</li></ol>", "- a\n    - b\n- c\n\n1. d\n2. e"),
        ("<table><tr><td colspan=2>a|b</td></tr><tr><td>c</td><td>d<br>e</td></tr></table>", "| a\\|b |  |\n| --- | --- |\n| c | d<br>e |"),
        ('<a href="/x" title="T">l*k</a><img src="i.png" alt="p"><script>s</script><span class="cdbData">{}</span><div style="display:none">h</div>', '[l\\*k](/x "T")![p](i.png)'),
        ("<pre>a\n  b</pre><blockquote><p>q</p><p>r</p></blockquote>", "```\na\n  b\n```\n\n> q\n>\n> r"),
        ("  ", ""),
        (None, ""),
    ],
)
def test_markdown(html, want):
    assert to_markdown(html) == want


def test_tables_have_equal_width(spark):
    rnd = random.Random(2)
    rows = [[["".join(rnd.choice("ab |\n") for _ in range(rnd.randrange(5))) for _ in range(rnd.randrange(1, 4))] for _ in range(rnd.randrange(5))] for _ in range(30)]
    df = spark.createDataFrame([(r,) for r in rows], "r array<array<string>>").select(T.markdown_table(F.col("r")).alias("md"))
    for r in df.collect():
        assert len({line.replace("\\|", "").count("|") for line in r.md.split("\n")}) == 1


@pytest.mark.parametrize(
    "text, links, images",
    [
        ('a [b](u) c [d]( v "T" ) e', [("b", "u", None), ("d", "v", ' "T"')], []),
        ("[![alt](i.png) Title](u) ![x](y)", [("![alt](i.png) Title", "u", None)], [("alt", "i.png", None), ("x", "y", None)]),
        ("[a [b] c](u) [[d [e]](v)", [("a [b] c", "u", None), ("d [e]", "v", None)], []),
        ("[a [b [c] d] e](u)", [], []),
        ("[a [b](u) c](v) [d](w)", [("a [b](u) c", "v", None), ("d", "w", None)], []),
        ("open [ and [x](u) ] shut ](no) [](e)", [("x", "u", None), ("", "e", None)], []),
        (r"\[a](u) [b\](v)", [("a", "u", None), ("b\\", "v", None)], []),
        ('[a](u "b) c") [d](u "e) [f](g) [h](u v) [i]()', [("a", "u", ' "b) c"'), ("f", "g", None)], []),
        ('![a [b](u) ![c]d](e) ![f](g\n"t") [', [("b", "u", None)], [("a [b", "u", None), ("f", "g", '\n"t"')]),
        ("[](", [], []),
        ("", [], []),
    ],
)
def test_scanner(spark, text, links, images):
    df = spark.createDataFrame([(text,), (None,)], "t string")
    for want, found in ((links, L.scanner()), (images, L.scanner(images=True))):
        got, none = [r[0] for r in df.select(found(F.col("t"))).collect()]
        assert none is None and [(h.label, h.url, h.title) for h in got.hits] == want
        assert got.gaps[0] + "".join(h.whole + g for h, g in zip(got.hits, got.gaps[1:])) == text


def test_scanner_is_linear():
    import time

    start = time.time()
    for text in ("[" * 100_000, "[a](" * 50_000, "[a](u) " * 50_000, "![" * 50_000 + "](x)", "]" * 100_000, "![x]" * 50_000):
        assert sum(1 for _ in L._links(text)) + sum(1 for _ in L._images(text)) >= 0
    assert time.time() - start < 20
