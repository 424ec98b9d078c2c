from rillflow.sources import landed
from rillflow.streaming.incremental import changed_only


def test_responses_and_pairs(spark, tmp_path):
    (tmp_path / "api").mkdir()
    (tmp_path / "api" / "1.json").write_text('while(1);[{"id": "7", "title": "A", "position": 2}, {"id": "8"}]')
    (tmp_path / "api" / "2.json").write_text("<html>")
    rows = landed.responses(spark, str(tmp_path / "api"), "module_item").collect()
    assert sorted((r.api_ordinal, r.id, r.title, r.position) for r in rows) == [(0, "7", "A", 2), (1, "8", None, None)]
    for name in ("a.pdf", "a.pdf.md", "b.docx", "c.md"):
        (tmp_path / name).write_text("x")
    pairs = landed.note_pairs(landed.files(spark, str(tmp_path)).select("path")).collect()
    assert [(p.original[-5:], p.note[-8:]) for p in pairs] == [("a.pdf", "a.pdf.md")]
    assert landed.manifest(spark, str(tmp_path / "none")).count() == 0


def test_stream_writes_changed_items_only(spark, tmp_path):
    schema = "id int, updated_at string"
    spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], schema).write.parquet(str(tmp_path / "in"))
    old = spark.createDataFrame([(1, "a"), (2, "x")], schema)
    out = str(tmp_path / "out")
    items = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    changed_only(items, lambda: old, lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/batch={n}"), ["id"], str(tmp_path / "state")).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [2, 3]


def test_answers_and_lists_in_order(spark, tmp_path):
    import json
    import random

    api = tmp_path / "api"
    api.mkdir()
    link = lambda n: f'<https://h/first>; rel="first",<https://h/{n}>; rel="next"' if n else '<https://h/first>; rel="first"'
    good = lambda url, n, ids: {"url": f"https://h/{url}", "status": 200, "content_type": "application/json; charset=utf-8", "link": link(n), "body": "while(1);" + json.dumps([{"id": str(i), "name": f"m{i}"} for i in ids])}
    landed_files = [good(f"a{i}", f"a{i + 1}" if i < 6 else None, range(10 * i, 10 * i + 3)) for i in range(7)]
    landed_files += [good("b1", "b2", [100]), good("b2", "b3", [101]), {"url": "https://h/b3", "status": 503, "content_type": "text/html", "body": "busy"}]
    landed_files += [good("c1", "c2", [200]), good("c2", "c1", [201])]
    landed_files += [{"url": "https://h/login", "status": 200, "content_type": "text/html", "body": "<html>"}, {"url": "https://h/cut", "status": 200, "content_type": "application/json", "body": '[{"id": "1'}]
    landed_files += [{"url": "https://h/one", "status": 200, "content_type": "application/json", "body": '{"id": "1"}'}, {"url": "https://h/none", "body": None}]
    random.Random(3).shuffle(landed_files)
    for i, f in enumerate(landed_files):
        (api / f"{i:02d}.json").write_text(json.dumps(f, indent=1))
    (api / "zz.json").write_text("no json at all")
    got = landed.answers(spark, str(api))
    states = {r.url and r.url[10:]: (r.state, r.detail) for r in got.collect() if r.state != "ok"}
    assert states.pop(None)[0] == "unreadable"
    assert states == {"b3": ("failed", "HTTP 503"), "login": ("not_json", "text/html"), "cut": ("unparsed", None), "one": ("not_list", states["one"][1]), "none": ("failed", "HTTP ?")}
    rows = landed.in_list_order(got, "module").collect()
    ids = lambda last: [r.id for r in sorted((r for r in rows if r["list"] == last), key=lambda r: r.api_ordinal)]
    assert ids("https://h/a6") == [str(10 * i + k) for i in range(7) for k in range(3)] and ids("https://h/b2") == ["100", "101"]
    assert {(r["list"], r.ended) for r in rows} == {("https://h/a6", "complete"), ("https://h/b2", "missing"), (None, "cycle")}
    assert all(r.api_ordinal is None for r in rows if r.ended == "cycle")
    assert {r.state for r in landed.answers(spark, str(api), many=False).where("url = 'https://h/one'").collect()} == {"ok"}


def test_parts_of_files(spark):
    from rillflow.operators import extract

    rows = [(1, "a.PDF", "one\f \ftwo\x00\f"), (2, "b.xlsx", "s1\x1ds2"), (3, "c.docx", "p\n\nq\nr"), (4, "d.zip", "x"), (5, "e.pptx", " \f "), (6, "f.pdf", None), (7, None, "x")]
    got = {r.id: (r.extracted, r.remark, r.field, r.n) for r in extract.extracted(spark.createDataFrame(rows, "id int, name string, text string")).collect()}
    assert got[1] == ("one\n\ntwo", "Extracted text from `a.PDF` (2 pages). Figures/diagrams are in the original.", "pages", 2)
    assert got[2][0] == "s1\n\ns2" and got[3] == ("p\n\nq\nr", "Text extracted from `c.docx` (2 paragraphs). Exact layout is in the original.", "paragraphs", 2)
    assert all(got[i] == (None, None, None, None) for i in (4, 5, 6, 7))
