from rillflow.llm.pages import extract


def test_two_layouts_on_one_host(spark):
    junk = "<div class='strip'><p>" + "plain boilerplate " * 8 + "</p></div>"
    text = lambda i: f"body{i} " + "word " * 400
    a = lambda i: f"<html><body>{junk}<article><p>{text(i)}</p></article></body></html>"
    b = lambda i: f"<html><body>{junk}<main><div class='x'><p>{text(i)}</p></div></main></body></html>"
    rare = lambda i: f"<html><body>{junk}<div class='{'abcdefghijkl'[i]}'><p>{text(i)}</p></div></body></html>"
    pages = [a(i) for i in range(20)] + [b(i) for i in range(20)] + [rare(i) for i in range(12)] * 2
    rows = [(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and all("boilerplate" not in r.text and r.text.count("word") == 400 for r in got)
