import html
import re

import pyarrow.parquet as pq

from rillflow.llm.pages import extract, main_text, op7_pages

PAGE = (
    "<!doctype html><html><head><title>no</title></head><body><header><h1>Site</h1></header><div id=wrap>"
    "<div class='sidebar-2'>side <a href=x>x</a></div><div class=content><h2>T&amp;t</h2><p>One  two&nbsp;three<br>four"
    "<p>Five <span class=ad>buy</span>six<ul><li>a<li>b</ul><table><tr><td>c<td>d</table><form><input>q</form>"
    "<div class='comments'><p>nice</p></div></div></div><script>if(a<b){}</script><footer>f</footer>"
)


def test_rules_on_one_page():
    assert main_text(PAGE, []) == "T&t\nOne two three four\nFive six\na\nb\nc\nd"
    assert main_text(PAGE, ["html/body/div.wrap/div.content/ul"]) == "a\nb"
    assert main_text("", []) == "" and main_text("just text &lt;b&gt;", []) == "just text <b>"


def test_hosts_agree(spark):
    long = "<p>" + "word " * 60 + "</p>"
    odd = f"<body><div class='story'>{long}</div><div class='box'><p>{'extra words here ' * 30}</p></div></body>"
    usual = f"<body><div class='story'>{long}</div><div class='box'><p>see also</p></div></body>"
    rows = [(i, "http://h.example/%d" % i, usual) for i in range(9)] + [(9, "http://H.example/9", odd), (10, None, None), (11, "nonsense", ""), (9, "http://h.example/9", odd)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    story = " ".join(["word"] * 60)
    assert len(got) == len(rows) and all(r.text == (story if r.page_id < 10 else "") for r in got)
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    pages = {p["page_id"]: p["html"] for p in pq.read_table(f"{sf}/pages.parquet").to_pylist()}
    got = {r.page_id: r for r in op7_pages(spark, sf).collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        article = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(x for x in parts if x)
        assert got[i].text == want and got[i].n_chars == len(want)
