import html
import re

from wxengine.llm import html_extract
from wxengine.llm.html_extract import Page, declared
from wxengine.llm.queries import op7_html_extract

SF_DIR = "/root/testdata/sf0.01"


def test_query_against_the_article_of_each_page(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = op7_html_extract(spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL).group(1)
        text = re.sub(r"</?b>", "", re.sub(r"<br>|</?p>|</?h1>", " ", article))
        assert r["text"] == " ".join(html.unescape(text).split())
        assert r["n_chars"] == len(r["text"])


def blocks(source):
    return [(path, text) for path, _, text in Page(source).blocks]


def test_parsing():
    assert blocks("<p>a<b>b</b>c<br>d<p>&lt;e&gt;&amp;amp;&nbsp;f") == [("p", "abc d"), ("p", "<e>&amp; f")]
    assert blocks("<ul><li>x<li>y</ul>z") == [("ul/li", "x"), ("ul/li", "y"), ("", "z")]
    assert blocks("<script>var t='</p>'</script><!-- a > b --><style>p{}</style>1 < 2 <div") == [("", "1 < 2")]
    assert blocks('<div class="b a" id=c>x</div><!doctype html><title>no</title>') == [("div.a.b.c", "x")]
    assert blocks("<p>open <i>never closed<div>next</div>") == [("p", "open never closed"), ("div", "next")]
    assert blocks("<script>unclosed <p>x") == [] and blocks("</p></div>x") == [("", "x")]
    assert blocks(None) == blocks("") == []


def test_declarations():
    assert declared("html/body/article/p") == 1.0
    assert declared("html/body/article/section.comments/p") == 0.0
    assert declared("body/header/h1") == 0.0 and declared("body/article/header/h1") == 1.0
    assert declared("body/div.content/p") is None and declared("body/div.ad") == 0.0


def test_undeclared_menus_go_by_entropy(spark):
    rows = [
        (i, f"http://h{i % 2}.example/{i}", f"<body><div class=top>Home About</div><div class=story><p>Story number {i} of many</p></div><div class=end>All rights</div></body>")
        for i in range(40)
    ]
    rows += [(100, "http://h0.example/x", rows[0][2]), (100, "http://h0.example/x", rows[0][2]), (101, None, None), (None, "::", ""), (102, "http://lone.example/", "<main>Only <b>page</b></main><nav>n</nav>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "'x' AS path", "'x' AS page")
    got = html_extract.extract(frame).collect()
    assert len(got) == len(rows)
    found = {r["page_id"]: r["text"] for r in got}
    assert all(found[i] == f"Story number {i} of many" for i in range(40))
    assert found[100] == found[0] and found[101] == found[None] == "" and found[102] == "Only page"
    assert html_extract.extract(frame.where("false")).count() == 0


def test_trees_of_many_pages_overcome_what_is_declared(spark):
    rows = [
        (i, f"http://h{i % 2}.example/{i}", f"<article><p>Story number {i} of many</p><p class=strip>Open all week</p></article><aside>Menu {i % 3}</aside>")
        for i in range(120)
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(frame).collect()}
    assert got == {i: f"Story number {i} of many" for i, _, _ in rows}
    # Declared furniture stays where neither texts nor inline tags repeat.
    tags = ["b", "i", "u", "em", "strong", "small", "code"]
    varied = [
        (i, f"http://h.example/{i}", "<aside>" + "".join(f"<{tags[i // 7**k % 7]}>x</{tags[i // 7**k % 7]}>" for k in range(3)) + f" own {i}</aside><aside class=b>Same</aside>")
        for i in range(120)
    ]
    got = html_extract.extract(spark.createDataFrame(varied, frame.schema)).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"xxx own {i}" for i in range(120)}


def test_class_names_are_compared_whole(spark):
    assert blocks('<div class="related-work ad_2 post-17" id=x9>a</div>') == [("div.ad.post.related-work.x", "a")]
    assert declared("article/div.related-work/p") == 1.0 and declared("article/div.related/p") == 0.0
    rows = [(i, f"http://h.example/{i}", f"<article><p>Story {i}</p><div class=related-work>Others found {i}</div></article>") for i in range(60)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"Story {i} Others found {i}" for i in range(60)}
