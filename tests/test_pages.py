"""Page extraction against hand-read pages."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from opinionlake.operators import html as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style>
<meta property="og:title" content="Tom &amp; Ann"><meta name="author" content='Ann'><meta name="author" content="Bob">
<meta property="" name="twitter:data2" content="3 minutes"><meta name="x" content=""><meta charset="utf-8">
<script>var a = "<a href='/no'>no</a>";</script></head>
<body class="home  wide"><!-- <a href="/hidden">x</a> --><div class="post wide">One <b>two</b> <span>three</span></div>
<p>Para <em>it</em><br>next</p><p>  </p><p><span>Posted by</span> <span> Jane </span><span>20/5/2026</span></p>
<ul><li>a<li>b</ul><a href="/1?a=1&amp;b=2">x</a><a name="n">no link</a><A HREF='/2'>y</A><a href=/3>z</a>
<img alt=">" src="i.png"><img><time class="d t" datetime="2026-05-20">20 May</time></body></html>"""


def one(spark, column, page=PAGE):
    return spark.createDataFrame([(page,)], "html string").select(column.alias("x")).first().x


def test_attributes(spark):
    h = F.col("html")
    assert one(spark, H.hrefs(h)) == ["/1?a=1&b=2", "/2", "/3"]
    assert one(spark, H.srcs(h)) == ["i.png", ""]
    assert one(spark, H.classes(h)) == ["d", "home", "post", "t", "wide"]
    assert one(spark, H.metas(h)) == {"og:title": "Tom & Ann", "author": "Bob", "twitter:data2": "3 minutes"}
    time = one(spark, H.times(h))[0]
    assert (time.text, time.datetime, time["class"]) == ("20 May", "2026-05-20", ["d", "t"])


def test_limits(spark):
    many = "".join(f"<a href='/{i}'>t{i}</a><img src='{i}'>" for i in range(30))
    assert len(one(spark, H.hrefs(F.col("html")), many)) == 30 and len(one(spark, H.hrefs(F.col("html"), 20), many)) == 20
    assert len(one(spark, H.srcs(F.col("html")), many)) == 30 and len(one(spark, H.srcs(F.col("html"), 10), many)) == 10
    assert one(spark, H.page_texts(F.col("html")), many).a_all_texts == [f"t{i}" for i in range(30)]


def test_a_page_that_cannot_be_parsed_is_an_error_record(spark):
    df = spark.createDataFrame([("u1", "<p>x<![foo[bar]]></p>"), ("u2", "<p>fine</p>"), ("u3", None)], "url string, html string").coalesce(1)
    got = {r.url: r for r in H.extract_pages(df).collect()}
    assert got["u1"].status == "error" and got["u1"].error and got["u1"].p_all_texts is None
    assert got["u2"].status is None and got["u2"].p_all_texts == ["fine"] and got["u3"].error == "no content"
    assert one(spark, H.container_links(F.col("html")), "<p>x<![foo[bar]]></p>") is None


def test_element_texts(spark):
    t = one(spark, H.page_texts(F.col("html")))
    assert t.div_all_texts == ["Onetwothree"]
    assert t.p_all_texts == ["Paraitnext", "Posted byJane20/5/2026"]
    assert t.li_all_texts == ["ab", "b"]  # an unclosed item holds the ones after it
    assert t.em_all_texts == ["it"] and t.time_all_texts == ["20 May"]
    assert (t.author, t.byline_date) == ("Jane", "20/5/2026")


def test_unclosed_paragraphs_nest(spark):
    t = one(spark, H.page_texts(F.col("html")), "<p><b>A<br><p>B</p><p>C</p></div>D")
    assert t.p_all_texts == ["ABCD", "B", "C"]


def test_byline_needs_a_line_of_its_own(spark):
    t = one(spark, H.page_texts(F.col("html")), "<p>Posted by Ann</p><p>Posted by<br>Bob</p>")
    assert (t.author, t.byline_date) == (None, None)  # the first block with the words decides


def test_listing(spark):
    box = '<div class="x post-container"><div>t</div>{}</div>'
    pages = [(1, box.format('<a href="/a">1</a><a href="/b">2</a>') + box.format("none") + '<a href="/out">o</a>'),
             (2, box.format('<a href="https://e.x/c">3</a>') + box.format('<a href="/a">1</a>')), (3, None)]
    df = spark.createDataFrame(pages, "page int, html string")
    got = H.listing_links(df, "html", "https://site", ["page"]).orderBy("page", "position").collect()
    assert [(r.page, r.url) for r in got] == [(1, "https://site/a"), (2, "https://e.x/c")]


def test_records_and_failures(spark):
    df = spark.createDataFrame([("u1", PAGE), ("u2", None)], "url string, html string")
    rows = {r.url: r for r in H.extract_pages(df).collect()}
    assert rows["u1"].author == "Jane" and rows["u1"].published_time == "20/5/2026" and rows["u1"].status is None
    assert rows["u2"].status == "error" and rows["u2"].p_all_texts is None


def test_text_function_is_left_out_when_unused(spark):
    df = spark.createDataFrame([("u1", PAGE)], "url string, html string")
    plan = H.extract_pages(df).select("url", "all_classes")._jdf.queryExecution().executedPlan().toString()
    assert "page_texts" not in plan


def test_a_large_batch_of_pages_is_not_held_as_python_objects():
    def run(n):
        pages = pa.array([f"<div><p>{i} {'x' * 50}</p></div>" * 20 for i in range(n)])
        tracemalloc.start()
        try:
            got = H.page_texts.func(pages)
            return got, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    run(64)
    few, peak = run(128)
    many, larger = run(1024)
    assert len(many) == 1024 and many[:128] == few and len(many[1023]["p_all_texts"]) == 20
    assert larger < 2 * peak
