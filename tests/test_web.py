from pyspark.sql import functions as F

from corpusprep.operators import web

PAGE = """<html><head><title>My &amp; Page</title><meta name="description" content="desc here">
<script>var x = "</p>"; fetch('/a');</script><style>p{}</style></head>
<body><h1>Head</h1><p>First <b>para</b></p><p>  </p><div></div><div>x</div>
<a href="/a">Link A</a><a>no href</a><a href="/b"></a><img src="i.png"><h2>Sub</h2>
<div data-reactroot>""" + "long text " * 10 + "</div></body></html>"

LOGIN = """<html><head><title>Login</title></head><body><form action="/login"><input type="password"></form></body></html>"""


def parsed(spark, html):
    df = spark.createDataFrame([(1, "https://x.org/p", html)], "page_id long, url string, html string")
    return web.parse_pages(df)


def test_parse_parts(spark):
    p = parsed(spark, PAGE).first()["parsed"]
    assert p["title"] == "My & Page" and p["h1"] == "Head"
    assert [h["text"] for h in p["headings"]] == ["Head", "Sub"]
    assert p["paragraphs"] == ["First para"]
    assert [(l["text"], l["href"]) for l in p["links"]] == [("Link A", "/a"), ("", "/b")]
    assert p["n_images"] == 1 and p["n_divs"] == 3 and p["n_empty_divs"] == 1
    assert "var x" not in p["body_text"]


def test_scores_and_route(spark):
    df = parsed(spark, PAGE)
    r = df.select(web.framework("html").alias("fw"), web.dynamic_score().alias("d"), web.login_check().alias("l"),
                  web.page_title().alias("t"), web.meta_description().alias("m")).first()
    assert r["fw"] == "React"
    assert r["d"]["confidence"] == 0.9 and r["d"]["is_dynamic"]  # 0.7 framework + 0.2 fetch
    assert not r["l"]["is_login"]
    assert r["t"] == "My & Page" and r["m"] == "desc here"
    lg = parsed(spark, LOGIN).select(web.login_check().alias("l")).first()["l"]
    assert lg["is_login"] and "password input" in lg["reasons"]


def test_single_framework_fixture(spark):
    html = "<html><body><div id='root' ng-app>" + "plenty of visible text " * 5 + "</div></body></html>"
    d = parsed(spark, html).select(web.dynamic_score().alias("d")).first()["d"]
    assert d["confidence"] == 0.7 and d["is_dynamic"]


def test_links_and_render(spark):
    df = parsed(spark, PAGE)
    links = web.links(df, "page_id").orderBy("position").collect()
    assert [r["text"] for r in links] == ["Link A", web.NO_LINK_TEXT]
    r = web.render_text(df).first()
    assert r["file_name"] == "My_&_Page"
    assert "[h2] Sub" in r["rendered"] and "Link A -> /a" in r["rendered"]


def test_route():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(True, False), (False, True), (False, False)], "d boolean, l boolean")
    assert [r[0] for r in df.select(web.page_route(F.col("d"), F.col("l"))).collect()] == ["dynamic", "dynamic", "static"]


def test_document_order_and_stripped_pieces(spark):
    p = parsed(spark, "<html><body>\n   <p>one<p>two<p>three\n  <h2>a<h3>b</h3></h2><a href>x</a></body></html>").first()["parsed"]
    assert [x.replace("\n", "").strip()[:3] for x in p["paragraphs"]] == ["one", "two", "thr"]
    assert [h["level"] for h in p["headings"]] == ["h2", "h3"] and [(x["text"], x["href"]) for x in p["links"]] == [("x", "")]
    thin = "<html><body>\n" + "  <div>\n        <b>thin page</b>\n   </div>\n" * 1 + " " * 200 + "</body></html>"
    r = parsed(spark, thin).select(web.dynamic_score().alias("d"), web.body_text().alias("b")).first()
    assert r["b"] == "thin page" and r["d"]["confidence"] == 0.8 and r["d"]["is_dynamic"]


def test_deep_nesting_is_linear(spark):
    import time
    html = "<body>" + "<b>x" * 20000
    t0 = time.time()
    p = web.parse_html(html)
    assert p["body_text"] == "x" * 20000 and p["error"] is None and time.time() - t0 < 20
    assert web.parse_html(None) is None and web.parse_html("")["has_body"] is False
