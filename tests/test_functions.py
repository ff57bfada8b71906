from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions.stem import stem_terms
from trawl.functions.text import ENGLISH_STOPWORDS, token_array


def test_stopword_list():
    assert len(ENGLISH_STOPWORDS) == 179 and len(set(ENGLISH_STOPWORDS)) == 179


def test_tokens_unicode(spark):
    df = spark.createDataFrame([("Olá, 19th-century physics_2000 naïve ÉTÉ",)], "t string")
    assert df.select(token_array(F.col("t")).alias("a")).collect()[0].a == [
        "olá", "19th", "century", "physics_2000", "naïve", "été"]


def test_stems(spark):
    # Words and stems as the published vocabulary of the algorithm lists them.
    cases = {"running": "run", "universities": "univers", "generation": "generat", "happily": "happili",
             "physics": "physic", "movies": "movi", "ties": "tie", "cries": "cri", "news": "news",
             "hopefulness": "hope", "relational": "relat", "adoption": "adopt", "19th": "19th", "a": "a", "": "",
             "consign": "consign", "consigned": "consign", "consigning": "consign", "consistency": "consist",
             "conspicuously": "conspicu", "knightly": "knight", "knocking": "knock", "kneeled": "kneel", "knots": "knot",
             "agreed": "agre", "proceed": "proceed", "skies": "sky", "dying": "die", "hopped": "hop",
             "hoping": "hope", "luxuriated": "luxuri", "sized": "size", "say": "say", "cry": "cri", "enjoying": "enjoy",
             "communism": "communism", "arsenal": "arsenal", "generously": "generous", "apologies": "apolog", "rolling": "roll"}
    row = spark.createDataFrame([(list(cases),)], "t array<string>").select(stem_terms(F.col("t")).alias("s")).first()
    assert dict(zip(cases, row.s)) == cases


HTML = ("<!DOCTYPE html><html><head><title> A &amp; B </title><style>p{x:1}</style>"
        "<script>var t=\"</p><a href='/no'>\";</script></head><body><!-- c <a href=\"/c\">x</a> -->"
        "<p>Hello <b>big</b>\n world&copy;</p><noscript>ns</noscript>"
        "<a href=\"/x?a=1&amp;b=2\">l1</a><a href='rel/p'>l2</a><a href=\"#top\">t</a>"
        "<a href=\"https://o.example/z\">o</a><a href=\"mailto:m@x\">m</a><a href=\"/x?a=1&amp;b=2\">dup</a></body></html>")


def test_html(spark):
    df = spark.createDataFrame([("http://h.example/d/page.html?q=1", HTML)], "url string, html string")
    r = df.select(H.visible_text(F.col("html")).alias("text"), H.title_text(F.col("html")).alias("title"),
                  H.hrefs(F.col("html")).alias("links"),
                  F.transform(H.hrefs(F.col("html")), lambda l: H.resolve(l, F.col("url"))).alias("abs"),
                  H.url_host(F.col("url")).alias("host")).collect()[0]
    assert r.title == "A & B"
    assert r.text == "A & B Hello big world© l1 l2 t o m dup"
    assert r.links == ["/x?a=1&b=2", "rel/p", "#top", "https://o.example/z", "mailto:m@x"]
    assert r.abs == ["http://h.example/x?a=1&b=2", "http://h.example/d/rel/p", None, "https://o.example/z", None]
    assert r.host == "h.example"


def test_first_words(spark):
    df = spark.createDataFrame([("  a  b\tc " + " w" * 30,)], "t string")
    assert df.select(H.first_words(F.col("t"), 1000, 5).alias("x")).collect()[0].x == "a b c w w"


def one(spark, column, **values):
    names = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], names).select(column.alias("x")).first().x


def test_href_quoting(spark):
    html = ("<a href=\"/it's\">1</a><a data-href=\"/wrong\" href=\"/right\">2</a><a href=/bare>3</a><a\nclass=x href='/s\"q'>4</a>"
            "<a href=\"/first\" href=\"/second\">5</a><ahref=\"/no\">6</a><a name=x>7</a><A HREF = /up >8</A>")
    assert one(spark, H.hrefs(F.col("h")), h=html) == ["/it's", "/right", "/bare", "/s\"q", "/first", "/up"]


def test_title_outside_comments_and_scripts(spark):
    html = "<!-- <title>hidden</title> --><script>'<title>code</title>'</script><title>\u00a0 real &amp; true\u2003</title>"
    assert one(spark, H.title_text(F.col("h")), h=html) == "real & true"
    assert one(spark, H.title_text(F.col("h")), h=None) == ""


def test_entities(spark):
    from html import unescape

    text = "caf&eacute; &#8217;q&#x27; a&nbsp;b &amp;lt; &#128512; &lt;&gt; &bogus; &; &#; &#xD800; &#1114112; &Alpha;&alpha; x&y;z &amp"
    got = one(spark, H.decode_entities(F.col("t")), t=text)
    assert got.split(" ")[:6] == unescape(text).split(" ")[:6]
    assert got.endswith("<> &bogus; &; &#; &#xD800; &#1114112; Αα x&y;z &amp")
    assert one(spark, H.visible_text(F.col("t")), t="<p>\u00a0</p><p>&nbsp;x&nbsp;</p>&#60;b&#62;") == "x <b>"


def test_query_only_links(spark):
    for base, want in (("http://h/a/b.html", "http://h/a/b.html?p=2"), ("http://h/a/?x#y", "http://h/a/?p=2"), ("http://h", "http://h?p=2")):
        assert one(spark, H.resolve(F.col("l"), F.col("b")), l="?p=2", b=base) == want
