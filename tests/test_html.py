"""Page expressions against the standard library's HTML parser."""

import html as entities
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from pageloom.functions import html

RAW = ("textarea", "xmp", "iframe", "noembed", "noframes")


class Collector(HTMLParser):
    """Tags of interest, with other raw-text elements skipped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.srcs, self.types, self.hrefs, self.titles = [], [], [], []
        self._title = None
        self._raw = None

    def handle_starttag(self, tag, attrs):
        if self._raw:
            return
        values = {}
        for key, value in attrs:
            values.setdefault(key, value)
        if tag in RAW:
            self._raw = tag
        if tag == "script":
            self.srcs += [values["src"]] if values.get("src") else []
            self.types += [values["type"]] if values.get("type") else []
        if tag == "a" and values.get("href"):
            self.hrefs.append(values["href"])
        if tag == "title" and self._title is None:
            self._title = []

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if tag == self._raw:
            self._raw = None
        if tag == "title" and self._title is not None:
            self.titles.append("".join(self._title))
            self._title = None

    def handle_data(self, data):
        if self._title is not None:
            self._title.append(data)


def extract(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    tags = df.withColumn("t", html.page_tags(F.col("html")))
    t = F.col("t")
    rows = tags.select(
        "i",
        html.title_of(t).alias("title"),
        html.attributes(t, "a", "href").alias("hrefs"),
        html.script_srcs_of(t).alias("srcs"),
        html.script_srcs_of(t, keep_data_uris=False).alias("kept"),
        html.script_types_of(t).alias("types"),
        html.meta_of(t, "description").alias("description"),
        html.meta_of(t, "keywords").alias("keywords"),
        html.emails_of(t).alias("emails"),
    ).collect()
    return sorted(rows, key=lambda r: r.i)


PIECES = [
    "text & more &amp; &lt;b&gt; ",
    "<p class='x'>para</p>",
    '<a href="/p?a=1&amp;b=2">l</a>',
    "<A HREF='/q'>l</A>",
    "<a href=/r>l</a>",
    "<a name=z>l</a>",
    '<a data-href="no" href="yes">l</a>',
    '<script src="/a.js"></script>',
    "<script type=module src='b>c.js' async></script>",
    '<script src=""></script>',
    "<script>var t = \"</p>\"; var u = '<a href=inner>';</script>",
    "<script>if (a < b) document.write('<b>');</script>",
    "<!-- <script src=hidden.js></script> <a href=hidden> -->",
    "<style>p > a { color: red }</style>",
    '<div title="<a href=attr>">d</div>',
    "<br/>",
    "<img alt='a > b' src=i.png>",
    "\n\t",
    "1 < 2 and 3 > 2 ",
    "<!doctype html>",
    "<title> A &eacute; &#233; &#xe9; T </title>",
]


def test_random_pages_match_parser(spark):
    rng = random.Random(7)
    pages = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(200)]
    for page, row in zip(pages, extract(spark, pages)):
        expected = Collector()
        expected.feed(page)
        expected.close()
        title = expected.titles[0].strip() if expected.titles else html.MISSING_TITLE
        assert (row.title, row.hrefs, row.srcs, row.types) == (title, expected.hrefs, expected.srcs, expected.types), page


def test_meta_and_emails(spark):
    pages = [
        '<meta name=description content=first><meta content="last > one" name="description">'
        '<meta name="keywords" content="">'
        '<a href="mailto:A@b.co">x</a><a href="c.d+e@f-g.org">y</a><a href="mailto:x@y.z?subject=q">z</a><a href="@b.c">w</a>',
        '<meta name="description" content="kept"><meta name="description"><meta property="keywords" content="no">',
        "",
        None,
    ]
    rows = extract(spark, pages)
    assert [r.description for r in rows] == ["last > one", None, None, None]
    assert [r.keywords for r in rows] == ["", None, None, None]
    assert [r.emails for r in rows] == [["mailto:A@b.co", "c.d+e@f-g.org"], [], [], None]
    assert [r.title for r in rows] == [html.MISSING_TITLE] * 4


def test_awkward_markup(spark):
    pages = {
        '<script>"<!--"</script><script src=a.js></script>': ["a.js"],
        "<script src=a.js>x</SCRIPT ><script src=b.js>": ["a.js", "b.js"],
        "<script src='open.js": [],
        "<!-- never closed <script src=a.js></script>": [],
        "<!--><script src=a.js></script>": ["a.js"],
        "<textarea><script src=t.js></script></textarea><script src=u.js></script>": ["u.js"],
        "<scripts src=no.js></scripts><script/src=a.js></script>": ["a.js"],
        "<script src=one.js src=two.js></script>": ["one.js"],
        "<script src = 'a b.js' ></script><script SRC\n=\nc.js></script>": ["a b.js", "c.js"],
        "<script data-src=no.js xsrc=no.js src=data:x,y></script>": ["data:x,y"],
        "<<script src=a.js></script>": ["a.js"],
        "<script src=>x</script><script src=b.js></script>": ["b.js"],
    }
    rows = extract(spark, pages)
    assert [r.srcs for r in rows] == list(pages.values())
    assert [r.kept for r in rows][9] == []


def test_long_inputs_do_not_overflow(spark):
    n = 200_000
    pages = [
        "<a " + "x=1 " * n + "href=ok>",
        "<script>" + "a<b;" * n + "</script><a href=ok>",
        "<!--" + "- " * n + "--><a href=ok>",
        "<" * n + "<a href=ok>",
        "<p>" * n + "<a href=ok>",
    ]
    assert [r.hrefs for r in extract(spark, pages)] == [["ok"]] * len(pages)


def test_entities(spark):
    texts = ["&amp;&lt;&quot;", "&eacute;&nbsp;&copy", "&#233;&#xE9;&#0;&#x110000;&#150;", "&nosuch; & a&b;", "&apos;&ndash;", "&#65"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = [r.r for r in df.select("i", html.decode_entities(F.col("v")).alias("r")).orderBy("i").collect()]
    # A name without its semicolon stays; everything else is as in the standard library.
    assert got[1] == "é\u00a0&copy"
    assert [g for i, g in enumerate(got) if i != 1] == [entities.unescape(t) for i, t in enumerate(texts) if i != 1]


def test_normalize(spark):
    df = spark.createDataFrame([("  <A\tB\nC>  ",)], "v string")
    assert df.select(html.normalize_html(F.col("v")).alias("r")).first().r == "<a bc>"
    assert df.select(html.normalize_html(F.col("v"), False, " ").alias("r")).first().r == "<A B C>"


def test_payload_text(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray("é".encode()),)], "v binary")
    assert [r.r for r in df.select(html.payload_text(F.col("v")).alias("r")).collect()] == ["a\ufffdb", "é"]
