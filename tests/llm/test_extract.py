import html
import random
import re

import pytest

from pageloom.llm import extract


def article_of(page):
    body = re.sub("<br>", " ", re.search("<article>(.*)</article>", page, re.S).group(1))
    body = re.sub("<[^>]*>", "", re.sub("</?(p|h1|h2|div|ul|li)>", "\x00", body))
    return "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in body.split("\x00")) if x)


def test_articles_of_the_table(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = extract.op6_main_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article_of(pages[r["page_id"]])
        assert r["n_chars"] == len(r["text"])


LONG = "This is a sentence of the article, with commas, and long enough to count for some points."


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\n\nb"), ("<b><p>one</b>two</p>", "onetwo"),
    (f"<div><p>{LONG}</p><p>x &amp; y&nbsp;z &lt;</p></div><div class='comments'><p>{LONG}</p></div>", f"{LONG}\n\nx & y z <"),
    (f"<body><div id=content>{LONG}<br>second</div><ul><li><a href=1>one</a><li><a href=2>two</a></ul></body>", f"{LONG} second"),
    (f"<header><h1>Site</h1></header><main><p>{LONG}</p><p>{LONG}</p></main><aside>{LONG}</aside><footer>{LONG}</footer>", f"{LONG}\n\n{LONG}"),
    (f"<div><div class='cookie-notice'>{LONG}<p>{LONG}</div><p>{LONG}</p></div>", LONG),
    (f"<article><p>{LONG}</p><form><p>name</article><p>{LONG}</p>", LONG),
    (f"<article><script>if (a</script><style>p{{}}</style><p>{LONG}<!-- no --></p></article>", LONG),
    (f"<table><tr><td>{LONG}<td>{LONG}</table>", f"{LONG}\n\n{LONG}"),
    (f"<div><section><p>{LONG}</p></section><section><p>{LONG}</p></section></div>", f"{LONG}\n\n{LONG}"),
])
def test_pages(page, want):
    assert extract.main_text(page) == want


@pytest.mark.parametrize("name", ["content-sidebar-wrap", "site-content has-sidebar", "main-content no-comments"])
@pytest.mark.parametrize("holder", ["article", "main", "section", "div"])
def test_wrappers_around_the_article(name, holder):
    noise = f"<div class='comments'><div class=comment-content><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div></div>"
    page = f"<body><div class='top'>All rights are with the owner of the site.</div><div class='{name}'><{holder}>" + f"<p>{LONG}</p>" * 5
    want = "\n\n".join([LONG] * 5)
    assert extract.main_text(f"{page}</{holder}></div></body>") == want
    assert extract.main_text(f"{page}</{holder}{'>' + noise}</div></body>") == want
    assert extract.main_text(f"{page}</{holder}></div>{noise}</body>") == want


def test_names_are_not_asked_when_little_is_left():
    page = "<div class='community-notice'>" + f"<p>{LONG}</p>" * 9 + "</div><div>All rights are with the owner of the site.</div>"
    assert extract.main_text(page) == "\n\n".join([LONG] * 9)


def test_comments_and_related_articles_go():
    article = f"<article><p>{LONG}</p><p>{LONG}</p></article>"
    for name in ("comments", "related-posts", "sidebar"):
        noise = f"<div class='{name}'>" + f"<article class='comment-body'><p>{LONG} no</p></article>" * 9 + "</div>"
        for page in (f"{article}{noise}", f"{noise}{article}", f"<div class='content-sidebar-wrap'>{noise}{article}{noise}</div>", f"<main>{article}{noise}</main>"):
            assert extract.main_text(page) == f"{LONG}\n\n{LONG}"
        page = f"<div id=content><p>{LONG}</p><p>{LONG}</p></div>{noise}"
        assert extract.main_text(page) == f"{LONG}\n\n{LONG}"


def test_formulas_stay():
    formula = "<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow><annotation>E = mc^2</annotation></semantics></math>"
    assert extract.main_text(f"<article><p>{LONG} Then {formula} holds.</p></article>") == f"{LONG} Then E=mc2 holds."


def test_broken_markup_does_not_fail():
    draw = random.Random(3)
    parts = ["<", "</", ">", "p", "div", "b", "article", "!--", "-->", "![", "[", "]]>", "!", "?", "&", "#", "x", "; ", " class=ad", "a", "li", "script", '"', "'", "=", "/", "nav", "text, text"]
    for _ in range(3_000):
        extract.main_text("".join(draw.choice(parts) for _ in range(draw.randint(1, 40))))


def test_deep_and_long_pages():
    assert extract.main_text("<div>" * 5_000 + LONG + "</div>") == LONG
    assert extract.main_text(f"<article>{'<p>' + LONG * 3 + '</p>'}" + f"<p>{LONG}</p>" * 5_000).count("\n\n") == 5_000


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "v", f"<p>{LONG}</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'clash' AS text", "1 AS k0")
    assert sorted((r["page_id"] or 0, r["text"]) for r in extract.extract(pages).collect()) == [(0, LONG), (1, ""), (2, ""), (2, "")]
    assert extract.extract(pages.where("false")).collect() == []


FIVE = "".join(f"<p>{LONG} Number {k}.</p>" for k in range(5))
FIVE_TEXT = "\n\n".join(f"{LONG} Number {k}." for k in range(5))


@pytest.mark.parametrize("around", [
    "<body><form id=aspnetForm action=x><input name=v>{}<button>Send</button></form></body>", "<body><form><fieldset>{}</fieldset></form></body>",
    "<body><header>{}</header></body>", "<body><aside>{}</body>", "<div hidden>{}</div>", "<div style='display: none'>{}</div>", "<dialog open>{}</dialog>",
    "<div role=form>{}</div>", "<div role=complementary>{}</div>", "<div aria-hidden=true>{}</div>",
])
def test_wrappers_of_every_kind(around):
    noise = f"<nav><a href=1>{LONG}</a></nav><footer><p>{LONG}</p></footer><form><p>Sign up to our letter, it is free, and you can leave it.</p><input></form>"
    for holder in ("article", "main"):
        page = around.format(f"<{holder}>{FIVE}</{holder}>{noise}")
        assert extract.main_text(page) == FIVE_TEXT, page
    if "form" in around:
        assert extract.main_text(around.format(f"<div id=top><a href=1>Home</a></div><div class=content>{FIVE}</div>")) == FIVE_TEXT


def test_small_forms_and_asides_go():
    form = "<form><p>Write what you think of it, we read all of it, and we may answer you.</p><textarea>x</textarea></form>"
    aside = f"<aside><p>{LONG}</p></aside>"
    hidden = f"<div hidden><p>{LONG} Not seen.</p></div>"
    for page in (f"<article>{FIVE}{form}{aside}{hidden}</article>", f"<div id=content>{FIVE}</div>{form}{aside}{hidden}", f"{aside}{form}{hidden}<main>{FIVE}</main>",
                 f"<form id=page>{aside}<div>{FIVE}</div>{hidden}</form>"):
        assert extract.main_text(page) == FIVE_TEXT, page


def test_pages_put_together_at_random():
    """Known paragraphs in containers of many kinds, with known noise round them: the paragraphs come back, and nothing else."""
    draw = random.Random(8)
    words = "time year people way day man thing woman life child world school state family student group country problem hand part place case".split()

    def sentence():
        return " ".join(draw.choice(words) for _ in range(draw.randint(9, 20))).capitalize() + ", " + draw.choice(words) + "."

    holders = ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div id=post-7><section>{}</section></div>", "<table><tr><td>{}</td></tr></table>",
               "<section class='entry'>{}</section>"]
    wraps = ["{}", "<div>{}</div>", "<form id=f>{}</form>", "<div class='page-wrapper'><div class=inner>{}</div></div>", "<div class='has-sidebar'>{}</div>"]
    for n in range(300):
        own = [" ".join(sentence() for _ in range(draw.randint(2, 5))) for _ in range(draw.randint(4, 9))]
        body = "".join(f"<p>{draw.choice(['', '<b>'])}{p}" + draw.choice(["</p>", "</p>\n  "]) for p in own)
        noise = [
            "<nav><ul>" + "".join(f"<li><a href=/{k}>{draw.choice(words)}</a>" for k in range(8)) + "</ul></nav>", f"<aside><p>{sentence()}</p></aside>",
            f"<footer><p>{sentence()}</p></footer>", f"<div class=comments><p>{sentence()}</p><p>{sentence()}</p></div>", f"<div class='cookie-notice'>{sentence()}</div>",
            "<div class=links>" + "".join(f"<a href=/{k}>{sentence()}</a>" for k in range(3)) + "</div>", f"<form class=search><label>{sentence()}</label><input></form>",
            f"<script>var x = '{sentence()}';</script>", f"<div style='display:none'>{sentence()}</div>",
        ]
        draw.shuffle(noise)
        cut = draw.randint(0, len(noise))
        page = "".join(noise[:cut]) + draw.choice(holders).format(body) + "".join(noise[cut:])
        page = f"<html><head><title>{sentence()}</title></head><body>{draw.choice(wraps).format(page)}</body></html>"
        assert extract.main_text(page) == "\n\n".join(own), (n, page)
