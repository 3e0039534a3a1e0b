"""URL, address and library expressions against Python's own parsers."""

import ipaddress
import re
from urllib.parse import urlparse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pageloom.functions import html, ip, js, url

SETTINGS = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture], derandomize=True
)


def apply(spark, values, function):
    """Results of a Column function over a list of texts, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).collect()
    return [row.r for row in sorted(rows, key=lambda row: row.i)]


DOMAINS = {
    "https://u:p@Ex.com:80/a?b#c": "u:p@Ex.com:80",
    "-": "",
    "http://a.com?x=/": "a.com",
    "//h/p": "h",
    "http://bad host/é|": "bad host",
    "mailto:a@b.c": "",
    "HTTP://A.com": "A.com",
    None: None,
}
LIBRARIES = {
    "/js/jquery/jquery.min.js?ver=1": "jquery.js",
    "https://cdn.jsdelivr.net/npm/vue.js": "cdn.js",
    "js.cookie.min.js?v=1": "cookie.js",
    "/a/data.json": "data.js",
    "//b.com/q.min.js": "q.js",
    "\\'http://x.com/wp/js/jquery.js?ver=1.12\\": "jquery.js",
    "/js.php?r=": None,
    "": None,
    "js": None,
    "a.JS": None,
    "https://a.com/x": None,
    None: None,
}


def test_golden_domains(spark):
    assert apply(spark, DOMAINS, url.url_domain) == list(DOMAINS.values())


def test_golden_libraries(spark):
    assert apply(spark, LIBRARIES, js.js_lib_name) == list(LIBRARIES.values())


url_texts = st.lists(
    st.tuples(
        st.sampled_from(["http:", "HTTPS:", "ftp:", "", "x+y:", "1a:", "mailto:"]),
        st.sampled_from(["//", "/", ""]),
        st.text("aB.é:@[]19 |%-", max_size=12),
        st.text("/?#ab=.", max_size=8),
    ).map("".join),
    min_size=40,
    max_size=80,
)


@SETTINGS
@given(url_texts)
def test_domain_is_netloc(spark, texts):
    def netloc(text):
        try:
            return urlparse(text).netloc
        except ValueError:  # a bracket that is not an address: no netloc to compare with
            return None

    kept = [t for t in texts if t == t.strip() and netloc(t) is not None]
    assert apply(spark, kept, url.url_domain) == [netloc(t) for t in kept]


@SETTINGS
@given(url_texts)
def test_hostname(spark, texts):
    def hostname(text):
        try:
            return urlparse(text).hostname
        except ValueError:
            return False

    kept = [t for t in texts if t == t.strip() and hostname(t) is not False and "[" not in t and "]" not in t]
    assert apply(spark, kept, url.url_hostname) == [hostname(t) for t in kept]


sources = st.lists(st.text("js./?min-é|=1\\'", max_size=20), min_size=60, max_size=120)


@SETTINGS
@given(sources)
def test_library_is_first_match(spark, texts):
    def name(text):
        found = re.search(r"/?(?:js\.)?([^/?]+\.js)", text)
        return re.sub(r"\.min\.", ".", found.group(1)) if found else None

    assert apply(spark, texts, js.js_lib_name) == [name(t) for t in texts]


def signed(half):
    return half - (1 << 64) if half >= 1 << 63 else half


def key_of(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    if address.version == 4:
        return 4, 0, int(address)
    return 6, signed(int(address) >> 64), signed(int(address) & (1 << 64) - 1)


addresses = st.lists(
    st.one_of(
        st.ip_addresses(v=4).map(str),
        st.ip_addresses(v=6).map(str),
        st.ip_addresses(v=6).map(lambda a: a.exploded),
        st.text("0129:.af-", max_size=15),
        st.ip_addresses(v=4).map(lambda a: f"::ffff:{a}"),
    ),
    min_size=60,
    max_size=120,
)


@SETTINGS
@given(addresses)
def test_ip_key(spark, texts):
    got = [tuple(r) if r else None for r in apply(spark, texts, ip.ip_key)]
    assert got == [key_of(t) for t in texts]


networks = st.lists(
    st.one_of(
        st.tuples(st.ip_addresses(v=4), st.integers(0, 34)).map(lambda t: f"{t[0]}/{t[1]}"),
        st.tuples(st.ip_addresses(v=6), st.integers(0, 130)).map(lambda t: f"{t[0]}/{t[1]}"),
        st.ip_addresses(v=4).map(str),
        st.just("x/8"),
    ),
    min_size=60,
    max_size=120,
)


def network_of(text):
    try:
        return ipaddress.ip_network(text, strict=False)
    except ValueError:
        return None


@SETTINGS
@given(networks)
def test_networks(spark, texts):
    def expected(text):
        net = network_of(text)
        if net is None:
            return None
        family, hi, lo = key_of(str(net.network_address))
        return family, net.prefixlen, hi, lo

    assert [tuple(r) if r else None for r in apply(spark, texts, ip.cidr_key)] == [expected(t) for t in texts]

    v4 = [t for t in texts if ":" not in t]
    nets = [network_of(t) for t in v4]
    ranges = [(int(n.network_address), int(n.broadcast_address)) if n else None for n in nets]
    assert [tuple(r) if r else None for r in apply(spark, v4, ip.cidr_to_range)] == ranges
    assert apply(spark, v4, ip.broadcast_address) == [str(n.broadcast_address) if n else None for n in nets]


@pytest.mark.parametrize(
    ("text", "expected"),
    [(r"caf\xc3\xa9", "café"), ("plain", "plain"), (None, None), (r"bad\x", r"bad\x"), ("é", "é"), (r"\xff", "\ufffd")],
)
def test_unescape_bytes(spark, text, expected):
    assert apply(spark, [text], html.unescape_bytes) == [expected]


def test_basename_rule(spark):
    values = ["/a/jquery.min.js?x", "https://c.net/js.cookie.js#f", "/x/js", "/a.css", "\\'//h/p/a.js,b.js\\"]
    assert apply(spark, values, js.js_lib_basename) == ["jquery.js", "cookie.js", None, None, "a.js,b.js"]
    assert apply(spark, values[-1:], lambda c: js.js_lib_basename(c, cut_at_comma=True)) == ["a.js"]


def test_local_path_and_year(spark):
    paths = ["a/b/c.warc.gz", "x", "a/b.c"]
    assert apply(spark, paths, lambda c: url.local_path(c, "/d/")) == ["/d/c.warc", "/d/", "/d/b"]
    assert apply(spark, ["s/CC-MAIN-2024-33/w", "x"], url.crawl_year) == ["2024", None]
