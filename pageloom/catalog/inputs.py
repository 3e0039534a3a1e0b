"""Inputs of the registered queries, derived from the given tables.

Each text is plain SQL that Spark and DuckDB both run; the SQL counterparts of the
queries use the same texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Pages as a crawl would deliver them: address, URL, server and HTML with meta tags,
# script sources of every quoting style, a commented-out script and e-mail links.
CRAWL_PAGES = """
SELECT page_id, url AS host,
  CASE WHEN page_id % 50 = 0 THEN '-'
       WHEN page_id % 97 = 13 THEN concat('2001:db8::', CAST(page_id % 9 AS STRING))
       ELSE concat('10.', CAST(page_id % 30 AS STRING), '.', CAST(page_id % 7 AS STRING), '.', CAST(page_id % 11 AS STRING)) END AS ip,
  CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 3 = 0 THEN 'nginx' ELSE 'apache' END AS server,
  replace(html, '</head>', concat(
    '<meta name="description" content="first"><meta name="description" content="desc ', CAST(page_id % 5 AS STRING), '">',
    CASE WHEN page_id % 4 = 0 THEN '' ELSE concat('<meta name="keywords" content="k', CAST(page_id % 3 AS STRING), ',web">') END,
    '<!-- <script src="/never.js"></script> -->',
    '<script type="text/javascript" src="/js/lib', CAST(page_id % 7 AS STRING), '.min.js?ver=1"></script>',
    '<script src=', chr(39), 'https://cdn.jsdelivr.net/vue', CAST(page_id % 3 AS STRING), '.js', chr(39), '></script>',
    '<script src=//x.example.com/jquery.js async></script>',
    CASE WHEN page_id % 6 = 0 THEN '<script src="https://cdn.shopify.com/s/theme.js"></script>' ELSE '' END,
    '<script src="data:text/javascript,a>b"></script></head><a href="mailto:u', CAST(page_id % 8 AS STRING),
    '@example.com">m</a><a href="mailto:x@example.com?subject=hi">n</a>')) AS html
FROM pages
"""

# URLs with the endings and names the retrieval filters look for.
CRAWL_URLS = """
SELECT page_id, concat(url, CASE
    WHEN page_id % 11 = 0 THEN '/paper.pdf'
    WHEN page_id % 11 = 1 THEN '/aws/whitepaper.PDF'
    WHEN page_id % 11 = 2 THEN '/arxiv/2401.pdf'
    WHEN page_id % 11 = 3 THEN '/huggingface.co/model'
    WHEN page_id % 11 = 4 THEN '/openai.com/blog'
    WHEN page_id % 11 = 5 THEN '/Case Study/a.Pdf'
    WHEN page_id % 11 = 6 THEN '/laws/b-pdf'
    WHEN page_id % 11 = 7 THEN '/ARXIV/c.pdf'
    ELSE '' END) AS host
FROM pages
"""

# URLs of awkward shapes: user info, ports, no path, no scheme, no authority.
ODD_URLS = """
SELECT page_id, CASE page_id % 8
    WHEN 0 THEN replace(url, '://', '://u:p@')
    WHEN 1 THEN upper(url)
    WHEN 2 THEN concat('https://Host', CAST(page_id AS STRING), '.Example.com:8080?x=/')
    WHEN 3 THEN concat('//h', CAST(page_id AS STRING), '/p')
    WHEN 4 THEN concat('mailto:a', CAST(page_id AS STRING), '@b.c')
    WHEN 5 THEN '-'
    WHEN 6 THEN concat('http://bad host', CAST(page_id AS STRING), '/x')
    ELSE url END AS host
FROM pages
"""

# Script sources as older extractions left them, one per order line.
DIRTY_SRCS = """
SELECT l_orderkey, l_linenumber, CASE l_orderkey % 10
    WHEN 0 THEN concat('/js/jquery/jquery', CAST(l_partkey % 50 AS STRING), '.min.js?ver=1')
    WHEN 1 THEN concat('https://cdn.jsdelivr.net/npm/vue', CAST(l_partkey % 50 AS STRING), '.js')
    WHEN 2 THEN concat('js.cookie', CAST(l_partkey % 50 AS STRING), '.min.js?v=1')
    WHEN 3 THEN concat('/a/data', CAST(l_partkey % 50 AS STRING), '.json')
    WHEN 4 THEN concat('//b.com/q', CAST(l_partkey % 50 AS STRING), '.min.js')
    WHEN 5 THEN concat(chr(92), chr(39), 'http://x.com/wp/js/lib', CAST(l_partkey % 50 AS STRING), '.js?ver=1.12', chr(92))
    WHEN 6 THEN '/js.php?r='
    WHEN 7 THEN 'a.JS'
    WHEN 8 THEN concat('https://a.com/x', CAST(l_partkey % 50 AS STRING))
    ELSE '' END AS src
FROM lineitem
"""

# '|'-joined sources, some inline, one list per order line.
PIPED_SRCS = """
SELECT l_orderkey, l_linenumber, concat(
    '/js/lib', CAST(l_partkey % 20 AS STRING), '.min.js',
    CASE WHEN l_orderkey % 3 = 0 THEN '|data:text/javascript,x()' ELSE '' END,
    CASE WHEN l_orderkey % 4 = 0 THEN '|https://cdn.shopify.com/s/theme.js' ELSE '' END,
    CASE WHEN l_orderkey % 5 = 0 THEN '|' ELSE '' END) AS script_src_attrs
FROM lineitem
"""

# Addresses: mostly IPv4, some IPv6, some absent, some malformed.
LINE_IPS = """
SELECT l_orderkey, l_linenumber, CASE
    WHEN l_orderkey % 50 = 0 THEN '-'
    WHEN l_orderkey % 97 = 13 THEN concat('2001:db8:', CAST(l_suppkey % 9 AS STRING), '::', CAST(l_partkey % 99 AS STRING))
    WHEN l_orderkey % 89 = 7 THEN concat('10.', CAST(l_suppkey % 30 + 250 AS STRING), '.01.1')
    ELSE concat('10.', CAST(l_suppkey % 30 AS STRING), '.', CAST(l_partkey % 256 AS STRING), '.', CAST(l_orderkey % 256 AS STRING))
    END AS ip
FROM lineitem
"""

# Address blocks with their attributes: a /24 nested in each /16, and an IPv6 block.
GEO_BLOCKS = """
SELECT concat('10.', CAST(n_nationkey AS STRING), '.0.0/16') AS network, n_nationkey AS geoname_id,
       concat('p', CAST(n_nationkey AS STRING)) AS postal_code,
       n_nationkey + 0.5 AS latitude, n_nationkey - 100.25 AS longitude, 50 AS accuracy_radius,
       n_nationkey % 5 = 0 AS is_anonymous_proxy, n_nationkey % 7 = 0 AS is_anycast
FROM nation
UNION ALL
SELECT concat('10.', CAST(n_nationkey AS STRING), '.3.0/24'), (n_nationkey + 1) % 25,
       concat('q', CAST(n_nationkey AS STRING)),
       n_nationkey + 0.75, n_nationkey - 50.5, 5, n_nationkey % 3 = 0, false
FROM nation
"""

# One /24 or /28 block per part, on top of the /16 blocks: many nested networks.
PART_BLOCKS = """
SELECT concat('10.', CAST(n_nationkey AS STRING), '.0.0/16') AS network, n_nationkey AS geoname_id FROM nation
UNION ALL
SELECT concat('10.', CAST(p_partkey % 30 AS STRING), '.', CAST(p_partkey % 256 AS STRING), '.0/24'), min(p_size % 25)
FROM part WHERE p_partkey % 2 = 0 GROUP BY p_partkey % 30, p_partkey % 256
UNION ALL
SELECT concat('10.', CAST(p_partkey % 30 AS STRING), '.', CAST(p_partkey % 256 AS STRING), '.',
              CAST((p_partkey % 16) * 16 AS STRING), '/28'), min(p_size % 25)
FROM part WHERE p_partkey % 3 = 0 GROUP BY p_partkey % 30, p_partkey % 256, p_partkey % 16
"""

# Spans of addresses that are no networks: odd ends, nested, touching, over several /24 networks.
PART_SPANS = """
SELECT p_partkey, concat('10.', CAST(p_partkey % 30 AS STRING), '.', CAST(p_partkey % 254 AS STRING), '.', CAST(p_size AS STRING)) AS start_ip,
       concat('10.', CAST(p_partkey % 30 AS STRING), '.', CAST(p_partkey % 254 + p_partkey % 3 AS STRING), '.', CASE WHEN p_partkey % 3 = 0
              THEN CAST(p_size + p_partkey % 200 AS STRING) ELSE CAST(p_partkey * 7 % 256 AS STRING) END) AS end_ip
FROM part
"""

GEO_LOCATIONS = """
SELECT n_nationkey AS geoname_id, substr(r_name, 1, 2) AS continent_code, r_name AS continent_name,
       substr(n_name, 1, 2) AS country_iso_code, n_name AS country_name,
       concat('S', CAST(n_nationkey AS STRING)) AS subdivision_iso_code,
       concat('State ', CAST(n_nationkey AS STRING)) AS subdivision_name,
       CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE concat('City ', CAST(n_nationkey AS STRING)) END AS city_name,
       500 + n_nationkey AS metro_code, concat(r_name, '/', n_name) AS time_zone,
       r_name = 'EUROPE' AS is_in_european_union
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# One archive path per order, with blanks around some of them.
MANIFEST = """
SELECT concat('crawl-data/CC-MAIN-2024-33/segments/', CAST(o_custkey AS STRING), '/warc/CC-MAIN-',
              CAST(o_orderkey AS STRING), '.warc.gz') AS path
FROM orders
"""

CRAWL_INDEXES = """
SELECT DISTINCT concat('https://data.example.org/crawl-data/CC-MAIN-', CAST(2013 + o_custkey % 12 AS STRING), '-',
                       CAST(10 + o_orderkey % 40 AS STRING), '/warc.paths.gz') AS url
FROM orders
"""

# Two ledger rows per order; some failed, some parts with only one of the two tasks.
LEDGER = """
SELECT task, CASE WHEN o_orderkey % lost = 0 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN o_orderkey % lost = 0 THEN concat(task, ': no such archive') END AS error,
       CAST(2018 + o_orderkey % 7 AS STRING) AS year, concat('warc_part_', CAST(o_orderkey AS STRING)) AS part,
       took
FROM (SELECT o_orderkey, 'geo' AS task, 17 AS lost, 2 AS took FROM orders WHERE o_orderkey % 31 <> 0
      UNION ALL SELECT o_orderkey, 'script' AS task, 23 AS lost, 4 AS took FROM orders) AS attempts
"""

# Sub-word vocabulary: whole words and continuations found in the page URLs.
VOCABULARY = """
SELECT 'com' AS token UNION ALL SELECT 'example' UNION ALL SELECT 'www' UNION ALL SELECT 'blog'
UNION ALL SELECT DISTINCT substr(split_part(split_part(url, '//', 2), '.', 2), 1, 4) FROM pages
UNION ALL SELECT DISTINCT substr(split_part(split_part(url, '//', 2), '.', 1), 1, 2) FROM pages
UNION ALL SELECT DISTINCT concat('##', substr(split_part(split_part(url, '//', 2), '.', 2), 3, 2)) FROM pages
UNION ALL SELECT DISTINCT concat('##', substr(split_part(split_part(url, '//', 2), '.', 1), 3, 3)) FROM pages
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """One of the texts above over the tables of a folder."""
    tables = ("pages", "lineitem", "orders", "part", "nation", "region")
    used = {name: table(spark, sf_dir, name) for name in tables if f"FROM {name}" in text or f"JOIN {name}" in text}
    for name in used:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name}", f"JOIN {{{name}}}")
    return spark.sql(text, **used)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, CRAWL_PAGES)


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, GEO_BLOCKS)


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived(spark, sf_dir, GEO_LOCATIONS)
