"""Queries on URL, address and script-source expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.catalog.registry import query, with_inputs
from pageloom.functions import ip, js, url
from pageloom.operators.profile import topic_count
from pageloom.operators.topics import domain_topics

_DOMAIN = r"regexp_extract(host, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1)"


@query("url_domain", with_inputs(f"SELECT page_id, {_DOMAIN} AS domain FROM odd_urls", odd_urls=inputs.ODD_URLS))
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.ODD_URLS)
    return rows.select("page_id", url.url_domain(F.col("host")).alias("domain"))


@query(
    "url_hostname",
    with_inputs(
        rf"SELECT page_id, nullif(lower(regexp_replace({_DOMAIN}, '^.*@|:[0-9]+$', '', 'g')), '') AS hostname FROM odd_urls",
        odd_urls=inputs.ODD_URLS,
    ),
)
def url_hostname(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.ODD_URLS)
    return rows.select("page_id", url.url_hostname(F.col("host")).alias("hostname"))


_LIB = r"nullif(regexp_extract(src, '/?(?:js\.)?([^/?]+\.js)', 1), '')"


@query(
    "js_lib_names",
    with_inputs(
        rf"SELECT l_orderkey, l_linenumber, regexp_replace({_LIB}, '\.min\.', '.', 'g') AS js_lib FROM dirty_srcs",
        dirty_srcs=inputs.DIRTY_SRCS,
    ),
)
def js_lib_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.DIRTY_SRCS)
    names = js.js_lib_names(F.array("src"))
    return rows.select("l_orderkey", "l_linenumber", F.get(names, F.lit(0)).alias("js_lib"))


@query(
    "js_lib_basename",
    with_inputs(
        r"""SELECT l_orderkey, l_linenumber, CASE WHEN contains(base, 'js') AND short <> 'js' THEN short END AS js_lib
        FROM (SELECT *, regexp_replace(replace(base, '.min.', '.'), '^js\.', '') AS short FROM (
          SELECT l_orderkey, l_linenumber, string_split(split_part(split_part(regexp_replace(
            trim(src, chr(92) || chr(39)), '^(https?:)?//[^/?#]*', ''), '?', 1), '#', 1), '/')[-1] AS base
          FROM dirty_srcs))""",
        dirty_srcs=inputs.DIRTY_SRCS,
    ),
)
def js_lib_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.DIRTY_SRCS)
    return rows.select("l_orderkey", "l_linenumber", js.js_lib_basename(F.col("src")).alias("js_lib"))


@query(
    "src_wrapper_clean",
    with_inputs(
        "SELECT l_orderkey, l_linenumber, trim(src, chr(92) || chr(39)) AS src FROM dirty_srcs",
        dirty_srcs=inputs.DIRTY_SRCS,
    ),
)
def src_wrapper_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.DIRTY_SRCS)
    return rows.withColumn("src", js.clean_src(F.col("src")))


KEPT_SRCS = (
    "array_to_string(list_filter(string_split(script_src_attrs, '|'), lambda s: NOT starts_with(s, 'data:')), '|')"
)


@query(
    "drop_data_uris",
    with_inputs(
        f"SELECT l_orderkey, l_linenumber, {KEPT_SRCS} AS script_src_attrs FROM piped_srcs",
        piped_srcs=inputs.PIPED_SRCS,
    ),
)
def drop_data_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.PIPED_SRCS)
    return rows.withColumn("script_src_attrs", js.drop_data_uris(F.col("script_src_attrs")))


@query(
    "vendor_flag",
    with_inputs(
        "SELECT l_orderkey, l_linenumber, script_src_attrs, true AS is_shopify FROM piped_srcs "
        "WHERE contains(script_src_attrs, 'shopify')",
        piped_srcs=inputs.PIPED_SRCS,
    ),
)
def vendor_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.PIPED_SRCS)
    flag = js.uses_vendor(js.split_piped(F.col("script_src_attrs")), "shopify")
    return rows.withColumn("is_shopify", flag).where("is_shopify")


@query(
    "url_rlike_filter",
    with_inputs(
        "SELECT host, 'huggingface' AS site FROM crawl_urls WHERE regexp_matches(host, 'huggingface.co') "
        "UNION ALL SELECT host, 'openai' FROM crawl_urls WHERE regexp_matches(host, 'openai.com')",
        crawl_urls=inputs.CRAWL_URLS,
    ),
)
def url_rlike_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.CRAWL_URLS).select("host")
    found = [
        rows.where(F.col("host").rlike(pattern)).select("host", F.lit(site).alias("site"))
        for site, pattern in (("huggingface", url.HUGGINGFACE), ("openai", url.OPENAI))
    ]
    return found[0].unionByName(found[1])


@query(
    "pdf_urls",
    with_inputs("SELECT host FROM crawl_urls WHERE regexp_matches(host, '.pdf', 'i')", crawl_urls=inputs.CRAWL_URLS),
)
def pdf_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.CRAWL_URLS)
    return rows.where(F.col("host").rlike(url.PDF)).select("host")


@query(
    "pdf_topic_filter",
    with_inputs(
        r"SELECT host, 'cloud' AS topic FROM crawl_urls WHERE regexp_matches(host, '.pdf', 'i') "
        r"AND regexp_matches(host, '\b(aws|amazon|case study)', 'i') "
        "UNION ALL SELECT host, 'arxiv' FROM crawl_urls WHERE regexp_matches(host, '.pdf', 'i') "
        "AND regexp_matches(host, '(i?)(arxiv)')",
        crawl_urls=inputs.CRAWL_URLS,
    ),
)
def pdf_topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pdfs = pdf_urls(spark, sf_dir)
    found = [
        pdfs.where(F.col("host").rlike(pattern)).select("host", F.lit(topic).alias("topic"))
        for topic, pattern in (("cloud", url.CLOUD), ("arxiv", url.ARXIV))
    ]
    return found[0].unionByName(found[1])


_OCTETS = [f"TRY_CAST(split_part(ip, '.', {i}) AS BIGINT)" for i in (1, 2, 3, 4)]
IP_INT = (
    r"CASE WHEN regexp_full_match(ip, '((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.|$)){4}') THEN "
    f"{_OCTETS[0]} * 16777216 + {_OCTETS[1]} * 65536 + {_OCTETS[2]} * 256 + {_OCTETS[3]} END"
)


@query(
    "ip_to_int",
    with_inputs(f"SELECT l_orderkey, l_linenumber, ip, {IP_INT} AS ip_int FROM line_ips", line_ips=inputs.LINE_IPS),
)
def ip_to_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.LINE_IPS)
    return rows.withColumn("ip_int", ip.ip_to_int(F.col("ip")))


_NET = "regexp_extract(network, '^[^/]*')"
_START = " + ".join(
    f"CAST(split_part({_NET}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4)
)
_SIZE = "CAST(power(2, 32 - CAST(split_part(network, '/', 2) AS INTEGER)) AS BIGINT)"
RANGES = f"SELECT *, {_START} AS cidr_start, {_START} + {_SIZE} - 1 AS cidr_end FROM blocks"


@query(
    "cidr_to_range",
    with_inputs(
        "SELECT network, geoname_id, cidr_start, cidr_end, concat(CAST((cidr_end >> 24) & 255 AS STRING), '.', "
        "CAST((cidr_end >> 16) & 255 AS STRING), '.', CAST((cidr_end >> 8) & 255 AS STRING), '.', "
        "CAST(cidr_end & 255 AS STRING)) AS broadcast_address FROM ranges",
        blocks=inputs.PART_BLOCKS,
        ranges=RANGES,
    ),
)
def cidr_to_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.PART_BLOCKS)
    return rows.withColumn("_range", ip.cidr_to_range(F.col("network"))).select(
        "network",
        "geoname_id",
        F.col("_range.start_ip").alias("cidr_start"),
        F.col("_range.end_ip").alias("cidr_end"),
        ip.broadcast_address(F.col("network")).alias("broadcast_address"),
    )


_PAGE_DOMAINS = rf"SELECT page_id, {_DOMAIN.replace('host', 'url')} AS domain FROM pages"
_REACH = """
SELECT word, a AS start, max(b) AS stop FROM (
  SELECT word, a, unnest(range(a + 1, length(word) + 1)) AS b
  FROM (SELECT word, unnest(range(length(word))) AS a FROM words)) AS spans
WHERE CASE WHEN a = 0 THEN substr(word, 1, b) ELSE concat('##', substr(word, a + 1, b - a)) END
  IN (SELECT token FROM vocabulary)
GROUP BY word, a
"""
_TOPICS = with_inputs(
    """
    SELECT p.page_id, p.domain, coalesce(t.topics, '') AS topics FROM page_domains p LEFT JOIN (
      SELECT domain, string_agg(head, '|' ORDER BY i) AS topics FROM (
        SELECT domain, i, regexp_extract_all(lower(domain), '[a-z0-9]+')[i] AS word FROM (
          SELECT DISTINCT domain, unnest(range(1, len(regexp_extract_all(lower(domain), '[a-z0-9]+')) + 1)) AS i
          FROM page_domains)) AS placed
      JOIN (SELECT w.word, substr(w.word, 1, r.stop) AS head FROM walk w JOIN reach r ON r.word = w.word AND r.start = 0
            WHERE w.pos = length(w.word)) AS heads USING (word)
      WHERE regexp_full_match(head, '[a-z]+') GROUP BY domain) AS t ON t.domain = p.domain
    """,
    vocabulary=inputs.VOCABULARY,
    page_domains=_PAGE_DOMAINS,
    words="SELECT DISTINCT unnest(regexp_extract_all(lower(domain), '[a-z0-9]+')) AS word FROM page_domains",
    reach=_REACH,
    walk="SELECT word, 0 AS pos FROM words UNION ALL "
    "SELECT w.word, r.stop FROM walk w JOIN reach r ON r.word = w.word AND r.start = w.pos",
).replace("WITH ", "WITH RECURSIVE ", 1)


def _page_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", url.url_domain(F.col("url")).alias("domain"))
    return domain_topics(pages, inputs.derived(spark, sf_dir, inputs.VOCABULARY))


@query("domain_topics", _TOPICS)
def topics_by_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_topics(spark, sf_dir).select("page_id", "domain", js.join_piped(F.col("domain_topics")).alias("topics"))


@query(
    "domain_words",
    r"SELECT page_id, array_to_string(regexp_extract_all(lower(domain), '\b[a-z]+\b'), '|') AS topics "
    f"FROM ({_PAGE_DOMAINS})",
)
def topics_by_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", url.url_domain(F.col("url")).alias("domain"))
    return domain_topics(pages).select("page_id", js.join_piped(F.col("domain_topics")).alias("topics"))


@query(
    "topic_count",
    f"SELECT count(*) AS n_rows FROM ({_PAGE_DOMAINS}) "
    r"WHERE list_contains(regexp_extract_all(lower(domain), '\b[a-z]+\b'), 'com')",
)
def com_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", url.url_domain(F.col("url")).alias("domain"))
    return topic_count(domain_topics(pages), "domain_topics", "com")


@query(
    "manifest_local_paths",
    with_inputs(
        r"SELECT path, concat('/data/common_crawl/', regexp_replace(string_split(path, '/')[-1], '\.[^.]*$', '')) "
        "AS local_path FROM manifest",
        manifest=inputs.MANIFEST,
    ),
)
def manifest_local_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.MANIFEST)
    return rows.withColumn("local_path", url.local_path(F.col("path"), "/data/common_crawl/"))


@query(
    "crawl_year",
    with_inputs("SELECT url, string_split(url, '-')[-2] AS year FROM crawl_indexes", crawl_indexes=inputs.CRAWL_INDEXES),
)
def crawl_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.CRAWL_INDEXES)
    return rows.withColumn("year", url.crawl_year(F.col("url")))
