"""Queries on page features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.catalog.registry import query, with_inputs
from pageloom.functions import html, js
from pageloom.plans.extraction import TAGS, distinct_emails, script_features, with_tags

_CLEAN = r"""
SELECT page_id, ip, host, server, regexp_replace(
    replace(replace(lower(trim(html)), chr(9), ' '), chr(10), ''), '<!--.*?-->', '', 'gs') AS html
FROM crawl_pages
"""

_TAG_LISTS = r"""
SELECT page_id, ip, host, server, html,
    regexp_extract_all(html, '<script(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS scripts,
    regexp_extract_all(html, '<a\s(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS links,
    regexp_extract_all(html, '<meta\s(?:[^>"'']|"[^"]*"|''[^'']*'')*>') AS metas
FROM clean
"""


def _attribute_list(tags: str, name: str) -> str:
    value = rf"""trim(regexp_extract(t, '\s{name}\s*=\s*("[^"]*"|''[^'']*''|[^\s>"'']+)', 1), chr(34) || chr(39))"""
    return f"list_filter(list_transform({tags}, lambda t: {value}), lambda v: v <> '')"


def _last_meta(name: str) -> str:
    tag = rf"""list_filter(metas, lambda t: contains(t, 'name="{name}"'))[-1]"""
    return rf"""CASE WHEN {tag} IS NOT NULL THEN regexp_extract({tag}, '\scontent="([^"]*)"', 1) END"""


_FEATURES = rf"""
SELECT page_id, ip, host, server,
    CASE WHEN contains(html, '<title>') THEN
        replace(replace(trim(regexp_extract(html, '<title>([^<]*)', 1)), '&quot;', '"'), '&amp;', '&')
        ELSE chr(65533) END AS page_title,
    {_last_meta('description')} AS page_description,
    {_last_meta('keywords')} AS keywords,
    list_filter({_attribute_list('links', 'href')},
        lambda v: regexp_full_match(v, '(mailto:)?[a-z0-9_.+-]+@[a-z0-9-]+\.[a-z0-9.-]+')) AS emails,
    {_attribute_list('scripts', 'src')} AS srcs,
    list_filter({_attribute_list('scripts', 'src')}, lambda v: NOT starts_with(v, 'data:')) AS kept_srcs,
    {_attribute_list('scripts', 'type')} AS types
FROM tag_lists
"""

# The page feature tables, for this and the other catalog modules.
FEATURE_TEXTS = {
    "crawl_pages": inputs.CRAWL_PAGES,
    "clean": _CLEAN,
    "tag_lists": _TAG_LISTS,
    "features": _FEATURES,
}


def features_oracle(body: str, **texts: str) -> str:
    return with_inputs(body, **FEATURE_TEXTS, **texts)


def piped(column: str) -> str:
    return f"coalesce(array_to_string({column}, '|'), '')"


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_tags(inputs.pages(spark, sf_dir))


def script_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page features as the library analyses take them."""
    return script_features(inputs.pages(spark, sf_dir))


_SPACED = "SELECT page_id, concat('  ', replace(html, '><', concat('>', chr(10), chr(9), '<')), ' ') AS html FROM pages"


@query(
    "html_normalize",
    "SELECT page_id, lower(trim(replace(replace(replace(html, '><', '> <'), chr(9), ' '), chr(10), ''))) AS html "
    "FROM pages",
)
def html_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    spaced = inputs.derived(spark, sf_dir, _SPACED)
    return spaced.select("page_id", html.normalize_html(F.col("html")).alias("html"))


@query("page_title", features_oracle("SELECT page_id, page_title FROM features"))
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("page_id", html.title_of(F.col(TAGS)).alias("page_title"))


@query("page_meta", features_oracle("SELECT page_id, page_description, keywords FROM features"))
def page_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select(
        "page_id",
        html.meta_of(F.col(TAGS), "description").alias("page_description"),
        html.meta_of(F.col(TAGS), "keywords").alias("keywords"),
    )


@query("page_emails", features_oracle("SELECT page_id, CAST(i AS INTEGER) AS pos, emails[i + 1] AS email "
                                      "FROM (SELECT page_id, emails, unnest(range(len(emails))) AS i FROM features)"))
def page_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tagged(spark, sf_dir).select("page_id", F.posexplode(html.emails_of(F.col(TAGS))).alias("pos", "email"))


@query("script_srcs", features_oracle(f"SELECT page_id, {piped('srcs')} AS script_src_attrs FROM features"))
def script_srcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    srcs = html.script_srcs_of(F.col(TAGS))
    return _tagged(spark, sf_dir).select("page_id", js.join_piped(srcs).alias("script_src_attrs"))


@query("script_srcs_no_data", features_oracle(f"SELECT page_id, {piped('kept_srcs')} AS script_src_attrs FROM features"))
def script_srcs_no_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    srcs = html.script_srcs_of(F.col(TAGS), keep_data_uris=False)
    return _tagged(spark, sf_dir).select("page_id", js.join_piped(srcs).alias("script_src_attrs"))


@query("script_types", features_oracle(f"SELECT page_id, {piped('types')} AS script_type_attrs FROM features"))
def script_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = html.script_types_of(F.col(TAGS))
    return _tagged(spark, sf_dir).select("page_id", js.join_piped(types).alias("script_type_attrs"))


@query("distinct_emails", features_oracle("SELECT DISTINCT unnest(emails) AS email FROM features"))
def email_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_emails(inputs.pages(spark, sf_dir))


@query(
    "year_tag",
    features_oracle(f"SELECT '2024' AS year, host, {piped('emails')} AS emails FROM features"),
)
def year_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = script_table(spark, sf_dir).withColumn("year", F.lit("2024"))
    return table.select("year", "host", js.join_piped(F.col("emails")).alias("emails"))


@query(
    "pipe_join",
    features_oracle(
        f"SELECT page_id, ip, host, server, {piped('emails')} AS emails, {piped('kept_srcs')} AS script_src_attrs "
        "FROM features"
    ),
)
def pipe_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = script_table(spark, sf_dir)
    return table.withColumns({c: js.join_piped(F.col(c)) for c in ("emails", "script_src_attrs")})


@query(
    "pipe_split",
    with_inputs(
        "SELECT l_orderkey, l_linenumber, CAST(i AS INTEGER) AS pos, parts[i + 1] AS src FROM ("
        "SELECT l_orderkey, l_linenumber, parts, unnest(range(len(parts))) AS i FROM ("
        "SELECT l_orderkey, l_linenumber, string_split(script_src_attrs, '|') AS parts FROM piped_srcs))",
        piped_srcs=inputs.PIPED_SRCS,
    ),
)
def pipe_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.derived(spark, sf_dir, inputs.PIPED_SRCS)
    return rows.select(
        "l_orderkey", "l_linenumber", F.posexplode(js.split_piped(F.col("script_src_attrs"))).alias("pos", "src")
    )


_ESCAPED = """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN concat('plain ', url)
    WHEN page_id % 3 = 1 THEN concat('caf', chr(92), 'xc3', chr(92), 'xa9 ', chr(92), 'xff ', url)
    END AS text FROM pages
"""


@query(
    "unescape_bytes",
    "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN concat('plain ', url) "
    "WHEN page_id % 3 = 1 THEN concat('caf', chr(233), ' ', chr(65533), ' ', url) END AS text FROM pages",
)
def unescape_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    escaped = inputs.derived(spark, sf_dir, _ESCAPED)
    return escaped.select("page_id", html.unescape_bytes(F.col("text")).alias("text"))
