"""Queries on JavaScript libraries: popularity and co-occurrence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pageloom.catalog.extraction import features_oracle, script_table
from pageloom.catalog.registry import query
from pageloom.operators import libs
from pageloom.session import written

_PAIRS = r"""
SELECT DISTINCT domain, js_lib FROM (
  SELECT regexp_extract(host, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) AS domain,
         regexp_replace(nullif(regexp_extract(src, '/?(?:js\.)?([^/?]+\.js)', 1), ''), '\.min\.', '.', 'g') AS js_lib
  FROM (SELECT host, unnest(kept_srcs) AS src FROM features))
WHERE domain IS NOT NULL AND js_lib IS NOT NULL
"""
_MET = """
SELECT a.js_lib AS js_lib1, b.js_lib AS js_lib2, count(DISTINCT a.domain) AS domain_count
FROM pairs a JOIN pairs b ON a.domain = b.domain WHERE a.js_lib <> b.js_lib GROUP BY a.js_lib, b.js_lib
"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return libs.domain_lib_pairs(script_table(spark, sf_dir))


def _stored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as a table, for the analyses that read them more than once."""
    return written(_pairs(spark, sf_dir), "domain-libs")


@query("domain_lib_pairs", features_oracle("SELECT domain, js_lib FROM pairs", pairs=_PAIRS))
def domain_lib_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir)


@query(
    "js_lib_domain_counts",
    features_oracle("SELECT js_lib, count(domain) AS domain_count FROM pairs GROUP BY js_lib", pairs=_PAIRS),
)
def js_lib_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return libs.lib_domain_counts(_pairs(spark, sf_dir))


@query(
    "top_js_libs",
    features_oracle(
        "SELECT js_lib, count(domain) AS domain_count FROM pairs GROUP BY js_lib "
        "ORDER BY domain_count DESC, js_lib LIMIT 100",
        pairs=_PAIRS,
    ),
)
def top_js_libs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return libs.top_libs(_pairs(spark, sf_dir), 100)


@query(
    "js_lib_cooccurrence",
    features_oracle("SELECT js_lib1, js_lib2, domain_count FROM met", pairs=_PAIRS, met=_MET),
)
def js_lib_cooccurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return libs.cooccurrence(_stored_pairs(spark, sf_dir))


@query(
    "js_lib_cooccurrence_top",
    features_oracle(
        "SELECT js_lib1, js_lib2, domain_count FROM met ORDER BY domain_count DESC, js_lib1, js_lib2 LIMIT 50",
        pairs=_PAIRS,
        met=_MET,
    ),
)
def js_lib_cooccurrence_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return libs.top_cooccurrence(_stored_pairs(spark, sf_dir), 50)


@query(
    "js_lib_cooccurrence_frequent",
    features_oracle("SELECT js_lib1, js_lib2, domain_count FROM met WHERE domain_count >= 3", pairs=_PAIRS, met=_MET),
)
def js_lib_cooccurrence_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return libs.cooccurrence(_stored_pairs(spark, sf_dir), min_domains=3)
