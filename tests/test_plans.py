"""What the physical plans must and must not hold."""

import pytest

from pageloom.catalog import QUERIES

NATIVE = [
    "page_title", "page_meta", "page_emails", "script_srcs_no_data", "url_domain", "js_lib_names", "ip_to_int",
    "cidr_to_range", "top_js_libs", "ip_range_join", "ip_geo_13", "domain_topics", "manifest_split", "dedupe_by_ip",
]


def physical(spark, tables, name):
    return QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_nested_loops(spark, tables, name):
    plan = physical(spark, tables, name)
    assert "Python" not in plan and "Pandas" not in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_filters_and_columns_reach_the_scan(spark, tables):
    rows = QUERIES["parquet_scan"](spark, tables).where("l_quantity > 30")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,30" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_top_k_is_no_full_sort(spark, tables):
    assert "TakeOrderedAndProject" in physical(spark, tables, "top_js_libs")


def test_year_filter_prunes_partitions(spark, tables):
    plan = physical(spark, tables, "year_partitioned_scan")
    assert "PartitionFilters: [isnotnull(year" in plan


def test_page_text_is_cut_once(spark, tables):
    # The tag pattern appears once, however many features are read from the tags.
    assert physical(spark, tables, "null_profile").count("noembed") == 1
