"""Queries on address lookup and on joins of page features with the address table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.catalog import inputs
from pageloom.catalog.registry import query, with_inputs
from pageloom.catalog.scalars import IP_INT, RANGES
from pageloom.operators import geo
from pageloom.operators.profile import dedupe_by_ip
from pageloom.plans.enrichment import ip_geo_full, ip_geo_table, join_script_geo
from pageloom.session import scratch_dir
from pageloom.sources.geo import read_geo_csv
from pageloom.sources.tabular import write_csv

_HOSTS = "SELECT page_id, ip, host, server FROM crawl_pages"


def _oracle(body: str, **texts: str) -> str:
    return with_inputs(body, **texts)


_LINE_INPUTS = {
    "line_ips": inputs.LINE_IPS,
    "blocks": inputs.PART_BLOCKS,
    "ranges": RANGES,
    "distinct_ips": f"SELECT ip, {IP_INT} AS ip_int FROM (SELECT DISTINCT ip FROM line_ips)",
    "best": "SELECT ip, network, geoname_id FROM (SELECT ip, network, geoname_id, row_number() OVER ("
    "PARTITION BY ip ORDER BY cidr_end - cidr_start, network, geoname_id) AS nth "
    "FROM distinct_ips JOIN ranges ON ip_int BETWEEN cidr_start AND cidr_end) WHERE nth = 1",
}


@query(
    "ip_range_join",
    _oracle(
        "SELECT l_orderkey, l_linenumber, line_ips.ip, network, geoname_id FROM line_ips LEFT JOIN best USING (ip)",
        **_LINE_INPUTS,
    ),
)
def ip_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = inputs.derived(spark, sf_dir, inputs.LINE_IPS)
    return geo.ip_range_join(facts, inputs.derived(spark, sf_dir, inputs.PART_BLOCKS))


@query(
    "ip_range_join_all",
    _oracle(
        "SELECT l_orderkey, l_linenumber, line_ips.ip, network, geoname_id FROM line_ips LEFT JOIN ("
        "SELECT ip, network, geoname_id FROM distinct_ips JOIN ranges ON ip_int BETWEEN cidr_start AND cidr_end) "
        "USING (ip)",
        **{k: v for k, v in _LINE_INPUTS.items() if k != "best"},
    ),
)
def ip_range_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = inputs.derived(spark, sf_dir, inputs.LINE_IPS)
    return geo.ip_range_join(facts, inputs.derived(spark, sf_dir, inputs.PART_BLOCKS), all_matches=True)


def _as_int(column: str) -> str:
    return "(" + " + ".join(f"CAST(split_part({column}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4)) + ")"


_SPAN_INPUTS = {
    "line_ips": inputs.LINE_IPS,
    "distinct_ips": _LINE_INPUTS["distinct_ips"],
    "spans": inputs.PART_SPANS,
    "held": f"SELECT ip, p_partkey, start_ip, end_ip, {_as_int('end_ip')} - {_as_int('start_ip')} AS width FROM distinct_ips "
    f"JOIN spans ON ip_int BETWEEN {_as_int('start_ip')} AND {_as_int('end_ip')}",
}


@query(
    "ip_span_join",
    _oracle(
        "SELECT l_orderkey, l_linenumber, line_ips.ip, p_partkey, start_ip, end_ip FROM line_ips LEFT JOIN (SELECT * FROM held "
        "QUALIFY row_number() OVER (PARTITION BY ip ORDER BY width, p_partkey) = 1) USING (ip)",
        **_SPAN_INPUTS,
    ),
)
def ip_span_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.ip_span_join(inputs.derived(spark, sf_dir, inputs.LINE_IPS), inputs.derived(spark, sf_dir, inputs.PART_SPANS))


@query(
    "ip_span_join_all",
    _oracle(
        "SELECT l_orderkey, l_linenumber, line_ips.ip, p_partkey, start_ip, end_ip FROM line_ips LEFT JOIN held USING (ip)",
        **_SPAN_INPUTS,
    ),
)
def ip_span_join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = inputs.derived(spark, sf_dir, inputs.PART_SPANS)
    return geo.ip_span_join(inputs.derived(spark, sf_dir, inputs.LINE_IPS), spans, all_matches=True)


@query(
    "geo_location_join",
    _oracle(
        "SELECT network, geoname_id, country_name, continent_name FROM blocks LEFT JOIN locations USING (geoname_id)",
        blocks=inputs.PART_BLOCKS,
        locations=inputs.GEO_LOCATIONS,
    ),
)
def geo_location_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    locations = inputs.locations(spark, sf_dir).select("geoname_id", "country_name", "continent_name")
    joined = geo.with_locations(inputs.derived(spark, sf_dir, inputs.PART_BLOCKS), locations)
    return joined.select("network", "geoname_id", "country_name", "continent_name")


_SQL_TYPES = {"boolean": "BOOLEAN", "string": "VARCHAR", "float": "FLOAT", "int": "INTEGER"}


def _select_list(fields: dict) -> str:
    absent = {"is_satellite_provider", "is_hosting_provider"}
    return ", ".join(
        f"CAST({'NULL' if name in absent else name} AS {_SQL_TYPES[kind.simpleString()]}) AS {name}"
        for name, kind in fields.items()
    )


_PAGE_INPUTS = {
    "crawl_pages": inputs.CRAWL_PAGES,
    "hosts": _HOSTS,
    "blocks": inputs.GEO_BLOCKS,
    "locations": inputs.GEO_LOCATIONS,
    "ranges": RANGES,
    "located": "SELECT ranges.*, locations.* EXCLUDE (geoname_id) FROM ranges LEFT JOIN locations USING (geoname_id)",
    "matched": "SELECT * FROM (SELECT i.ip, located.*, row_number() OVER (PARTITION BY i.ip "
    "ORDER BY cidr_end - cidr_start) AS nth FROM (SELECT ip, " + IP_INT + " AS ip_int FROM "
    "(SELECT DISTINCT ip FROM hosts)) AS i JOIN located ON ip_int BETWEEN cidr_start AND cidr_end) WHERE nth = 1",
    "survivors": "SELECT ip, host, server FROM (SELECT *, row_number() OVER (PARTITION BY ip "
    "ORDER BY host, server NULLS FIRST) AS nth FROM hosts) WHERE nth = 1",
}
_GEO13 = _select_list(geo.GEO_13)


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.pages(spark, sf_dir).select("page_id", "ip", "host", "server")


def _geo_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return inputs.blocks(spark, sf_dir), inputs.locations(spark, sf_dir)


def geo_table(spark: SparkSession, sf_dir: str, year: str | None = None) -> DataFrame:
    return ip_geo_table(_hosts(spark, sf_dir), *_geo_inputs(spark, sf_dir), year)


@query(
    "ip_geo_18",
    _oracle(
        f"SELECT page_id, hosts.ip, host, server, {_select_list(geo.GEO_18)} FROM hosts LEFT JOIN matched USING (ip)",
        **_PAGE_INPUTS,
    ),
)
def ip_geo_18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ip_geo_full(_hosts(spark, sf_dir), *_geo_inputs(spark, sf_dir))


@query(
    "ip_geo_13",
    _oracle(f"SELECT survivors.ip, host, server, {_GEO13} FROM survivors LEFT JOIN matched USING (ip)", **_PAGE_INPUTS),
)
def ip_geo_13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_table(spark, sf_dir)


@query(
    "ip_geo_14_year",
    _oracle(
        f"SELECT survivors.ip, host, server, '2024' AS year, {_GEO13} FROM survivors LEFT JOIN matched USING (ip)",
        **_PAGE_INPUTS,
    ),
)
def ip_geo_14_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo_table(spark, sf_dir, "2024")


@query(
    "enrich_by_ip",
    _oracle(f"SELECT page_id, hosts.ip, host, server, {_GEO13} FROM hosts LEFT JOIN matched USING (ip)", **_PAGE_INPUTS),
)
def enrich_by_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.enrich_by_ip(_hosts(spark, sf_dir), *_geo_inputs(spark, sf_dir))


@query(
    "geo_csv_lookup",
    _oracle(f"SELECT page_id, hosts.ip, host, server, {_GEO13} FROM hosts LEFT JOIN matched USING (ip)", **_PAGE_INPUTS),
)
def geo_csv_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = scratch_dir(spark, "blocks"), scratch_dir(spark, "locations")
    for table, path in zip(_geo_inputs(spark, sf_dir), paths):
        write_csv(table.withColumnsRenamed({"subdivision_iso_code": "subdivision_1_iso_code",
                                            "subdivision_name": "subdivision_1_name"}), path)
    blocks, locations = (read_geo_csv(spark, path) for path in paths)
    return geo.enrich_by_ip(_hosts(spark, sf_dir), blocks, locations)


@query(
    "ip_rejects",
    _oracle(
        f"SELECT ip, count(*) AS n_rows FROM line_ips WHERE ({IP_INT}) IS NULL AND NOT contains(ip, ':') GROUP BY ip",
        line_ips=inputs.LINE_IPS,
    ),
)
def ip_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geo.ip_rejects(inputs.derived(spark, sf_dir, inputs.LINE_IPS))


@query("dedupe_by_ip", _oracle("SELECT ip, host, server FROM survivors", **{
    k: _PAGE_INPUTS[k] for k in ("crawl_pages", "hosts", "survivors")}))
def one_row_per_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_by_ip(_hosts(spark, sf_dir).select("ip", "host", "server"))


_GEO_NAMES = ", ".join(f"g.{name}" for name in geo.GEO_13)
_SCRIPT_GEO = f"""
SELECT h.page_id, h.ip, h.host, h.server, {_GEO_NAMES} FROM hosts h {{join}} JOIN (
  SELECT survivors.ip, host, server, {_GEO13} FROM survivors LEFT JOIN matched USING (ip)) AS g
ON h.ip = g.ip AND h.host = g.host AND h.server = g.server
"""


@query("script_geo_inner", _oracle(_SCRIPT_GEO.format(join="INNER"), **_PAGE_INPUTS))
def script_geo_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_script_geo(_hosts(spark, sf_dir), geo_table(spark, sf_dir))


@query("script_geo_left", _oracle(_SCRIPT_GEO.format(join="LEFT"), **_PAGE_INPUTS))
def script_geo_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_script_geo(_hosts(spark, sf_dir), geo_table(spark, sf_dir), "left")


@query("script_geo_salted", _oracle(_SCRIPT_GEO.format(join="LEFT"), **_PAGE_INPUTS))
def script_geo_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left join again, with the rows of one network spread over salts."""
    return join_script_geo(_hosts(spark, sf_dir), geo_table(spark, sf_dir), "left", hot=F.col("ip").rlike(r"\A[0-9]+\.[0-9]+"))


@query(
    "script_geo_null_safe",
    _oracle(_SCRIPT_GEO.format(join="INNER").replace("h.server = g.server", "h.server IS NOT DISTINCT FROM g.server"),
            **_PAGE_INPUTS),
)
def script_geo_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_script_geo(_hosts(spark, sf_dir), geo_table(spark, sf_dir), null_safe=True)


@query(
    "dropna_all",
    _oracle(
        "SELECT CASE WHEN page_id % 7 = 0 THEN NULL ELSE ip END AS ip, server FROM hosts "
        "WHERE NOT (page_id % 7 = 0 AND server IS NULL)",
        crawl_pages=inputs.CRAWL_PAGES,
        hosts=_HOSTS,
    ),
)
def dropna_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    thinned = F.when(F.col("page_id") % 7 != 0, F.col("ip")).alias("ip")
    return _hosts(spark, sf_dir).select(thinned, "server").dropna("all")
