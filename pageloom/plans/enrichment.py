"""The address table with its geographic columns, and joins of it with page features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.geo import GEO_13, GEO_18, lookup_ips
from pageloom.operators.joins import null_safe_join, skew_join
from pageloom.operators.profile import dedupe_by_ip

_JOIN_KEYS = ["ip", "host", "server"]


def _lookup_struct(hosts: DataFrame, blocks: DataFrame, locations: DataFrame, fields: dict, unique: bool = False) -> DataFrame:
    found = lookup_ips(hosts, blocks, locations, fields, unique)
    packed = found.select("ip", F.struct(*fields).alias("ip_info"))
    return skew_join(hosts, packed, ["ip"], "left")


def ip_geo_full(hosts: DataFrame, blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """Every row of ``hosts`` with the 18 lookup columns of its ``ip``; NULLs when unknown."""
    looked_up = _lookup_struct(hosts, blocks, locations, GEO_18)
    return looked_up.select(*hosts.columns, "ip_info.*")


def ip_geo_table(hosts: DataFrame, blocks: DataFrame, locations: DataFrame, year: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per ``ip`` of (ip, host, server) with the 13 lookup columns, and ``year`` if given.

    Rows are reduced to one per address first, so each address is looked up and
    shuffled once. With ``by``, columns of ``hosts``, there is one row per address for each of
    their values, and an address that several of them have is still looked up once.
    """
    hosts = dedupe_by_ip(hosts.select(*by, *_JOIN_KEYS), *by)
    table = _lookup_struct(hosts, blocks, locations, GEO_13, unique=not by)
    tag = [] if year is None else [F.lit(year).alias("year")]
    return table.select(*by, *_JOIN_KEYS, *tag, "ip_info.*").dropna("all")


def join_script_geo(
    features: DataFrame, geo: DataFrame, how: str = "inner", null_safe: bool = False, hot: Column | None = None
) -> DataFrame:
    """Page features with the address table on ip, host and server, key columns once.

    A NULL server matches nothing unless ``null_safe``. ``hot`` names keys whose rows are
    to be spread over salts (see ``operators.joins``).
    """
    right = geo.drop("year") if "year" in features.columns else geo
    if null_safe:
        return null_safe_join(features, right, _JOIN_KEYS, how)
    return skew_join(features, right, _JOIN_KEYS, how, hot)
