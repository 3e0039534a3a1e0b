"""Geographic enrichment of IP addresses by longest-prefix match.

A range condition would compare every address with every block. Here each
distinct address is masked once per prefix length that occurs among the blocks
(at most 33 for IPv4 and 129 for IPv6) and meets its blocks by an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    FloatType,
    IntegerType,
    StringType,
)

from pageloom.functions.ip import cidr_key, ip_key, mask, range_cover
from pageloom.operators.joins import skew_join

# The result columns of a lookup, in order.
GEO_18: dict[str, DataType] = {
    "is_anonymous_proxy": BooleanType(),
    "is_satellite_provider": BooleanType(),
    "is_hosting_provider": BooleanType(),
    "postal_code": StringType(),
    "latitude": FloatType(),
    "longitude": FloatType(),
    "accuracy_radius": IntegerType(),
    "is_anycast": BooleanType(),
    "continent_code": StringType(),
    "continent_name": StringType(),
    "country_iso_code": StringType(),
    "country_name": StringType(),
    "subdivision_iso_code": StringType(),
    "subdivision_name": StringType(),
    "city_name": StringType(),
    "metro_code": IntegerType(),
    "time_zone": StringType(),
    "is_in_european_union": BooleanType(),
}
GEO_13 = {name: kind for name, kind in GEO_18.items() if not name.startswith("is_")}

_NET = ["_family", "_prefix_len", "_hi", "_lo"]


def _field(struct: str, field: str, absent: int, kind: str) -> Column:
    # Never NULL, so that the joins below need no NULL tests on the parsed text.
    return F.coalesce(F.col(f"{struct}.{field}"), F.lit(absent).cast(kind)).alias(f"_{field}")


def _networks(blocks: DataFrame) -> DataFrame:
    """Blocks with their network as flat columns; unreadable ones get the family -1."""
    keyed = blocks.withColumn("_net", cidr_key(F.col("network")))
    return keyed.select(
        *blocks.columns,
        _field("_net", "family", -1, "int"),
        _field("_net", "prefix_len", -1, "int"),
        _field("_net", "hi", 0, "bigint"),
        _field("_net", "lo", 0, "bigint"),
    )


def _probes(ips: DataFrame, networks: DataFrame) -> DataFrame:
    """Each address once per prefix length present in its family, masked to that length.

    The table of lengths and masks has at most 163 rows whatever the input (33 IPv4
    and 129 IPv6 lengths, and one for unreadable blocks), so it is broadcast. What is
    no address has the family 0 and finds no length.
    """
    lengths = networks.select("_family", "_prefix_len").distinct()
    masks = lengths.withColumn("_mask", F.expr(mask("_family", "_prefix_len")))
    keyed = ips.withColumn("_key", ip_key(F.col("ip"))).select(
        "ip",
        _field("_key", "family", 0, "int"),
        _field("_key", "hi", 0, "bigint"),
        _field("_key", "lo", 0, "bigint"),
    )
    return keyed.join(F.broadcast(masks), "_family").select(
        "ip",
        "_family",
        "_prefix_len",
        F.col("_hi").bitwiseAND(F.col("_mask.hi")).alias("_hi"),
        F.col("_lo").bitwiseAND(F.col("_mask.lo")).alias("_lo"),
    )


def match_ips(
    ips: DataFrame, blocks: DataFrame, all_matches: bool = False, unique: bool = False, shuffled: bool = False
) -> DataFrame:
    """Distinct addresses of ``ips`` that lie in a block, with the block's columns.

    ``unique`` says that no address is there twice, so that they are not made distinct again.
    ``shuffled`` says that the blocks are many more than Spark takes them for, so that they are never broadcast.

    The longest prefix wins, and among equal networks the least row. With
    ``all_matches`` every containing block gives a row, as a range join would.
    """
    networks = _networks(blocks)
    columns = [c for c in blocks.columns if c != "ip"]
    probes = _probes(ips.select("ip") if unique else ips.select("ip").distinct(), networks)
    matched = skew_join(probes, networks.hint("merge") if shuffled else networks, _NET)
    if all_matches:
        return matched.select("ip", *columns)
    # Least of (-length, row): an aggregate that combines before the shuffle.
    ranked = F.struct((-F.col("_prefix_len")).alias("_rank"), *columns)
    best = matched.groupBy("ip").agg(F.min(ranked).alias("_best"))
    return best.select("ip", *[F.col(f"_best.{c}").alias(c) for c in columns])


def ip_range_join(facts: DataFrame, blocks: DataFrame, all_matches: bool = False) -> DataFrame:
    """All rows of ``facts`` with the block that contains their ``ip``, or NULLs."""
    return skew_join(facts, match_ips(facts, blocks, all_matches), ["ip"], "left")


def _span_networks(spans: DataFrame, first: str, last: str) -> DataFrame:
    """Each network that a span is made up of, with the span's width and columns as ``_span``."""
    columns = _span_columns(spans)
    # Spans are short rows, of which one split of a file holds millions; Python takes most of the time for each.
    dealt = spans.repartition(_row_hash(spans))
    covered = dealt.select(*columns, range_cover(F.col(first), F.col(last)).alias("_cover"))
    row = F.struct(F.col("_cover.width").alias("_width"), *columns).alias("_span")
    # Outer, as for a plain explode Spark infers a filter that works out the cover a second time.
    return covered.select(row, F.explode_outer("_cover.networks").alias("network")).where("network IS NOT NULL")


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()])


def _span_columns(spans: DataFrame) -> list[str]:
    return [c for c in spans.columns if c != "ip"]


def match_spans(ips: DataFrame, spans: DataFrame, first: str = "start_ip", last: str = "end_ip", all_matches: bool = False) -> DataFrame:
    """Distinct addresses of ``ips`` that lie in a span of addresses, with the span's columns.

    A span need not be a network: it is taken apart into the fewest networks that make it up (62
    at most for IPv4, 254 for IPv6), which meet the addresses as in ``match_ips``. They do not overlap, so a span is met
    once. The narrowest span wins, and among equally wide ones the least row; with ``all_matches``
    every span that holds the address gives a row, as a range join would. What is no span is in ``span_rejects``.
    """
    networks = _span_networks(spans, first, last)
    if not all_matches:
        # All addresses of a network have the same least span among those it is a part of.
        networks = networks.groupBy("network").agg(F.min("_span").alias("_span"))
    # Spark takes the networks for as large as the table of spans, and would send them through the driver.
    matched = match_ips(ips, networks, all_matches=True, shuffled=True)
    if not all_matches:
        matched = matched.groupBy("ip").agg(F.min("_span").alias("_span"))
    return matched.select("ip", *[F.col(f"_span.{c}").alias(c) for c in _span_columns(spans)])


def ip_span_join(facts: DataFrame, spans: DataFrame, first: str = "start_ip", last: str = "end_ip", all_matches: bool = False) -> DataFrame:
    """All rows of ``facts`` with the span that holds their ``ip``, or NULLs.

    With ``all_matches`` the facts take the networks they lie in, and the spans join those: the pairs
    of a fact and a span, which may be far more than both, are made last and not shuffled again.
    """
    if not all_matches:
        return skew_join(facts, match_spans(facts, spans, first, last), ["ip"], "left")
    networks = _span_networks(spans, first, last)
    met = match_ips(facts, networks.select("network").distinct(), all_matches=True, shuffled=True)
    placed = skew_join(facts, met.withColumnRenamed("network", "_network"), ["ip"], "left")
    # Facts in no network meet no span; a NULL would gather them in one task.
    nowhere = F.concat(F.lit("-"), _row_hash(facts).cast("string"))
    keyed = placed.withColumn("_network", F.coalesce("_network", nowhere))
    held = skew_join(keyed, networks.withColumnRenamed("network", "_network").hint("merge"), ["_network"], "left")
    return held.select("*", *[F.col(f"_span.{c}").alias(c) for c in _span_columns(spans)]).drop("_network", "_span")


def span_rejects(spans: DataFrame, first: str = "start_ip", last: str = "end_ip") -> DataFrame:
    """Rows whose ends are no addresses, are of two families, or stand in the wrong order."""
    return spans.where(range_cover(F.col(first), F.col(last))["networks"].isNull())


def with_locations(blocks: DataFrame, locations: DataFrame) -> DataFrame:
    """Blocks with the columns of their location, matched on ``geoname_id``; unmatched kept."""
    return skew_join(blocks, locations, ["geoname_id"], "left")


def geo_columns(df: DataFrame, fields: dict[str, DataType]) -> DataFrame:
    """The lookup columns with their types; a column the tables lack is NULL."""
    have = set(df.columns)
    return df.select(
        "ip",
        *[
            (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in fields.items()
        ],
    )


def lookup_ips(
    ips: DataFrame, blocks: DataFrame, locations: DataFrame, fields: dict[str, DataType] = GEO_13, unique: bool = False
) -> DataFrame:
    """One row of lookup columns per distinct matched address."""
    return geo_columns(match_ips(ips, with_locations(blocks, locations), unique=unique), fields)


def enrich_by_ip(
    facts: DataFrame, blocks: DataFrame, locations: DataFrame, fields: dict[str, DataType] = GEO_13
) -> DataFrame:
    """All rows of ``facts`` with the lookup columns of their ``ip``; NULLs when unknown."""
    return skew_join(facts, lookup_ips(facts, blocks, locations, fields), ["ip"], "left")


def ip_rejects(facts: DataFrame) -> DataFrame:
    """Texts in ``ip`` that are no address, and how many rows have them."""
    counts = facts.groupBy("ip").agg(F.count("*").alias("n_rows"))
    return counts.where(ip_key(F.col("ip")).isNull())
