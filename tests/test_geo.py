"""Address lookup against a scan of all blocks."""

import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from pageloom.functions.ip import cover
from pageloom.operators import geo


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(3)
    nets = {"10.0.0.0/8", "0.0.0.0/0", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.3/32", "2001:db8::/32", "2001:db8:1::/48", "::/0"}
    nets |= {f"10.{rng.randrange(4)}.{rng.randrange(4)}.{rng.randrange(256)}/{rng.randrange(20, 33)}" for _ in range(60)}
    nets |= {f"2001:db8:{rng.randrange(4):x}::/{rng.randrange(40, 65)}" for _ in range(20)}
    blocks = [(n, i) for i, n in enumerate(sorted(nets))] + [("not a net", 999), (None, 998)]
    ips = [f"10.{rng.randrange(4)}.{rng.randrange(4)}.{rng.randrange(256)}" for _ in range(150)]
    ips += [f"2001:db8:{rng.randrange(5):x}::{rng.randrange(99):x}" for _ in range(40)] + ["-", None, "8.8.8.8", "fe80::1"]
    return (
        spark.createDataFrame([(i, n) for n, i in enumerate(ips)], "ip string, n int"),
        spark.createDataFrame(blocks, "network string, geoname_id int"),
    )


def containing(ip, blocks):
    try:
        address = ipaddress.ip_address(ip)
    except ValueError:
        return []
    found = []
    for network, geoname_id in blocks:
        try:
            net = ipaddress.ip_network(network, strict=False)
        except (ValueError, TypeError):
            continue
        if net.version == address.version and address in net:
            found.append((net.prefixlen, network, geoname_id))
    return found


def test_longest_prefix(world):
    facts, blocks = world
    table = [tuple(r) for r in blocks.collect()]
    got = {r.n: (r.network, r.geoname_id) for r in geo.ip_range_join(facts, blocks).collect()}
    rows = facts.collect()
    assert len(got) == len(rows)
    for row in rows:
        # Equal networks written with different host bits: the least text wins.
        best = min(containing(row.ip, table), key=lambda m: (-m[0], m[1], m[2]), default=(0, None, None))
        assert got[row.n] == best[1:], row


def test_all_matches(world):
    facts, blocks = world
    table = [tuple(r) for r in blocks.collect()]
    got = sorted((r.n, r.network) for r in geo.ip_range_join(facts, blocks, all_matches=True).collect() if r.network)
    want = sorted((row.n, m[1]) for row in facts.collect() for m in containing(row.ip, table))
    assert got == want


def test_plan_has_no_nested_loop(world):
    plan = geo.ip_range_join(*world)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_schemas(spark, world):
    facts, blocks = world
    locations = spark.createDataFrame([(0, "X", True)], "geoname_id int, country_name string, is_in_european_union boolean")
    full = geo.enrich_by_ip(facts, blocks, locations, geo.GEO_18)
    assert full.columns == ["ip", "n", *geo.GEO_18]
    assert {f.name: f.dataType for f in full.schema.fields if f.name in geo.GEO_18} == geo.GEO_18
    assert len(geo.GEO_13) == 13
    assert full.count() == facts.count()


def test_rejects(world):
    facts, _ = world
    assert {(r.ip, r.n_rows) for r in geo.ip_rejects(facts).collect()} == {("-", 1), (None, 1)}


def test_spans_as_by_comparing_every_pair(spark):
    draw = random.Random(4)
    spans, ips = [], []
    for k in range(120):
        low = draw.randrange(1 << 12) + (10 << 24)
        spans.append((k, str(ipaddress.IPv4Address(low)), str(ipaddress.IPv4Address(low + draw.choice([0, 1, 5, 255, 256, draw.randrange(900)])))))
        six = (0x20010DB8 << 96) + (draw.randrange(4) << 62) + draw.randrange(1 << 10)
        spans.append((1000 + k, str(ipaddress.IPv6Address(six)), str(ipaddress.IPv6Address(six + draw.choice([0, 7, 1 << 63, (1 << 64) - 1, draw.randrange(1 << 66)])))))
        ips += [(str(ipaddress.IPv4Address(draw.randrange(1 << 12) + (10 << 24))),), (str(ipaddress.IPv6Address(six + draw.randrange(-9, 1 << 64))),)]
    spans += [(2000, "0.0.0.0", "255.255.255.255"), (2001, "::", "ffff:ffff:ffff:ffff:ffff:ffff:ffff:ffff"), (3000, "10.0.0.9", "10.0.0.1"),
              (3001, "10.0.0.1", "::1"), (3002, None, "10.0.0.1"), (3003, "x", "y")]
    facts = spark.createDataFrame(ips + [("-",), (None,), ips[0]], "ip string")
    table = spark.createDataFrame(spans, "id int, start_ip string, end_ip string")

    def number(text):
        return (ipaddress.ip_address(text).version, int(ipaddress.ip_address(text)))

    sound = [s for s in spans if s[0] < 3000]
    want = [(ip, s[0]) for (ip,) in set(ips) for s in sound if number(s[1])[0] == number(ip)[0] and number(s[1]) <= number(ip) <= number(s[2])]
    got = [(r.ip, r.id) for r in geo.match_spans(facts, table, all_matches=True).collect()]
    assert sorted(got) == sorted(want) and len(want) > 300
    narrow = {r.ip: r.id for r in geo.match_spans(facts, table).collect()}
    width = {s[0]: number(s[2])[1] - number(s[1])[1] for s in sound}
    assert narrow == {ip: min((width[i], i) for p, i in want if p == ip)[1] for ip, _ in want}
    assert geo.ip_span_join(facts, table).count() == facts.count()
    assert sorted(r.id for r in geo.span_rejects(table).collect()) == [3000, 3001, 3002, 3003]


def test_a_cover_is_whole_and_least():
    for low in range(0, 40):
        for high in range(low, 40):
            nets = [ipaddress.ip_network(n) for n in cover(str(ipaddress.IPv4Address(low)), str(ipaddress.IPv4Address(high)))]
            assert sorted(int(a) for n in nets for a in n) == list(range(low, high + 1))
            assert nets == list(ipaddress.summarize_address_range(ipaddress.IPv4Address(low), ipaddress.IPv4Address(high)))


@pytest.mark.parametrize("all_matches", [False, True])
def test_networks_of_spans_do_not_pass_the_driver(spark, tmp_path, all_matches):
    """A span makes up to 62 networks, but Spark takes them for as small as the file of spans."""
    spark.range(50).selectExpr("id", "concat('10.0.', id, '.1') AS start_ip", "concat('10.0.', id + 1, '.254') AS end_ip").write.parquet(str(tmp_path / "s"))
    facts = spark.range(300).selectExpr("concat('10.0.', id % 60, '.', id % 256) AS ip", "id AS n")
    joined = geo.ip_span_join(facts, spark.read.parquet(str(tmp_path / "s")), all_matches=all_matches)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[_(family#\d+, _prefix_len|network)", plan)
    assert re.search(r"SortMergeJoin \[_family#\d+, _prefix_len", plan)
    want = sum(max(1, sum(256 * k + 1 <= a <= 256 * (k + 1) + 254 for k in range(50))) if all_matches else 1 for a in (256 * (i % 60) + i % 256 for i in range(300)))
    assert joined.count() == want


def test_all_spans_of_facts_are_paired_last(spark):
    """Pairs of a fact and a span are not shuffled: the spans join what the facts' addresses are parts of."""
    facts = spark.createDataFrame(
        [(1, "10.0.0.5", "a"), (1, "10.0.0.5", "a"), (2, "10.0.0.9", None), (3, "-", "x"), (4, None, "x"), (5, "::5", "x"), (6, "11.0.0.0", "x")],
        "n int, ip string, network string",
    ).withColumn("extra", F.create_map(F.lit("k"), "n"))
    rows = [(1, "10.0.0.1", "10.0.0.6"), (1, "10.0.0.1", "10.0.0.6"), (2, "10.0.0.0", "10.0.1.255"), (3, "::1", "::5"), (4, "10.0.0.7", "10.0.0.1"), (5, None, "-")]
    spans = spark.createDataFrame(rows, "id int, start_ip string, end_ip string")
    joined = geo.ip_span_join(facts, spans, all_matches=True)
    assert joined.columns == ["ip", "n", "network", "extra", "id", "start_ip", "end_ip"]
    got = sorted((r.n, r.ip or "", r.network or "", r.extra["k"], r.id or 0, r.start_ip or "", r.end_ip or "") for r in joined.collect())
    want = [(1, "10.0.0.5", "a", 1, *rows[k]) for k in (0, 1, 2)] * 2 + [(2, "10.0.0.9", "", 2, *rows[2]), (5, "::5", "x", 5, *rows[3])]
    assert got == sorted(want + [(n, ip, "x", n, 0, "", "") for n, ip in ((3, "-"), (4, ""), (6, "11.0.0.0"))])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    last = re.search(r"(\w+Join) \[(\w+)#\d+\]", plan)
    assert last.groups() == ("SortMergeJoin", "_network")


def test_spans_of_one_split_are_taken_apart_in_many_tasks(spark):
    """Spans are short rows, so one split of a file holds millions; they are dealt out before Python takes them apart."""
    rows = [(k, f"10.0.{k % 9}.{k % 200}", f"10.0.{k % 9 + 1}.7") for k in range(400)] + [(k, None, None) for k in range(400, 500)]
    spans = spark.createDataFrame(rows, "id int, start_ip string, end_ip string").withColumn("extra", F.create_map(F.lit("k"), "id")).coalesce(1)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = geo._span_networks(spans, "start_ip", "end_ip").groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("_span.id").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert len(tasks) == 4 and sum(r.n for r in tasks) == 400 and max(r.n for r in tasks) < 200
    held = geo.ip_span_join(spark.createDataFrame([("10.0.3.50",)], "ip string"), spans, all_matches=True).collect()
    want = [k for k, a, b in rows if a and ipaddress.ip_address(a) <= ipaddress.ip_address("10.0.3.50") <= ipaddress.ip_address(b)]
    assert sorted(r.id for r in held) == want and all(r.extra == {"k": r.id} for r in held)


def test_ends_of_spans_are_read_as_addresses_are():
    """Dotted text has a quick way of its own; it takes what ``ipaddress`` takes."""
    texts = [None, "", "-", "0.0.0.0", "255.255.255.255", "256.0.0.1", "01.2.3.4", "00.0.0.0", "1.2.3", "1.2.3.4.5", " 1.2.3.4", "1.2.3.4\n", "1.2.3.4/8",
             "١.2.3.4", "1.2.3.²", "+1.2.3.4", "1_0.2.3.4", "1..2.3", "1000.2.3.4", "::", "::1", "::ffff:1.2.3.4", "2001:db8::"]
    for text in texts:
        try:
            address = ipaddress.ip_address(text or "")
        except ValueError:
            assert cover(text, text) is None, text
        else:
            assert cover(text, text) == [str(ipaddress.ip_network(address))], text
