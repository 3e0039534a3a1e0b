"""Library counts against direct counting."""

import random
from collections import Counter
from itertools import permutations

import pytest

from pageloom.operators import libs


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(5)
    pairs = {(f"d{d}", f"l{rng.randrange(12)}") for d in range(40) for _ in range(rng.randrange(6))}
    # Domains that share a set, one domain with very many libraries, and the domain ''.
    pairs |= {(f"s{d}", lib) for d in range(30) for lib in ("l1", "l2", "l3")}
    pairs |= {("", f"big{i}") for i in range(40)} | {("", "l1")}
    return pairs, spark.createDataFrame(sorted(pairs), "domain string, js_lib string")


def expected(pairs):
    by_domain = {}
    for domain, lib in pairs:
        by_domain.setdefault(domain, set()).add(lib)
    return Counter(p for members in by_domain.values() for p in permutations(members, 2))


@pytest.mark.parametrize("block_libs", [2, 7, 512])
def test_cooccurrence(sample, block_libs):
    pairs, df = sample
    got = {(r.js_lib1, r.js_lib2): r.domain_count for r in libs.cooccurrence(df, block_libs=block_libs).collect()}
    assert got == dict(expected(pairs))


@pytest.mark.parametrize("least", [2, 5])
def test_frequent_pairs(sample, least):
    pairs, df = sample
    got = {(r.js_lib1, r.js_lib2): r.domain_count for r in libs.cooccurrence(df, min_domains=least, block_libs=3).collect()}
    assert got == {p: n for p, n in expected(pairs).items() if n >= least}


@pytest.mark.parametrize(("k", "probe"), [(5, 3), (20, 6), (2000, 4), (7, 64)])
def test_top_pairs(sample, k, probe):
    pairs, df = sample
    want = sorted(((-n, a, b) for (a, b), n in expected(pairs).items()))[:k]
    got = [(-r.domain_count, r.js_lib1, r.js_lib2) for r in libs.top_cooccurrence(df, k, probe).collect()]
    assert got == want


def test_domain_counts(sample):
    pairs, df = sample
    want = Counter(lib for _, lib in pairs)
    assert {r.js_lib: r.domain_count for r in libs.lib_domain_counts(df).collect()} == dict(want)
    top = [(r.js_lib, r.domain_count) for r in libs.top_libs(df, 4).collect()]
    assert top == sorted(want.items(), key=lambda i: (-i[1], i[0]))[:4]


def test_pairs_of_pages(spark):
    pages = spark.createDataFrame(
        [("http://a/1", ["x.js", "x.min.js", "none"]), ("http://a/2", ["x.js"]), ("-", ["y.js"]), ("http://b", None)],
        "host string, script_src_attrs array<string>",
    )
    assert {tuple(r) for r in libs.domain_lib_pairs(pages).collect()} == {("a", "x.js"), ("", "y.js")}
    assert {tuple(r) for r in libs.domain_lib_pairs(pages, drop_empty_domain=True).collect()} == {("a", "x.js")}
