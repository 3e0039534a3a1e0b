"""Sub-word topics against a direct greedy walk."""

import random
import re

import pytest

from pageloom.operators import topics


def pieces(word, vocabulary):
    """Greedy longest match; None for a word that cannot be covered."""
    out, start = [], 0
    while start < len(word):
        for end in range(len(word), start, -1):
            piece = ("##" if start else "") + word[start:end]
            if piece in vocabulary:
                break
        else:
            return None
        out.append(piece)
        start = end
    return out


def direct(domain, vocabulary):
    found = []
    for word in re.findall(r"[a-z0-9é]+", domain.lower()):
        word = word.replace("é", "e")
        tokens = pieces(word, vocabulary)
        found += [t for t in tokens or [] if re.fullmatch(r"[a-z]+", t)]
    return found


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(11)
    heads = {"".join(rng.choice("abc1") for _ in range(rng.randint(1, 4))) for _ in range(40)}
    tails = {"##" + "".join(rng.choice("abc1") for _ in range(rng.randint(1, 3))) for _ in range(25)}
    return heads | tails | {"com", "cafe", "www"}


def test_matches_direct_walk(spark, vocabulary):
    rng = random.Random(12)
    domains = [".".join("".join(rng.choice("abc1") for _ in range(rng.randint(1, 9))) for _ in range(3)) for _ in range(150)]
    domains += ["www.café.com", "WWW.Com", "com", "", "-.-", "a" * 150 + ".com", "abc_com:80"] + ["www.com"] * 50
    table = spark.createDataFrame(list(enumerate(domains)), "i int, domain string")
    tokens = spark.createDataFrame([(t,) for t in sorted(vocabulary)], "token string")
    got = {r.i: r.domain_topics for r in topics.domain_topics(table, tokens).collect()}
    for i, domain in enumerate(domains):
        assert got[i] == direct(domain, vocabulary), domain


def test_without_vocabulary(spark):
    table = spark.createDataFrame([("Www.Ab-cd9.com",), (None,)], "domain string")
    assert [r.domain_topics for r in topics.domain_topics(table).collect()] == [["www", "ab", "com"], None]
