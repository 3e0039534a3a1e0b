import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from pageloom.llm import listrank, trie


def mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def ordered(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, mark(role or "", text or ""), (role or "", text or "")))
    return {c: [t[3] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    out = []
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    for path, some in members.items():
        below = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        up = members[path[:-1]][0] if path else None
        ids = ",".join(map(str, ends[path]))
        out.append((some[0], len(path), up, len(some), len(children[path]), sum(not children[p] for p in below), saved, hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def drawn(seed, convs=60, longest=12, kinds=2):
    draw = np.random.default_rng(seed)
    rows = []
    for c in draw.permutation(convs * 2)[:convs].tolist():
        for t in range(int(draw.integers(1, longest))):
            rows.append((c, t, "user" if t % 2 else "bot", "é" * int(draw.integers(0, kinds))))
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS conv", "2 AS depth", "3 AS node", "4 AS start", "'x' AS mark", "5 AS bytes", "6 AS total", "7 AS place")


def run(spark, rows, small=None):
    return got(trie.trie(*trie.rebuilt(trie.in_order(frame(spark, rows))), small))


@pytest.fixture
def tight(monkeypatch):
    """Bounds so small that every case of a large table comes up."""
    for name, value in (("CHUNK", 3), ("BUCKETS", 2), ("IDS", 4), ("BLOCK", 5)):
        monkeypatch.setattr(trie, name, value)


def test_small_bounds(spark, tight):
    for seed in (1, 2):
        rows = drawn(seed)
        assert run(spark, rows, small=8) == brute(rebuilt(ordered(rows)))


def test_conversations_as_they_are(spark):
    rows = drawn(3, convs=40)
    assert got(trie.prefix_trie(frame(spark, rows))) == brute(ordered(rows))


def test_a_conversation_of_most_turns(spark, tight):
    rows = drawn(4, convs=10, longest=4) + [(3, t, "user", f"t{t}") for t in range(300)]
    assert run(spark, rows, small=10) == brute(rebuilt(ordered(rows)))


def test_odd_rows(spark, tight):
    rows = [
        (5, None, "user", "first"), (5, None, None, None), (5, 1, "user", "x"), (5, 1, "user", "x"), (5, 1, "user", "a"), (6, 0, None, ""), (None, 0, "user", "none"),
        (7, 0, "user", "long " * 200_000), (-3, 0, "user", "x"), (-4, 0, "user", "x"), (0, 0, "user", "x"), (12, 3, "", ""), (2**62 + 1, -4, "user", "x"), (13, 0, "u", ":x"),
        (14, 0, "u:", "x"),
    ] + [(5, 2, "bot", "again")] * 40
    for small in (None, 2):
        assert run(spark, rows, small) == brute(rebuilt(ordered(rows)))
    assert run(spark, rows[:0]) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_conversations_left_without_turns(spark):
    rows = [(c, 0, "user", "x") for c in range(1, 60) if c % 5]  # no group has its first conversation
    want = brute(rebuilt(ordered(rows)))
    assert run(spark, rows) == want and want[0][3] == len(rows)


def test_places_of_a_list(spark, monkeypatch):
    draw = np.random.default_rng(5)
    order = draw.permutation(3_000).tolist()
    size = draw.integers(1, 5, 3_000).tolist()
    heads = {0, 1_000, 1_001}  # three lists
    rows = [(k, k % 7, *((order[n + 1], order[n + 1] % 7) if n + 1 < len(order) and n + 1 not in heads else (None, None)), size[k]) for n, k in enumerate(order)]
    want, place = {}, 0
    for n, k in enumerate(order):
        place = 0 if n in heads else place
        want[k] = place
        place += size[k]
    elements = spark.createDataFrame(rows, "c long, x long, sc long, sx long, size long")
    for small in (200, 10_000):
        assert {r["c"]: r["place"] for r in listrank.places(elements, "list-test", small).collect()} == want
    assert listrank.places(elements.where("false"), "list-test").collect() == []
