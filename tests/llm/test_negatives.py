import math

import numpy as np
from pyspark.sql import functions as F

from pageloom.llm import negatives


def brute(rows, ask=50, positives=5, picked=3):
    usable = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = (label, [math.floor(256 * x) for x in v])
        usable[i] = min(usable.get(i, whole), whole)
    out = []
    for a, (label, v) in usable.items():
        if a % ask:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m == label) for i, (m, w) in usable.items() if i != a and len(w) == len(v)]
        for ps, p, same in sorted(s for s in scored if s[2])[:positives]:
            found = sorted((s, i) for s, i, alike in scored if not alike and 50 * -ps <= 100 * -s <= 95 * -ps)[:picked]
            out += [(a, p, n, i, -ps, -s) for n, (s, i) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").selectExpr("*", "1 AS id", "2 AS key", "'x' AS vector", "3 AS score", "4 AS rank")
    found = negatives.hard_negatives(df, F.col("id") % 50 == 0, **how)
    return sorted(tuple(r) for r in found.collect())


def drawn(count, dim, seed=3, spread=0.4):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((4, dim))
    return [(k, int(k % 4), (centres[(k + k // 7) % 4] + spread * draw.standard_normal(dim)).tolist()) for k in range(count)]


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 60)
    monkeypatch.setattr(negatives, "BLOCK", 3)
    rows = drawn(400, 20)
    want = brute(rows)
    assert len(want) > 40 and run(spark, rows) == want


def test_ties_and_repeated_rows(spark):
    rows = [(k, k % 2, [float(k % 3), 1.0]) for k in range(120)]
    rows += [rows[50], rows[51], (51, 0, [9.0, 9.0])]
    want = brute(rows)
    assert want and run(spark, rows) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [2.0, 1.0]), (2, 2, [1.0, 1.0]), (3, 2, None), (4, 2, [None, 1.0]), (5, 2, [nan, 1.0]), (6, 2, [inf, 1.0]),
        (None, 2, [1.0, 1.0]), (7, None, [1.0, 1.0]), (8, 2, [1.0, 1.0, 1.0]), (9, 2, []), (50, 3, []), (100, 1, [-3.0, 0.0]), (150, 1, [0.0, 0.0]),
        (200, 2, [0.5, 0.75]), (250, 1, [-0.001, 1e-300]),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[3:8]) == []
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(empty, F.col("id") % 50 == 0).collect() == []


def test_large_numbers_are_exact(spark):
    for scale in (1e5, 2e6):  # sums beyond 53 bits, and near 63
        rows = [(k, label, [scale * x for x in v]) for k, label, v in drawn(300, 6, seed=5, spread=1.0)]
        want = brute(rows)
        assert want and run(spark, rows) == want


def test_python_numbers_where_64_bits_do_not_hold_the_sums():
    draw = np.random.default_rng(2)
    vectors = np.floor(draw.standard_normal((50, 4)) * 2.0**40)
    shard = negatives.Columns(np.arange(50), np.arange(50) % 2, vectors)
    exact = [sum(int(a) * int(b) for a, b in zip(vectors[0], v)) for v in vectors]
    want = sorted((-exact[i], i) for i in range(50) if i % 2 == 0 and i)[:5]
    assert negatives.best(shard, vectors[0], 0, 0, 5) == [(i, -s) for s, i in want]


def test_bounds_leave_columns_unread():
    """With few large components, most candidates are out before all columns are read."""
    draw = np.random.default_rng(4)
    vectors = np.floor(256 * draw.standard_normal((2_000, 64)) * np.geomspace(1, 0.01, 64))
    shard = negatives.Columns(np.arange(2_000), np.zeros(2_000, dtype=int), vectors)
    read = []

    def useful(low, high):
        read.append(len(low))
        return high >= np.partition(low, len(low) - 5)[len(low) - 5]

    shard.scan(vectors[0], np.arange(1, 2_000), useful)
    assert sum(read) * negatives.STEP < 0.5 * 2_000 * 64


def test_windows():
    for score in range(-50, 400):
        low, high = negatives.window(score, 50, 95)
        assert [s for s in range(-500, 500) if 50 * score <= 100 * s <= 95 * score] == list(range(low, high + 1))
